"""A queue of work messages in a shared folder, and a streaming source over it.

    spark.dataSource.register(queue.QueueSource)
    spark.readStream.format("queue").option("path", path).option("visibility", 300).load()    # message_id, body, receives

A message is a file; receiving leases it, so that it stays invisible until the lease ends, and comes again unless it was
deleted meanwhile. The source receives up to `most` visible messages for each batch and notes what a batch holds, so that
a batch which runs again holds the same. It deletes nothing but blank messages: who has dealt with a message deletes it
(streaming.ingest.served does), and one that failed is left to be received again.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from leafline.sources.npy import mounted

SCHEMA = "message_id string, body string, receives int"
# Messages taken at once, seconds that they then stay invisible.
MOST, VISIBILITY = 10, 300.0


class Queue:
    """Messages, leases and the notes of batches under a folder; one consumer at a time."""

    def __init__(self, path: str, clock: Callable[[], float] = time.time) -> None:
        self.path, self.clock = mounted(path), clock
        for d in ("messages", "leases", "batches"):
            os.makedirs(os.path.join(self.path, d), exist_ok=True)

    def _file(self, kind: str, name: str) -> str:
        return os.path.join(self.path, kind, name)

    def _put(self, file: str, value: object) -> None:
        with open(f"{file}.{uuid.uuid4().hex}.tmp", "w") as out:
            json.dump(value, out)
        os.replace(out.name, file)

    def _get(self, file: str) -> dict | None:
        try:
            with open(file) as f:
                return json.load(f)
        except FileNotFoundError:
            return None

    def send(self, body: str) -> str:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        self._put(self._file("messages", name), body)
        return name

    def receive(self, most: int = MOST, visibility: float = VISIBILITY) -> list[dict]:
        """Up to `most` visible messages, oldest first, leased from now on; blank ones are deleted on the way."""
        out: list[dict] = []
        for name in sorted(os.listdir(os.path.join(self.path, "messages"))):
            if len(out) == most:
                break
            if name.endswith(".tmp"):
                continue
            lease = self._get(self._file("leases", name)) or {"until": 0, "receives": 0}
            if lease["until"] > self.clock():
                continue
            body = self._get(self._file("messages", name))
            if not (body or "").strip():
                self.delete(name)
                continue
            receives = lease["receives"] + 1
            self._put(self._file("leases", name), {"until": self.clock() + visibility, "receives": receives})
            out.append({"message_id": name, "body": body.strip(), "receives": receives})
        return out

    def delete(self, name: str) -> None:
        for kind in ("messages", "leases"):
            if os.path.exists(f := self._file(kind, name)):
                os.unlink(f)

    def size(self) -> int:
        return sum(not f.endswith(".tmp") for f in os.listdir(os.path.join(self.path, "messages")))

    def last_batch(self) -> int:
        return max((int(f) for f in os.listdir(os.path.join(self.path, "batches")) if f.isdigit()), default=0)

    def note(self, number: int, messages: list[dict]) -> None:
        self._put(self._file("batches", str(number)), messages)

    def noted(self, number: int) -> list[dict]:
        return self._get(self._file("batches", str(number))) or []

    def forget(self, number: int) -> None:
        """Drops the notes of all batches before this one; the number itself stays, so that counting goes on after a restart."""
        for f in os.listdir(os.path.join(self.path, "batches")):
            if f.isdigit() and int(f) < number:
                os.unlink(self._file("batches", f))


@dataclass
class Batch(InputPartition):
    number: int


class QueueReader(DataSourceStreamReader):
    """Offsets count batches of received messages."""

    def __init__(self, options: dict) -> None:
        self.path, self.most, self.visibility = options["path"], int(options.get("most", MOST)), float(options.get("visibility", VISIBILITY))

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        queue = Queue(self.path)
        number = queue.last_batch()
        if found := queue.receive(self.most, self.visibility):
            queue.note(number := number + 1, found)
        return {"batch": number}

    def partitions(self, start: dict, end: dict) -> list[Batch]:
        return [Batch(n) for n in range(start["batch"] + 1, end["batch"] + 1)]

    def read(self, part: Batch) -> Iterator[tuple]:
        for m in Queue(self.path).noted(part.number):
            yield m["message_id"], m["body"], m["receives"]

    def commit(self, end: dict) -> None:
        Queue(self.path).forget(end["batch"])


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "queue"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> QueueReader:
        return QueueReader(self.options)
