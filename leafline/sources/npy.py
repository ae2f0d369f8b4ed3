"""Vectors as NumPy `.npy` files: a data source with partitions by row ranges and a writer that commits whole files.

    spark.dataSource.register(npy.NpySource)
    spark.read.format("npy").load(path)                     # position, embedding
    df.select("embedding").write.format("npy").option("dim", 384).mode("append").save(path)

A path is a file or a folder of files, whose rows are numbered through in the order of their names. Files hold 16-bit floats
in C order and two dimensions, as the writer makes them; the reader takes floats of any width. Executors and driver open the
paths themselves, so that they must be on a folder that all of them mount.

Defined cases: no row gives one file of shape (0, dim); a row of another length, a null row, a file that is not two-dimensional
and, with the option dim, one of another width are errors; a task that fails leaves nothing behind, and a job shows no file
before it commits.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "position long, embedding array<float>"
ROWS = 65_536
#: Bytes that the writer keeps for a file's header, which it fills in when the rows are counted.
HEADER = 128


def mounted(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"npy files are opened on a mounted folder, not at {path}")
    return parts.path


def header(rows: int, dim: int) -> bytes:
    """The header of a version 1.0 file of rows x dim 16-bit floats, HEADER bytes long."""
    text = f"{{'descr': '<f2', 'fortran_order': False, 'shape': ({rows}, {dim}), }}"
    return b"\x93NUMPY\x01\x00" + (HEADER - 10).to_bytes(2, "little") + text.ljust(HEADER - 11).encode() + b"\n"


def files(path: str) -> list[str]:
    where = mounted(path)
    return [os.path.join(where, f) for f in sorted(os.listdir(where)) if f.endswith(".npy")] if os.path.isdir(where) else [where]


@dataclass
class Rows(InputPartition):
    """Rows [start, end) of a file; its first row has the number `before`."""

    file: str
    before: int
    start: int
    end: int


class NpyReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.rows = options["path"], int(options.get("rowsPerPartition", ROWS))
        self.dim = int(options["dim"]) if "dim" in options else None

    def opened(self, file: str) -> np.ndarray:
        a = np.load(file, mmap_mode="r", allow_pickle=False) if os.path.getsize(file) > HEADER else np.load(file, allow_pickle=False)
        if a.ndim != 2:
            raise ValueError(f"{file} has the shape {a.shape}; vectors need two dimensions")
        if self.dim is not None and a.shape[1] != self.dim:
            raise ValueError(f"{file} has vectors of {a.shape[1]} components, not {self.dim}")
        return a

    def partitions(self) -> list[Rows]:
        out, before = [], 0
        for f in files(self.path):
            n = self.opened(f).shape[0]
            out += [Rows(f, before, a, min(a + self.rows, n)) for a in range(0, n, self.rows)]
            before += n
        return out or [Rows("", 0, 0, 0)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        for a in range(part.start, part.end, 4096):
            x = np.asarray(self.opened(part.file)[a : min(a + 4096, part.end)], dtype=np.float32)
            flat = pa.array(np.ascontiguousarray(x).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([pa.array(part.before + np.arange(a, a + len(x))), lists], ["position", "embedding"])


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int
    dim: int


class NpyWriter(DataSourceArrowWriter):
    """Each task writes a hidden file, header last; the commit gives the files their names, in the order of the tasks."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = mounted(options["path"]), overwrite, uuid.uuid4().hex
        self.dim = int(options["dim"]) if "dim" in options else None
        os.makedirs(self.path, exist_ok=True)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        context = TaskContext.get()
        file, rows, dim = os.path.join(self.path, f".{self.job}-{context.partitionId():06d}-{context.taskAttemptId()}"), 0, self.dim
        try:
            with open(file, "wb") as out:
                out.write(b"\0" * HEADER)
                for batch in batches:
                    lists = batch.column(batch.schema.get_field_index("embedding"))
                    size = np.diff(lists.offsets.to_numpy())
                    if not len(size):
                        continue
                    dim = int(size[0]) if dim is None else dim
                    if lists.null_count or (size != dim).any():
                        raise ValueError(f"vectors need {dim} components")
                    out.write(lists.flatten().to_numpy(zero_copy_only=False).astype("<f2").tobytes())
                    rows += len(size)
                out.seek(0)
                out.write(header(rows, dim or 0))
        except BaseException:
            os.unlink(file)
            raise
        return Written(file, rows, dim or 0)

    def commit(self, messages: list[Written | None]) -> None:
        done = sorted((m for m in messages if m), key=lambda m: m.file)
        if len({m.dim for m in done if m.rows}) > 1:
            self.abort(messages)
            raise ValueError("tasks wrote vectors of different lengths")
        if self.overwrite:
            for f in files(self.path):
                os.unlink(f)
        kept = [m for m in done if m.rows] or done[:1]
        for m in done:
            if m not in kept:
                os.unlink(m.file)
        if not kept:  # no task at all
            with open(name := os.path.join(self.path, f".{self.job}"), "wb") as out:
                out.write(header(0, self.dim or 0))
            kept = [Written(name, 0, self.dim or 0)]
        number = len(files(self.path))
        for k, m in enumerate(kept, number):
            os.rename(m.file, os.path.join(self.path, f"part-{k:06d}-{self.job}.npy"))

    def abort(self, messages: list[Written | None]) -> None:
        for f in os.listdir(self.path):
            if f.startswith(f".{self.job}"):
                os.unlink(os.path.join(self.path, f))


class NpySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> NpyReader:
        return NpyReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options, overwrite)
