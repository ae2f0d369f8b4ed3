"""Model calls as an injected function: one row a call in, answer, timing, tokens and error out. The default is a deterministic stub."""

from __future__ import annotations

import json
import re
import time
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions import answers


class Answer(NamedTuple):
    """What a provider may return instead of a text alone; numbers of tokens that it doesn't tell are counted as words."""

    content: str
    finish_reason: str = "stop"
    input_tokens: int | None = None
    output_tokens: int | None = None


Provider = Callable[[str, str], "str | Answer"]
# Names that providers have for an answer cut at its limit.
FINISHED = {"max_tokens": "length", "": "stop"}
ANSWER = "content string, finish_reason string, ok boolean, error string, attempts int, started_at double, ended_at double, input_tokens long, output_tokens long"
KINDS = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "double": pa.float64(), "long": pa.int64()}

#: Seconds before the second and each further try, and tries, of calls on processors and on graphics cards.
RETRY_FIRST_S, RETRY_FACTOR = 2.0, 3.0
RETRIES = {"cpu": 3, "gpu": 5}


def delays(kind: str) -> list[float]:
    """The waits between the tries of a kind of call."""
    return [RETRY_FIRST_S * RETRY_FACTOR**n for n in range(RETRIES[kind] - 1)]


def patient(provider: Provider, kind: str = "cpu", sleep: Callable[[float], None] = time.sleep) -> Provider:
    """provider, asked again after growing waits where it fails; the last failure stands."""

    def ask(model: str, prompt: str) -> str:
        for wait in delays(kind):
            try:
                return provider(model, prompt)
            except Exception:  # noqa: BLE001 - asked again
                sleep(wait)
        return provider(model, prompt)

    return ask


def stub(model: str, prompt: str) -> str:
    """A short answer that only depends on model and prompt."""
    return f"{model}:{zlib.crc32(prompt.encode()):08x}:{' '.join(prompt.split()[:12])}"


def heading_reader(coarse: str, fine: str, words: int = 4) -> Provider:
    """A deterministic reader of tagged pages. A page is a heading if its text matches one of two patterns and its title, its first
    words, is neither too short nor too long for a title. Where pages beyond the first are coarse headings, these are listed, else all; a list that is continued keeps
    its kind, and pages up to its last one aren't listed again."""
    tag = re.compile(r"<physical_index_(\d+)>\n")
    title = lambda x: " ".join(x.split(" ", words)[:words])

    def tagged(prompt: str) -> Iterator[tuple[int, str]]:
        """The pages between two tags of a number each, up to the next such tag."""
        at = tag.search(prompt)
        while at:
            close = f"\n<physical_index_{at[1]}>"
            end = prompt.find(close, at.end())
            if end >= 0:
                yield int(at[1]), prompt[at.end() : end]
            at = tag.search(prompt, end + len(close) if end >= 0 else at.start() + 1)

    def read(model: str, prompt: str) -> str:
        seen = [int(x) for x in re.findall(r'"physical_index":(\d+)', prompt)]
        pages = dict(tagged(prompt))
        fits = lambda x: answers.TITLE_LENGTHS[0] <= len(title(x)) <= answers.TITLE_LENGTHS[1]
        listed = [n for n, x in pages.items() if n > max(seen, default=0) and fits(x) and (re.match(coarse, x) or re.match(fine, x))]
        first = min(pages, default=0)
        top = [n for n in listed if re.match(coarse, pages[n])]
        before = len(re.findall('"title":"', prompt))
        if before == len(re.findall(rf'"title":"{coarse}', prompt)) if seen else any(n > first for n in top):
            listed = top
        return json.dumps({"toc": [{"structure": str(len(seen) + k), "title": title(pages[n]), "physical_index": f"<physical_index_{n}>"} for k, n in enumerate(listed, 1)]})

    return read


def in_order(ask: Callable[[tuple], tuple], rows: Iterator[tuple], window: int) -> Iterator[tuple]:
    """ask(row) of each row, in the rows' order, at most `window` of them begun and not yet given."""
    if window <= 1:
        yield from map(ask, rows)
        return
    with ThreadPoolExecutor(window) as pool:
        begun: deque = deque()
        for row in rows:
            if len(begun) == window:
                yield begun.popleft().result()
            begun.append(pool.submit(ask, row))
        while begun:
            yield begun.popleft().result()


def call(prompts: DataFrame, provider: Provider = stub, response: str | None = None, tries: int = 3, clock: Callable[[], float] = time.time, window: int = 1, tasks: int | None = None, batch: int = 64) -> DataFrame:
    """prompts(model, prompt, ...) with ANSWER. A failure is a row with ok false, never a failed task. With a response key
    (answers.RESPONSES) the answer must be valid JSON for it, asked for up to `tries` times, and comes back normalised.

    A task has at most `window` calls under way, across its batches, and gives answers in its rows' order; with `tasks` the
    rows are dealt to so many tasks, so that at most tasks * window calls are under way in all.
    """
    if response is not None:
        answers.known(response)

    def one(row: tuple) -> tuple:
        model, prompt = row
        start, error = clock(), None
        for n in range(1, tries + 1):
            try:
                got = provider(model, prompt)
                got = got if isinstance(got, Answer) else Answer(got)
                content = answers.normalised(response, got.content) if response else got.content
                tokens = (len(t.split()) if k is None else k for t, k in ((prompt, got.input_tokens), (content, got.output_tokens)))
                return content, FINISHED.get(got.finish_reason or "", got.finish_reason), True, None, n, start, clock(), *tokens
            except Exception as e:  # noqa: BLE001 - the error becomes data
                error = f"{type(e).__name__}: {e}"
                if not response:
                    break
        return f"ERROR: {error}", "error", False, error, n, start, clock(), len(prompt.split()), 0

    names = [*prompts.columns, *(f.split(" ")[0] for f in ANSWER.split(", "))]
    at_model, at_prompt = prompts.columns.index("model"), prompts.columns.index("prompt")
    kinds = [KINDS[f.split(" ")[1]] for f in ANSWER.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: deque[pa.RecordBatch] = deque()  # read, and not answered as a whole

        def rows() -> Iterator[tuple]:
            for b in batches:
                for a in range(0, b.num_rows, batch):
                    parts.append(b.slice(a, batch))
                    yield from zip(parts[-1].column(at_model).to_pylist(), parts[-1].column(at_prompt).to_pylist(), strict=True)

        held = []
        for answer in in_order(one, rows(), window):
            held.append(answer)
            if len(held) == parts[0].num_rows:
                yield pa.RecordBatch.from_arrays([*parts.popleft().columns, *(pa.array(x, k) for x, k in zip(zip(*held, strict=True), kinds, strict=True))], names)
                held = []

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields)
    return (prompts if tasks is None else prompts.repartition(tasks)).mapInArrow(work, f"{kept}, {ANSWER}")


@dataclass
class Service:
    """A provider with its bounds: calls under way in a task, tasks at once, the patience of a kind of call. It keeps a ledger of
    the calls of all the answers that were stored through it: a stored answer's row is written once, however often its task ran."""

    provider: Provider = stub
    window: int = 1
    tasks: int | None = None
    kind: str | None = None
    answered: list[DataFrame] = field(default_factory=list)

    def call(self, prompts: DataFrame, response: str | None = None) -> DataFrame:
        provider = patient(self.provider, self.kind) if self.kind else self.provider
        return call(prompts, provider, response, window=self.window, tasks=self.tasks)

    def keep(self, stored: DataFrame) -> DataFrame:
        self.answered.append(stored)
        return stored

    def calls(self, spark: SparkSession) -> DataFrame:
        """(model, started_at, ended_at, input_tokens, output_tokens, errored, attempts) of all calls so far."""
        out = spark.createDataFrame([], LEDGER)
        for a in self.answered:
            out = out.unionAll(a.select("model", "started_at", "ended_at", "input_tokens", "output_tokens", (~F.col("ok")).alias("errored"), "attempts"))
        return out


LEDGER = "model string, started_at double, ended_at double, input_tokens long, output_tokens long, errored boolean, attempts int"
