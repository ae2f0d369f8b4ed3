"""Benchmark decontamination: an FM-index for each shard of the corpus, searched for the word windows of benchmark items.

1. `index`: every task cuts its documents into shards of about SHARD words, without a shuffle, and writes an FM-index of each
   (fmindex.py) to a table in the shared folder. Copies of a text within a shard are indexed once. A text longer than a shard
   is indexed in parts, which overlap by a window less a word, so that memory is bounded by SHARD.
2. `phrases`: the distinct windows of `window` consecutive words of each item; an item of fewer words, but not none, is one.
3. `matched`: windows are searched in blocks of at most BLOCK, each one broadcast: a pass over the indexes finds all windows of
   a block at once by backward search, locates their occurrences by the sampled suffix positions, and merges them to spans by
   text. Spans of several parts and blocks are merged by text.

A word is a run of the characters 0-9, a-z and those beyond ASCII, A-Z lower-cased; words are compared by 64-bit hashes.

Defined cases: null and empty texts have no word and no hit; an item without a word has no window; a null item_id marks words
but is not listed; rows that repeat an item_id are one item; repeated documents and null ids are rows like others; an empty
table gives no rows, an empty benchmark no hits; further columns are ignored by `contaminated` and pass through `decontaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common, fmindex, words

WINDOW = 10
SHARD = 1_000_000
BLOCK = 100_000
LOCATED = 1 << 18

SPACE = np.ones(256, dtype=bool)
SPACE[0x30:0x3A] = SPACE[0x41:0x5B] = SPACE[0x61:0x7B] = SPACE[0x80:] = False

INDEX = "shard long, part int, docs array<struct<doc_id long, text int>>, texts array<struct<h1 long, h2 long, n_words long>>, text array<int>, at array<long>, size long, starts binary, vocabulary binary, counts binary, levels binary, marked binary, positions binary"
HITS = "shard long, text int, spans array<struct<start long, end long>>, items array<string>"
SEARCHED = ["shard", "text", "at", "size", "starts", "vocabulary", "counts", "levels", "marked", "positions"]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = words.buffers(texts)
    starts, ends, doc = words.bounds(data, offsets, SPACE)
    return words.hashed(data, starts, ends), doc


def index(documents: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """The stored indexes (INDEX). `text` and `at`: the text of each indexed piece, and the number of its first word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        docs, texts, held, n = [], {}, [], 0

        def row(part: int, pieces: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            of_shard = {"docs": docs, "texts": list(texts.values())} if not part else {"docs": [], "texts": []}
            keys = {"shard": serial, "part": part, **of_shard, "text": [t for t, _, _ in pieces], "at": [a for _, a, _ in pieces]}
            return pa.RecordBatch.from_pylist([keys | fmindex.build([h for _, _, h in pieces])], schema=schema)

        for batch in batches:
            h, doc = hashed_words(batch.column(3))
            for k, (doc_id, h1, h2) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                own = h[doc[k] : doc[k + 1]]
                if texts and (h1, h2) not in texts and n + len(own) > shard:
                    yield row(0, held)
                    serial, docs, texts, held, n = serial + 1, [], {}, [], 0
                if (h1, h2) not in texts:
                    texts[h1, h2] = {"h1": h1, "h2": h2, "n_words": len(own), "nth": len(texts)}
                    if len(own) <= shard:
                        held.append((texts[h1, h2]["nth"], 0, own))
                        n += len(own)
                    else:
                        parts = [(texts[h1, h2]["nth"], a, own[a : a + shard + window - 1]) for a in range(0, len(own) - window + 1, shard)]
                        for p, piece in enumerate(parts[1:], 1):
                            yield row(p, [piece])
                        held.append(parts[0])
                        n += shard
                docs.append({"doc_id": doc_id, "text": texts[h1, h2]["nth"]})
        if docs:
            yield row(0, held)

    schema = spark_schema(documents.sparkSession)
    common.arrow_rows(documents.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return common.stored(rows.select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text").mapInArrow(work, INDEX), "fm-index")


def spark_schema(spark: SparkSession) -> pa.Schema:
    struct = lambda **fields: pa.list_(pa.struct(list(fields.items())))
    own = {"shard": pa.int64(), "part": pa.int32(), "docs": struct(doc_id=pa.int64(), text=pa.int32()), "texts": struct(h1=pa.int64(), h2=pa.int64(), n_words=pa.int64()), "text": pa.list_(pa.int32()), "at": pa.list_(pa.int64()), "size": pa.int64()}
    return pa.schema(own | dict.fromkeys(["starts", "vocabulary", "counts", "levels", "marked", "positions"], pa.binary()))


def phrases(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(words, item): the distinct windows of each item, words being their hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, doc = hashed_words(batch.column(1))
            out = [(h[a : min(a + window, e)].tobytes(), k) for k, (s, e) in enumerate(zip(doc[:-1].tolist(), doc[1:].tolist(), strict=True)) if e > s for a in range(s, max(s, e - window) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.binary()), batch.column(0).take(pa.array([k for _, k in out], pa.int64()))], ["words", "item"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    return common.stored(rows.mapInArrow(work, "words binary, item string").distinct(), "phrases")


def spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of the intervals [start, end) as disjoint ones; those that touch become one."""
    order = np.argsort(start)
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(start) else order
    return start[new], np.append(reach[new[1:] - 1], reach[-1:])


def occurrences(fm: fmindex.FmIndex, found: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrase, place) of all occurrences of the found phrases, some LOCATED at a time."""
    count = high[found] - low[found]
    to = np.concatenate([[0], np.cumsum(count)])
    for a in range(0, int(to[-1]), LOCATED):
        k = np.arange(a, min(a + LOCATED, int(to[-1])))
        own = np.searchsorted(to, k, side="right") - 1
        yield found[own], fm.locate(low[found[own]] + k - to[own])


def searched(indexes: DataFrame, block: DataFrame) -> DataFrame:
    """HITS of the phrases of one block, a row for each piece of a text that holds some."""
    rows = block.select("words", "item").toArrow()
    flat, which = np.unique(np.array(rows.column("words").to_pylist(), dtype=object), return_inverse=True) if rows.num_rows else (np.zeros(0, object), np.zeros(0, np.int64))
    width = max((len(x) // 8 for x in flat), default=1)
    table = np.zeros((len(flat), width), dtype=np.uint64)
    for k, x in enumerate(flat):
        table[k, width - len(x) // 8 :] = np.frombuffer(x, dtype=np.uint64)
    order = np.argsort(which, kind="stable")
    items = np.array(rows.column("item").to_pylist(), dtype=object)[order]
    length = np.array([len(x) // 8 for x in flat], dtype=np.int64)
    sent = indexes.sparkSession.sparkContext.broadcast((table, length, np.searchsorted(which[order], np.arange(len(flat) + 1)), items))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, length, of, items = sent.value
        for batch in batches:
            for r in batch.to_pylist():
                shard, text, at = r.pop("shard"), np.array(r.pop("text")), np.array(r.pop("at"))
                fm = fmindex.FmIndex(**r)
                low, high = fm.search(table, length)
                start, end, pairs = [], [], []
                for phrase, place in occurrences(fm, np.flatnonzero(low < high), low, high):
                    s, e = spans(place, place + length[phrase])
                    start.append(s)
                    end.append(e)
                    n = of[phrase + 1] - of[phrase]
                    own = np.repeat(of[phrase] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                    pairs.append(np.unique(np.stack([np.repeat(np.searchsorted(fm.starts, place, side="right") - 1, n), own]), axis=1))
                if not start:
                    continue
                s, e = spans(np.concatenate(start), np.concatenate(end))
                piece = np.searchsorted(fm.starts, s, side="right") - 1
                shift = at[piece] - fm.starts[piece]
                pairs = np.unique(np.concatenate(pairs, axis=1), axis=1)
                hit, first = np.unique(piece, return_index=True)
                ends, to = np.append(first[1:], len(piece)), np.searchsorted(pairs[0], [hit, hit + 1])
                out = [
                    {"shard": shard, "text": int(text[p]), "spans": [{"start": x, "end": y} for x, y in zip((s + shift)[a:b].tolist(), (e + shift)[a:b].tolist(), strict=True)], "items": list({items[i] for i in pairs[1, c:d].tolist()} - {None})}
                    for p, a, b, c, d in zip(hit.tolist(), first.tolist(), ends.tolist(), *to.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema({"shard": pa.int64(), "text": pa.int32(), "spans": pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()})), "items": pa.list_(pa.string())}))

    return indexes.select(*SEARCHED).mapInArrow(work, HITS)


def matched(indexes: DataFrame, windows: DataFrame, block: int = BLOCK) -> DataFrame:
    """HITS of all phrases: one row for each text with some, its spans disjoint and in order, its items sorted."""
    blocks = -(-windows.count() // block)
    own = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(max(1, blocks))))
    hits = [common.stored(searched(indexes, own.where(F.col("block") == b)), "hits") for b in range(blocks)]
    if not hits:
        return indexes.sparkSession.createDataFrame([], HITS)
    rows = hits[0]
    for more in hits[1:]:
        rows = rows.unionAll(more)
    # a text has a row for each of its parts and blocks that hold some
    rows = rows.groupBy("shard", "text").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("spans")
            to, flat = lists.offsets.to_numpy(), lists.values
            each = [spans(*(flat.field(k).to_numpy()[a:b] for k in range(2))) for a, b in zip(to[:-1], to[1:], strict=True)]
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate([x[k] for x in each])) for k in range(2)], ["start", "end"])
            merged = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(s) for s, _ in each)]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([merged if c == "spans" else batch.column(c) for c in batch.schema.names], batch.schema.names)

    return common.stored(rows.mapInArrow(merge, HITS), "matched")


def contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, spans, items) of each document: the disjoint spans [start, end) of words within any occurrence of a
    benchmark window, in order, and the items whose windows occur, sorted as strings."""
    indexes = index(documents, window, shard)
    hits = matched(indexes, phrases(benchmark, window), block)
    rows = indexes.where("part = 0").select("shard", "texts", F.explode("docs").alias("d"))
    rows = rows.select("shard", F.col("d.text").alias("text"), F.col("d.doc_id").alias("doc_id"), F.get("texts", F.col("d.text"))["n_words"].alias("n_words"))
    out = rows.join(hits, ["shard", "text"], "left")
    return out.select("doc_id", "n_words", *(F.coalesce(c, F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("spans", "items")))


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """documents, with the spans of benchmark windows cut from their texts, from each span's first word to its last."""
    indexes = index(documents, window, shard)
    hits = matched(indexes, phrases(benchmark, window), block)
    texts = indexes.where("part = 0").select("shard", F.posexplode("texts").alias("text", "t")).join(hits, ["shard", "text"])
    texts = common.stored(texts.groupBy("t.h1", "t.h2").agg(F.first("spans").alias("spans")), "spans-by-text")  # copies have the same spans
    rows = documents.select(common.boxed(documents), F.col("text").cast("string").alias("t"))
    rows = rows.withColumns({"h1": F.xxhash64(F.coalesce("t", F.lit(""))), "h2": F.xxhash64(F.lit(1), F.coalesce("t", F.lit("")))})
    out = rows.join(texts, ["h1", "h2"], "left")
    cut = F.pandas_udf(without, "string")(F.when(F.col("spans").isNotNull(), F.col("t")), F.col("spans.start"), F.col("spans.end"))
    return out.select(*common.unboxed(out, text=F.when(F.col("spans").isNull(), F.col("t")).otherwise(cut)))


def without(text: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    """Each text without its spans of words."""
    out = []
    for t, a, b in zip(text, start, end, strict=True):
        if t is None or a is None:
            out.append(t)
            continue
        data, offsets = words.buffers(pa.array([t]))
        first, last, _ = words.bounds(data, offsets, SPACE)
        at = np.concatenate([[0], np.stack([first[a], last[np.asarray(b) - 1]], axis=1).ravel(), [len(data)]])
        out.append(b"".join(data[x:y].tobytes() for x, y in at.reshape(-1, 2).tolist()).decode())
    return pd.Series(out, dtype=object)


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contaminated(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    return out.withColumn("contaminated", F.col("n_hit") > 0)


OP11_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, letters),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, letters),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS x FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) AS sizes),
hit AS (SELECT r, i, places.n, win.item_id FROM places JOIN win ON win.n = places.n AND win.x = array_to_string(w[i:i + places.n - 1], ' ')),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
