"""N-gram Jaccard join by MinHash banding.

1. Texts that are equal character by character form a class (two 64-bit hashes); each class is compared once, weighted.
2. Every class gets bands * rows minima over its set of five-word shingles. With the similarity t a pair shares a band with
   probability 1 - (1 - t**rows)**bands; `bands_for` gives the bands for a target recall at t.
3. The shuffle on band hashes gives the buckets of texts that share a band. Texts are dealt into parts of about CELL by the
   largest of their buckets; two parts are compared if a bucket holds texts of both (graph.meetings). So all pairs that
   share a band meet, and chains of bands don't grow into one group to compare.
4. Pairs of parts are compared on the full shingle sets as sparse products. No task sees a whole large group and no pair
   becomes a row: a cell gives link counts and a spanning forest of the links found. The few pairs that meet in a cell
   without a common band are verified alike.
5. Components over the forests give the near-duplicate classes.

A word is a run of bytes other than ASCII white space, with A-Z lower-cased; a text of one to four words is one shingle.

Defined cases: null text is empty; empty texts have no shingle: equal ones are copies, and they link with nothing else;
a null doc_id is reported as null, never names a class unless all of its class are null, and its row counts as a link;
repeated rows are copies of each other; very long texts are compared whole; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common, graph, words

NGRAM = 5
SIMILARITY = 0.8
ROWS = 7
RECALL = 0.9999
CELL = 256


def bands_for(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """The bands at which a pair of this similarity shares one with the probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def signatures(s: np.ndarray, to: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes, a row of `bands` for each text, of shingles s with offsets to; texts without a shingle get zeros."""
    rng = np.random.Generator(np.random.PCG64(7))
    mul = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
    xor = rng.integers(0, 2**64, bands * rows, dtype=np.uint64)
    out = np.zeros((len(to) - 1, bands), dtype=np.uint64)
    some = np.flatnonzero(np.diff(to))
    at = 0
    while at < len(some):  # about 64 Ki shingles at a time stay in the cache
        end = max(at + 1, int(np.searchsorted(to[some], to[some[at]] + 65536)))
        own = some[at:end]
        x = s[to[own[0]] : to[own[-1] + 1]]
        starts, buf = to[own] - to[own[0]], np.empty_like(x)
        for band in range(bands):
            h = np.full(len(own), band, dtype=np.uint64)
            for k in range(band * rows, band * rows + rows):
                np.bitwise_xor(x, xor[k], out=buf)
                np.multiply(buf, mul[k], out=buf)
                h = words.mix(h ^ np.minimum.reduceat(buf, starts))
            out[own, band] = h
        at = end
    return out


def sketches(texts: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """(node, size, bands) of each distinct text of texts(node, text); size: its shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            new = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]  # copies within a partition are sketched once
            batch = batch.take(pa.array(new, pa.int64()))
            s, to = words.shingles(*words.word_hashes(batch.column(1)), n)
            flat = pa.array(signatures(s, to, bands, rows).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(to), pa.int64()), lists], ["node", "size", "bands"])

    return texts.mapInArrow(sketch, "node long, size long, bands array<long>")


def shingle_sets(rows: DataFrame, n: int) -> DataFrame:
    """rows with its last column, text, replaced by `grams`: the sorted distinct shingle hashes as bytes, and their number."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, to = words.shingles(*words.word_hashes(batch.column(batch.num_columns - 1)), n)
            each = [np.unique(s[a:b]) for a, b in zip(to[:-1], to[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([x.tobytes() for x in each], pa.binary()), pa.array([len(x) for x in each], pa.int64())], [*batch.schema.names[:-1], "grams", "size"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(sets, f"{kept}, grams binary, size long")


def linked(sets: list[np.ndarray], side: np.ndarray | None, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of sets with at least this Jaccard similarity; with sides given, only pairs across two of them."""
    size = np.array([len(x) for x in sets])
    if len(sets) <= 6:
        hit = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if min(size[i], size[j]) >= similarity * max(size[i], size[j]) and (c := len(np.intersect1d(sets[i], sets[j], assume_unique=True))) / (size[i] + size[j] - c) >= similarity]
        i, j = np.array(hit, dtype=np.int64).reshape(-1, 2).T
    else:
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate([[True], flat[1:] != flat[:-1]])
        count = np.diff(np.append(np.flatnonzero(new), len(flat)))
        column = np.cumsum(new) - 1
        kept = count[column] > 1  # a shingle of a single set meets no other
        _, column = np.unique(column[kept], return_inverse=True)
        owner = owner[kept]
        both = np.zeros((len(sets), len(sets)))  # sums of slabs, each exact in 32 bits
        slab = max(256, (16 << 20) // (4 * len(sets)))
        for lo in range(0, int(column.max(initial=-1)) + 1, slab):
            a, b = np.searchsorted(column, [lo, lo + slab])
            x = np.zeros((len(sets), slab), dtype=np.float32)
            x[owner[a:b], column[a:b] - lo] = 1
            both += x @ x.T
        i, j = np.nonzero(np.triu(both, 1))
        c = both[i, j].astype(np.int64)
        fit = c / (size[i] + size[j] - c) >= similarity
        i, j = i[fit], j[fit]
    if side is not None:
        across = side[i] != side[j]
        i, j = i[across], j[across]
    return i, j


def compare(rows: DataFrame, similarity: float) -> DataFrame:
    """graph.PARTS of rows(cell, within, part, node, mult, grams) dealt by cell; within: the cell is one part, not two."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in graph.whole_cells(batches):
            to = graph.cells(table)
            for a, b in zip(to[:-1], to[1:], strict=True):
                cell = table.slice(int(a), int(b - a))
                node, first = np.unique(cell.column("node").to_numpy(), return_index=True)
                if len(node) < 2:
                    continue
                grams = cell.column("grams").to_pylist()
                side = None if cell.column("within")[0].as_py() else cell.column("part").to_numpy()[first]
                i, j = linked([np.frombuffer(grams[f], dtype=np.uint64) for f in first], side, similarity)
                yield graph.parts(node, cell.column("mult").to_numpy()[first], i, j)

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(work, graph.PARTS)


def hashes(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text, which tell texts apart together."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, n: int = NGRAM, rows: int = ROWS, recall: float = RECALL, cell: int = CELL, with_key: bool = False) -> DataFrame:
    """A row for each document: doc_id, class_id (least doc_id of its near-duplicate class), copy_id (least doc_id with
    the same text), copies (rows with that text) and n_links (other rows within the similarity, copies included); with_key adds
    h1 and h2, the text's hashes, and root, a key of the class."""
    bands = bands_for(similarity, rows, recall)
    common.arrow_rows(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    h1, h2 = hashes(F.col("text"))
    texts = texts.select("doc_id", h1.alias("h1"), h2.alias("h2"), "text")
    keys = common.stored(texts.select("doc_id", "h1", "h2"), "keys")
    found = common.stored(keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.count("*").alias("mult")), "texts")
    clash = common.clashes(found)
    keys, texts = (common.told_apart(x, clash) for x in (keys, texts))
    classes = common.told_apart(found, clash).select("node", "low", "mult")
    sketch = sketches(texts.select("node", "text"), bands, rows, n).where("size > 0").groupBy("node").agg(F.first("bands").alias("bands"))
    sketch = common.stored(sketch, "sketches")
    met = graph.meetings(sketch.select(F.explode("bands").alias("bucket"), "node"), sketch.count() * bands, cell)
    candidates = common.stored(met.join(classes, "node").withColumnsRenamed({"low": "rep", "node": "c1"}), "candidates")
    hit = texts.join(common.maybe_broadcast(candidates), (F.col("node") == F.col("c1")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = shingle_sets(hit.select("node", "part", "mult", "cells", "text"), n).where("size > 0")
    links = compare(sets.select(F.explode("cells").alias("c"), "part", "node", "mult", "grams").select("c.cell", "c.within", "part", "node", "mult", "grams"), similarity)
    near = graph.resolve(links, classes)
    info = classes.join(near, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "low", "mult", F.col("mult").alias("n"), F.coalesce("first", "low").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
    out = common.joined(keys, common.stored(info, "classes"), "node", keys.count())
    return out.select(*["h1", "h2", "root"] * with_key, "doc_id", "class_id", F.col("low").alias("copy_id"), F.col("mult").alias("copies"), (F.col("links") + F.col("mult") - 1).alias("n_links"))


def deduplicated(documents: DataFrame, **how) -> DataFrame:
    """One document of each near-duplicate class, with its own columns: the least (doc_id, text hashes), null ids last."""
    near = near_duplicates(documents, with_key=True, **how).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    texts = near.groupBy("root", "doc_id", "h1", "h2").agg(F.count("*").alias("n"))  # several where a class's least id repeats or is null
    least = texts.groupBy("root").agg(F.min(F.struct(F.col("doc_id").alias("id"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n")).alias("x"))
    kept = common.stored(least.select("x.*"), "representatives")
    h1, h2 = hashes(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = documents.select(common.boxed(documents), F.col("doc_id").cast("long").alias("id_"), h1.alias("h1"), h2.alias("h2"))
    match = F.col("id_").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    several = common.maybe_broadcast(common.stored(kept.where("n > 1"), "repeated"))  # rows that repeat an id and its text
    once = keyed.join(common.maybe_broadcast(kept.where("n = 1")), match).unionByName(keyed.join(several, match).dropDuplicates(["id", "k1", "k2"]))
    return once.select(*common.unboxed(once))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "documents"))
