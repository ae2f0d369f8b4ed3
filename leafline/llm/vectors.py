"""Near-duplicate vectors by random-hyperplane sign hashing in several tables.

1. Equal vectors of a label form a class (two 64-bit hashes), compared once and weighted. Vectors that are null, zero or hold
   null or non-finite components, and rows whose label or vec_id is null, take no part.
2. A table hashes a vector to the signs of `bits` random hyperplanes. Two vectors at the cosine t share a bit with
   probability 1 - acos(t)/pi =: p and a table with p**bits; `plan` sets bits from the largest label (so that unrelated
   vectors seldom meet) and then the tables for the target recall at t.
3. Only (bucket, node) rows are shuffled by bucket. Vectors are dealt into parts of about CELL by the largest of their buckets,
   and two parts are compared if a bucket holds vectors of both, each pair of parts once (graph.meetings). A cell is compared by
   exact cosine in double precision and gives link counts and a spanning forest, never a row for each pair.
4. Connected components over the forests give component_id.

Defined cases: rows that take no part get n_links 0, their own vec_id as component_id, kept true (kept is false for a null
vec_id); repeated rows are links of each other, and all rows whose vec_id is the component's least are kept; vectors of
unequal length never link; labels of any type are compared as they are, by two 64-bit hashes; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common, graph, words

COSINE = 0.93
RECALL = 0.99995
CELL = 1000
LEAST_BITS = 12
#: Bits beyond the logarithm of the largest label: two unrelated vectors share a bucket of a table with probability 2**-SPARE.
SPARE = 5


def plan(largest: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): 2**bits is at least 2**SPARE times the largest label. Tables grow with the power -log2 p, 0.18, of it."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(largest, 1))) + SPARE)
    p = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - p))


def valid(vector: str = "embedding") -> F.Column:
    """Whether the vector has components, all finite, not all zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0), F.lit(False))


def units(flat: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their greatest component first, so that no square leaves the range of doubles."""
    x = flat / np.abs(flat).max(axis=1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def buckets(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """(bucket, node): a row for each table of each of classes(node, l1, l2, embedding)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        of_table = words.mix(np.arange(tables, dtype=np.uint64))
        for b in batches:
            node, l1, l2 = (b.column(k).to_numpy() for k in range(3))
            label = words.mix(l1.view(np.uint64) ^ words.mix(l2.view(np.uint64)))
            vectors = b.column(3)
            flat, size = np.asarray(vectors.flatten(), dtype=np.float64), np.diff(np.asarray(vectors.offsets))
            to = np.concatenate([[0], np.cumsum(size)])
            for d in np.unique(size).tolist():
                if d not in planes:
                    planes[d] = np.random.Generator(np.random.PCG64(11)).standard_normal((d, bits * tables))
                rows = np.flatnonzero(size == d)
                for lo in range(0, len(rows), 256):
                    at = rows[lo : lo + 256]
                    x = units(flat[to[at][:, None] + np.arange(d)])
                    key = ((x @ planes[d]) > 0).reshape(len(at), tables, bits) @ weight
                    h = words.mix((label[at] ^ words.mix(np.full(len(at), d, np.uint64)))[:, None] ^ words.mix(key ^ of_table))
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64).ravel()), pa.array(np.repeat(node[at], tables))], ["bucket", "node"])

    return classes.select("node", "l1", "l2", "embedding").mapInArrow(work, "bucket long, node long")


def compare(rows: DataFrame, cosine: float) -> DataFrame:
    """graph.PARTS of rows(cell, within, part, node, l1, l2, mult, embedding) dealt by cell; within: the cell is one part, not two."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in graph.whole_cells(batches):
            to = graph.cells(t)
            node, part, l1, l2, within = (t.column(c).to_numpy() for c in ("node", "part", "l1", "l2", "within"))
            vectors = t.column("embedding").combine_chunks()
            flat, length = np.asarray(vectors.flatten(), dtype=np.float64), np.diff(np.asarray(vectors.offsets))
            x = np.zeros((len(length), length.max()))
            x[np.arange(x.shape[1]) < length[:, None]] = flat
            x = units(x)
            pairs = []
            size = np.diff(to)
            small = size <= 40
            left = np.repeat(np.where(small, to[1:], 0), size)  # where a small cell ends, for each of its rows
            for d in range(1, int(size[small].max(initial=1))):
                i = np.flatnonzero(np.arange(len(x)) + d < left)
                i = i[np.einsum("ij,ij->i", x[i], x[i + d]) >= cosine - 1e-9]
                pairs.append((i, i + d))
            for a, b in zip(to[:-1][~small], to[1:][~small], strict=True):
                i, j = np.nonzero(np.triu(x[a:b] @ x[a:b].T >= cosine - 1e-9, 1))
                pairs.append((i + a, j + a))
            i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
            fit = (l1[i] == l1[j]) & (l2[i] == l2[j]) & (length[i] == length[j]) & ((part[i] == part[j]) == within[i]) & (node[i] != node[j])
            i, j = i[fit], j[fit]
            fit = np.zeros(len(i), dtype=bool)
            for lo in range(0, len(i), 100_000):
                a, b = i[lo : lo + 100_000], j[lo : lo + 100_000]
                fit[lo : lo + 100_000] = (x[a] * x[b]).sum(axis=1) >= cosine
            i, j = i[fit], j[fit]
            # rows of the same class in several cells become one node
            own, at = np.unique(node, return_inverse=True)
            weight = np.zeros(len(own), dtype=np.int64)
            weight[at] = t.column("mult").to_numpy()
            yield graph.parts(own, weight, at[i], at[j])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(work, graph.PARTS)


def hashes(*values: Column) -> tuple[Column, Column]:
    return F.xxhash64(*values), F.xxhash64(F.lit(1), *values)


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of embeddings(vec_id, embedding, label)."""
    common.arrow_rows(embeddings.sparkSession, 2048)
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label"))
    ok = F.coalesce(valid() & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    (h1, h2), (l1, l2) = hashes("label", "embedding"), hashes("label")
    e = e.select("vec_id", "embedding", ok.alias("ok"), h1.alias("h1"), h2.alias("h2"), l1.alias("l1"), l2.alias("l2"))
    use = e.where("ok")
    found = use.groupBy("h1", "h2").agg(F.min("vec_id").alias("low"), F.count("*").alias("mult"), F.first("l1").alias("l1"), F.first("l2").alias("l2"), F.first("embedding").alias("embedding"))
    found = common.stored(found, "vectors")
    clash = common.clashes(found)
    classes = common.told_apart(found, clash)
    largest = found.groupBy("l1", "l2").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, cosine, recall)
    every = common.stored(buckets(classes, bits, tables), "buckets")
    met = graph.meetings(every, found.count() * tables, cell)
    rows = common.stored(met, "met").join(classes, "node").select(F.explode("cells").alias("c"), "part", "node", "l1", "l2", "mult", "embedding")
    links = compare(rows.select("c.cell", "c.within", "part", "node", "l1", "l2", "mult", "embedding"), cosine)
    near = graph.resolve(links, classes.select("node", "low", "mult"))
    info = classes.select("node", "h1", "h2", "low", "mult").join(near, "node", "left")
    info = info.select("node", F.col("mult").alias("n"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("first", "low").alias("component_id"))
    own = common.told_apart(use.select("vec_id", "h1", "h2"), clash)
    part = common.joined(own.select("vec_id", "node"), common.stored(info, "classes"), "node", embeddings.count())
    part = part.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return part.unionByName(e.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "embeddings"))
