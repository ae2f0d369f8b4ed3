"""Exact top-k inner-product search by a vector-approximation file.

Vectors become integers, floor(scale * x). Equal vectors form a class that keeps its k+1 least distinct ids, each as often
as it stands there but k times at most. That is enough for any answer: ties go to the least id, a query leaves out one id,
and k rows come from k other ids at most. Classes lie in blocks twice: as an approximation file (each component's cell of
CELL_WIDTH steps) and as exact vectors, a row each. Query classes lie in blocks as well.

1. Each block of queries scans the approximations of all candidate blocks, the query set against all rows. Cells bound each
   score from below and above; the k+1st largest lower bound of a query over all ids, each with its best, is its threshold.
2. A second scan keeps the candidates whose upper bound reaches the threshold: (query, block, row, bound).
3. Exact vectors are read for these alone, in the order of their bounds: first each query's best, whose scores raise the
   threshold, then those whose bound still reaches it. What isn't read cannot be among the k+1 best ids.

A query's candidates meet as k+1 ids a task, and the rest as rows, so blocks bound a task's memory.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null
id; a repeated id is a row of its own and a query leaves out all rows of its id; a query id asks once for each of its
vectors; vectors of another length than the query's are no candidates; queries without a candidate give no rows; ties rank
by the lesser id; an integer component or a score beyond 64 bits is the nearest 64-bit integer; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common

SCALE = 256
K = 5
EVERY = 50
#: Integer steps a cell of the approximation spans. Bounds are (CELL_WIDTH - 1) * sum(|q|) apart.
CELL_WIDTH = 4
BLOCK = 4096
QUERY_BLOCK = 1024
#: Exact vectors read first, as a multiple of k+1.
FIRST = 4
MOST = np.iinfo(np.int64).max


def valid(vector: str = "embedding") -> F.Column:
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(x) > 0) & finite, F.lit(False))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids): the distinct integer vectors and their `keep` least distinct ids, each repeated as in rows but keep - 1 times
    at most, gathered in two steps against hot vectors."""
    counted = rows.groupBy("h", "vec", "vec_id").agg(F.least(F.count("*"), F.lit(keep - 1)).cast("int").alias("times"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    for key in (["h", "vec", "salt"], ["h", "vec"]):
        w = W.partitionBy(*key).orderBy("vec_id")
        salted = salted.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= keep)
    return salted.groupBy("h", "vec").agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("times"))))).alias("ids"))  # keep ids at most


def best_of_ids(scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, their best scores by query) from scores by query and class, with the classes' ids in a row."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    new = np.append(True, (of[1:] != of[:-1]) | (ids[1:] != ids[:-1]))  # ids are sorted within a class
    of, ids = of[new], ids[new]
    order = np.argsort(ids, kind="stable")
    each, start = np.unique(ids[order], return_index=True)
    if len(each) == len(ids):
        return ids, scores if len(ids) == len(sizes) else scores[:, of]
    return each, np.maximum.reduceat(scores[:, of[order]], start, axis=1)


def narrow(x: np.ndarray) -> np.ndarray:
    """x in the narrowest integers that hold it."""
    return x.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if not x.size or np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max))


def unpacked(data: bytes, rows: int, d: int) -> np.ndarray:
    """The rows x d integers of a block, of whatever width they were stored with."""
    return np.frombuffer(data, f"i{max(1, len(data) // max(1, rows * d))}").reshape(rows, d)


def packed(rows: DataFrame, candidates: bool) -> DataFrame:
    """rows(block, d, n, vec, ids) as blocks: ids with their numbers by class, in the order of n, and the cells of candidates or
    the vectors of queries."""

    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        d = table.column("d")[0].as_py()
        vec = np.asarray(table.column("vec").combine_chunks().flatten(), dtype=np.int64).reshape(-1, d)
        ids = table.column("ids").combine_chunks()
        sizes = np.diff(np.asarray(ids.offsets)).astype(np.int32)
        cols = [[key[0].as_py()], [d], [np.asarray(ids.flatten(), dtype=np.int64).tobytes()], [sizes.tobytes()], [narrow(vec // CELL_WIDTH if candidates else vec).tobytes()]]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.binary()] * 3), strict=True)], names=["block", "d", "ids", "sizes", "steps"])

    return rows.groupBy("block").applyInArrow(work, "block long, d int, ids binary, sizes binary, steps binary")


def bounds(q: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of queries q with vectors in these cells."""
    low, qf = cells.astype(np.float64) * CELL_WIDTH, q.astype(np.float64)
    base = qf @ low.T
    size = np.abs(qf).sum(axis=1) * (np.abs(low).max(initial=0) + CELL_WIDTH)
    slack = np.where(size < 2.0**53, 0, size * 2.0**-40)[:, None]  # what rounding may take beyond exact doubles
    down, up = ((CELL_WIDTH - 1) * f(qf, 0).sum(axis=1)[:, None] for f in (np.minimum, np.maximum))
    return np.clip(base + down - slack, -(2.0**63), 2.0**63), np.clip(base + up + slack, -(2.0**63), 2.0**63)  # as scores are


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and v, held at the ends of 64 bits."""
    size = np.abs(q.astype(np.float64)).max(axis=1, initial=0) * np.abs(v.astype(np.float64)).max(axis=1, initial=0) * q.shape[1]
    out = np.einsum("ij,ij->i", q, v)
    for i in np.flatnonzero(size >= 2.0**62):
        out[i] = max(-MOST - 1, min(MOST, sum(a * b for a, b in zip(q[i].tolist(), v[i].tolist(), strict=True))))
    return out


def top_k(embeddings: DataFrame, queries: F.Column, k: int = K, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row of embeddings(vec_id, embedding) under `queries`."""
    spark = embeddings.sparkSession
    common.arrow_rows(spark, 4096)
    e = embeddings.where(valid() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("vec"))
    e = e.select("vec_id", "vec", F.xxhash64("vec").alias("h"), F.size("vec").alias("d"))
    found = common.stored(classes(e.select("vec_id", "vec", "h"), k + 1).withColumn("d", F.size("vec")), "classes")
    asked = e.where(queries)
    wanted = common.stored(asked.select("h", "vec", "d").distinct(), "queries")

    def blocks(rows: DataFrame, size: int) -> DataFrame:
        """rows with their block, about `size` a block, and their number n there."""
        counts = rows.groupBy("d").agg(F.ceil(F.count("*") / size).alias("blocks"))  # a row a dimension
        dealt = rows.join(F.broadcast(counts), "d").withColumn("block", F.xxhash64("d", F.pmod(F.xxhash64("h", F.lit(9)), F.col("blocks"))))
        return dealt.withColumn("n", F.row_number().over(W.partitionBy("block").orderBy("vec"))).drop("blocks")

    exact = common.stored(blocks(found, block).select("block", "n", "d", "vec", "ids"), "exact")
    cand = common.stored(packed(exact, True), "blocks")
    each = common.stored(blocks(wanted.withColumn("ids", F.array("h")), query_block).select("block", "n", "d", "vec", "ids"), "asked")
    ask = common.stored(packed(each, False).select("d", F.col("block").alias("qb"), F.col("steps").alias("q")), "ask")
    # the query set meets all rows in blocks: a row for each pair of blocks of one dimension
    pairs = cand.select("d", F.col("block").alias("cb")).join(ask.select("d", "qb"), "d")
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    scan = pairs.join(ask.select("qb", "q"), "qb").join(cand.select(F.col("block").alias("cb"), "ids", "sizes", "steps"), "cb")

    def threshold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k+1 ids of the best lower bounds of each query, over all the blocks that a task meets one query block in."""
        at, held = None, None

        def out() -> pa.RecordBatch:
            ids, low = held
            real = ids.ravel() >= 0
            n = np.repeat(np.arange(1, len(ids) + 1), ids.shape[1])
            cols = np.full(real.sum(), at), n[real], own[ids.ravel()[real]], low.ravel()[real]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["qb", "qn", "vec_id", "low"])

        own = np.zeros(0, np.int64)  # distinct ids; held has places in it
        for b in batches:
            for r in b.to_pylist():
                if at is not None and at != r["qb"]:
                    yield out()
                    own, held = own[:0], None
                at = r["qb"]
                sizes = np.frombuffer(r["sizes"], np.int32)
                low, _ = bounds(unpacked(r["q"], r["qs"], r["d"]), unpacked(r["steps"], len(sizes), r["d"]))
                ids, low = best_of_ids(low, np.frombuffer(r["ids"], np.int64), sizes)
                keep = min(k + 1, low.shape[1])
                best = np.argpartition(-low, keep - 1, axis=1)[:, :keep]
                ids, low = ids[best], np.take_along_axis(low, best, axis=1)
                if held is not None:  # an id's best bound of those held and those found
                    ids, low = np.hstack([own[held[0]], ids]), np.hstack([held[1], low])
                    order = np.lexsort((-low, ids))
                    ids, low = np.take_along_axis(ids, order, axis=1), np.take_along_axis(low, order, axis=1)
                    low[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
                    best = np.argsort(-low, axis=1, kind="stable")[:, : k + 1]
                    ids, low = np.take_along_axis(ids, best, axis=1), np.take_along_axis(low, best, axis=1)
                own, place = np.unique(ids, return_inverse=True)
                held = place.reshape(ids.shape), low
        if at is not None:
            yield out()

    qs = each.groupBy(F.col("block").alias("qb")).agg(F.count("*").cast("int").alias("qs"))
    dealt = scan.join(F.broadcast(qs), "qb").repartition(parts, "qb", F.pmod(F.xxhash64("cb"), F.lit(parts))).sortWithinPartitions("qb")
    low = dealt.mapInArrow(threshold, "qb long, qn long, vec_id long, low double").where("low > double('-inf')")
    low = low.groupBy("qb", "qn", "vec_id").agg(F.max("low").alias("low"))
    least = _least(low, ["qb", "qn"], "low", k)

    def line_up(key: tuple, table: pa.Table) -> pa.Table:
        out = np.full(int(table.column("qs")[0].as_py()), -np.inf)
        out[table.column("qn").to_numpy() - 1] = table.column("low").to_numpy()
        return pa.table([pa.array([key[0].as_py()]), pa.array([out.tobytes()], pa.binary())], names=["qb", "least"])

    aligned = common.stored(least.join(F.broadcast(qs), "qb").groupBy("qb").applyInArrow(line_up, "qb long, least binary"), "thresholds")

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                sizes, least = np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["least"])
                _, up = bounds(unpacked(r["q"], len(least), r["d"]), unpacked(r["steps"], len(sizes), r["d"]))
                i, j = np.nonzero(up >= least[:, None])
                cols = np.full(len(i), r["qb"]), i + 1, np.full(len(i), r["cb"]), j + 1, up[i, j]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["qb", "qn", "block", "n", "up"])

    full = scan.join(aligned, "qb").drop("ids")
    kept = common.stored(full.mapInArrow(survivors, "qb long, qn long, block long, n long, up double"), "survivors")
    asks = each.select(F.col("block").alias("qb"), F.col("n").cast("long").alias("qn"), F.col("vec").alias("q"), F.element_at("ids", 1).alias("h"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d, out = b.column(4).to_numpy(), np.zeros(b.num_rows, np.int64)
                for size in np.unique(d):
                    at = np.flatnonzero(d == size)
                    q, v = (np.asarray(b.column(c).take(pa.array(at)).flatten(), dtype=np.int64).reshape(-1, size) for c in (2, 3))
                    out[at] = products(q, v)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out)], ["qh", "ids", "score"])

    def read(rows: DataFrame) -> DataFrame:
        """The scores (qh, vec_id, score) of survivors, by their exact vectors."""
        both = rows.join(asks, ["qb", "qn"]).join(exact.withColumn("n", F.col("n").cast("long")), ["block", "n"]).select("h", "ids", "q", "vec", "d")
        return both.mapInArrow(score, "qh long, ids array<long>, score long").select("qh", F.explode("ids").alias("vec_id"), "score")

    nth = F.row_number().over(W.partitionBy("qb", "qn").orderBy(F.desc("up"), "block", "n"))
    early = common.stored(kept.withColumn("nth", nth).where(F.col("nth") <= FIRST * (k + 1)), "early")
    first = common.stored(read(early), "first")
    sure = _least(first.groupBy(F.col("qh").alias("h"), "vec_id").agg(F.max("score").cast("double").alias("low")), ["h"], "low", k).join(asks.select("h", "qb", "qn"), "h").select("qb", "qn", "low")
    late = kept.join(early.select("qb", "qn", "block", F.col("n")), ["qb", "qn", "block", "n"], "left_anti").join(sure, ["qb", "qn"]).where(F.col("up") >= F.col("low") - F.abs("low") * 2.0**-50).drop("low")
    best = first.unionByName(read(late))
    w = W.partitionBy("qh", "vec_id")
    best = best.withColumns({"nth": F.row_number().over(w.orderBy(F.desc("score"))), "top": F.max("score").over(w)}).where(F.col("nth") <= k)
    w = W.partitionBy("qh").orderBy(F.desc("top"), "vec_id")
    best = best.withColumn("nth", F.dense_rank().over(w)).where(F.col("nth") <= k + 1).drop("nth", "top")
    own = asked.select(F.col("vec_id").alias("query_id"), F.col("h").alias("qh")).distinct()
    w = W.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    out = own.join(best, "qh").where("vec_id <> query_id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def _least(rows: DataFrame, key: list[str], value: str, k: int) -> DataFrame:
    """(key, value): the k+1st largest value of a key, minus infinity where there are fewer."""
    top = rows.withColumn("nth", F.row_number().over(W.partitionBy(*key).orderBy(F.desc(value)))).where(F.col("nth") <= k + 1)
    out = top.groupBy(*key).agg(F.min(value).alias(value), F.count("*").alias("c"))
    return out.select(*key, F.when(F.col("c") > k, F.col(value)).otherwise(F.lit(float("-inf"))).alias(value))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


OP6_SQL = f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM e q JOIN e c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
