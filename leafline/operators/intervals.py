"""Summaries of call records: counts, tokens, wall-clock time as the union of intervals, and peak concurrency.

The union and the sweep work within (model, time bucket) and carry one row a bucket between buckets, so a model with a
third of all calls is not one task's work.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.operators import scratch

BUCKET_S = 3600.0


def _islands(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, s, e) of the merged intervals; intervals that touch merge."""
    w = W.partitionBy(*by).orderBy("s", "e")
    before = rows.withColumn("before", F.max("e").over(w.rowsBetween(W.unboundedPreceding, -1)))
    marked = before.withColumn("island", F.sum(F.when(F.col("before").isNull() | (F.col("s") > F.col("before")), 1).otherwise(0)).over(w))
    return marked.groupBy(*by, "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def disjoint(calls: DataFrame, key: str = "model", start: str = "started_at", end: str = "ended_at", bucket: float = BUCKET_S) -> DataFrame:
    """(key, s, e): disjoint intervals that cover what each key's intervals cover.

    What earlier buckets cover of a bucket is all up to their greatest end, so a bucket only needs that one number from them.
    """
    rows = calls.where(F.col(start).isNotNull() & F.col(end).isNotNull()).select(key, F.col(start).alias("s"), F.col(end).alias("e"), F.floor(F.col(start) / bucket).alias("b"))
    w = W.partitionBy(key).orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    covered = rows.groupBy(key, "b").agg(F.max("e").alias("top")).select(key, "b", F.max("top").over(w).alias("covered"))
    own = rows.join(covered, [key, "b"]).withColumn("s", F.greatest("s", "covered")).where("e >= s").select(key, "b", "s", "e")
    return _islands(own, [key, "b"]).select(key, "s", "e")


def union_length(calls: DataFrame, key: str = "model", start: str = "started_at", end: str = "ended_at", bucket: float = BUCKET_S) -> DataFrame:
    """(key, wall_s): the length of the union of each key's intervals."""
    return disjoint(calls, key, start, end, bucket).groupBy(key).agg(F.sum(F.col("e") - F.col("s")).alias("wall_s"))


def steps(calls: DataFrame, key: str = "model", start: str = "started_at", end: str = "ended_at") -> DataFrame:
    """(key, at, step): how many intervals begin (above 0) and end (below 0) at each time."""
    ok = calls.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    each = ok.select(key, F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))).alias("x")).select(key, "x.at", "x.step")
    return added(each, key)


def added(each: DataFrame, key: str = "model") -> DataFrame:
    """Steps at equal times summed, those up apart from those down."""
    return each.groupBy(key, "at", (F.col("step") > 0).alias("up")).agg(F.sum("step").alias("step")).drop("up")


def peak_of(found: DataFrame, key: str = "model", bucket: float = BUCKET_S) -> DataFrame:
    """(key, peak) of steps(key, at, step): the most intervals open at once; an end comes before a start at the same time."""
    at = found.withColumn("b", F.floor(F.col("at") / bucket))
    w = W.partitionBy(key, "b").orderBy("at", "step").rowsBetween(W.unboundedPreceding, 0)
    within = at.withColumn("run", F.sum("step").over(w)).groupBy(key, "b").agg(F.max("run").alias("top"), F.sum("step").alias("net"))
    base = F.coalesce(F.sum("net").over(W.partitionBy(key).orderBy("b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return within.withColumn("high", base + F.col("top")).groupBy(key).agg(F.greatest(F.max("high"), F.lit(0)).cast("long").alias("peak"))


def peak_concurrency(calls: DataFrame, key: str = "model", start: str = "started_at", end: str = "ended_at", bucket: float = BUCKET_S) -> DataFrame:
    """(key, peak): the most intervals open at once; an end comes before a start at the same time."""
    return peak_of(steps(calls, key, start, end), key, bucket)


def call_totals(calls: DataFrame, key: str = "model") -> DataFrame:
    """(key, count, errors, input_tokens, output_tokens, compute_s): failed calls bring tokens but no interval."""
    ok = ~F.coalesce(F.col("errored"), F.lit(False))
    return calls.groupBy(key).agg(
        F.count("*").alias("count"),
        F.count_if(F.coalesce("errored", F.lit(False))).alias("errors"),
        F.sum(F.coalesce("input_tokens", F.lit(0))).cast("long").alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).cast("long").alias("output_tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("ended_at") - F.col("started_at"))), F.lit(0.0)).alias("compute_s"),
    )


def summary(calls: DataFrame, key: str = "model") -> DataFrame:
    """One row a model: counts, tokens, compute and wall-clock seconds, average per call, peak concurrency."""
    good = calls.where(~F.coalesce(F.col("errored"), F.lit(False)))
    out = call_totals(calls, key).join(union_length(good, key), key, "left").join(peak_concurrency(good, key), key, "left")
    return out.select(
        key, "count", "errors", "input_tokens", "output_tokens",
        F.round("compute_s", 3).alias("compute_time_s"),
        F.round(F.coalesce("wall_s", F.lit(0.0)), 3).alias("wall_clock_time_s"),
        F.round(F.col("compute_s") / F.col("count"), 3).alias("avg_call_s"),
        F.coalesce("peak", F.lit(0)).cast("long").alias("max_concurrent"),
    )


def token_totals(calls: DataFrame) -> DataFrame:
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return calls.agg(s("input_tokens").alias("input"), s("output_tokens").alias("output")).withColumn("total", F.col("input") + F.col("output"))


def priced(totals: DataFrame, prices: DataFrame) -> DataFrame:
    """totals(model, input_tokens, output_tokens) with cost_usd; null for a model that has no price."""
    p = prices.select(F.col("model").alias("priced_model"), "input_rate", "output_rate")
    j = totals.join(p, F.regexp_replace("model", "^ocr:", "") == F.col("priced_model"), "left")
    cost = F.round(F.col("input_tokens") / 1e6 * F.col("input_rate") + F.col("output_tokens") / 1e6 * F.col("output_rate"), 6)
    return j.withColumn("cost_usd", cost).drop("priced_model", "input_rate", "output_rate")


def total_cost(costs: DataFrame) -> DataFrame:
    """(cost_usd, note): null and a note if any model has no price; 0 without calls."""
    a = costs.agg(F.coalesce(F.bool_or(F.col("cost_usd").isNull()), F.lit(False)).alias("gap"), F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("s"))
    return a.select(F.when(~F.col("gap"), F.round("s", 6)).alias("cost_usd"), F.when(F.col("gap"), "some models have no price").alias("note"))


def stat_summary(value: Column) -> Column:
    """count, max, p50, p95, p99 of the non-null values (linear interpolation); null without any."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return F.when(F.count(value) > 0, F.struct(F.count(value).alias("count"), F.max(value).cast("double").alias("max"), p[0].alias("p50"), p[1].alias("p95"), p[2].alias("p99")))


#: A group of more rows than this has its percentiles selected by ranges of values instead of in one task.
GROUP_ROWS = 1_000_000
RANKS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def summarised(rows: DataFrame, keys: list[str], *aggregates: Column, most: int = GROUP_ROWS, ranges: int | None = None, **values: Column) -> DataFrame:
    """rows grouped by keys: the aggregates, and stat_summary of each of the values. Groups of any size: where one has more than
    `most` rows, by `selected`."""
    largest = rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= most:
        return rows.groupBy(*keys).agg(*aggregates, *(stat_summary(v).alias(c) for c, v in values.items()))
    out = rows.groupBy(*keys).agg(*aggregates) if aggregates else rows.select(*keys).distinct()
    for name, value in values.items():
        own = selected(rows.select(*keys, value.cast("double").alias("v")), keys, name, ranges).withColumnsRenamed({k: f"of_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys]
        out = out.join(own, reduce(and_, same), "left").drop(*(f"of_{k}" for k in keys))
    return out


def selected(rows: DataFrame, keys: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """(keys, name) of rows(keys, v), name being a stat_summary, for groups of any size.

    Distinct values with their counts are dealt into ranges of (keys, value), so that a large group spreads over many. Ranges know
    how many rows of a group come before them, and only those that hold a wanted rank are ordered, each in a task of its own.
    """
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.where("v is not null").groupBy(*keys, "v").agg(F.count("*").alias("c"))
    dealt = scratch.stored(counted.repartitionByRange(n, *keys, "v").withColumn("part", F.spark_partition_id()), "ranges")
    w = W.partitionBy(*keys)
    parts = dealt.groupBy(*keys, "part").agg(F.sum("c").alias("size"), F.max("v").alias("top"))
    parts = parts.withColumns({"before": F.sum("size").over(w.orderBy("part")) - F.col("size"), "count": F.sum("size").over(w), "max": F.max("top").over(w)})
    place = {p: F.lit(q) * (F.col("count") - 1) for p, q in RANKS.items()}
    ends = {f"{p}_{side}": (F.floor(x) if side == "low" else F.least(F.floor(x) + 1, F.col("count") - 1)) for p, x in place.items() for side in ("low", "high")}
    parts = scratch.stored(parts.withColumns(ends), "ranks")
    holds = lambda e, a, b: (F.col(e) >= a) & (F.col(e) < b)
    wanted = parts.where(reduce(or_, (holds(e, F.col("before"), F.col("before") + F.col("size")) for e in ends)))
    wanted = wanted.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.col("part").alias("of_part"), "before", *ends)
    near = dealt.join(wanted, reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys] + [F.col("part") == F.col("of_part")]))
    upto = F.sum("c").over(W.partitionBy(*keys, "part").orderBy("v")) + F.col("before")
    at = near.withColumn("upto", upto).groupBy(*keys).agg(*(F.max(F.when(holds(e, F.col("upto") - F.col("c"), F.col("upto")), F.col("v"))).alias(f"v_{e}") for e in ends))
    heads = parts.groupBy(*keys).agg(F.max("count").alias("count"), F.max("max").alias("max"))
    both = heads.join(at.withColumnsRenamed({k: f"at_{k}" for k in keys}), reduce(and_, [F.col(k).eqNullSafe(F.col(f"at_{k}")) for k in keys]))
    between = {p: F.col(f"v_{p}_low") + (F.col(f"v_{p}_high") - F.col(f"v_{p}_low")) * (x - F.floor(x)) for p, x in place.items()}
    return both.select(*keys, F.struct("count", "max", *(v.alias(p) for p, v in between.items())).alias(name))
