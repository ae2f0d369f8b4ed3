"""Batches: manifests, shards, item results and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.functions import ids, text

SHARD = 50
RANGE_ITEMS = 100_000
ITEM_LIMIT, SHARD_LIMIT, REPORT_LIMIT = 2000, 1500, 500


def manifest_errors(items: DataFrame) -> DataFrame:
    """(item_ord, document_id, error) of items(item_ord, document_id) with a bad or a repeated id."""
    n = F.count("*").over(W.partitionBy("document_id"))
    e = F.when(F.coalesce("document_id", F.lit("")) == "", "empty id").when(~ids.valid_id(F.col("document_id")), "bad id").when(n > 1, "repeated id")
    return items.withColumn("error", e).where("error is not null").select("item_ord", "document_id", "error")


def validated(items: DataFrame) -> DataFrame:
    """items, or an error if there is none or any is bad."""
    bad = manifest_errors(items).limit(1).collect()
    if bad:
        raise ValueError(f"manifest item {bad[0]['item_ord']}: {bad[0]['error']}")
    if items.isEmpty():
        raise ValueError("a manifest needs an item")
    return items


def sharded(items: DataFrame, batch: str, size: int = SHARD) -> DataFrame:
    """items with shard and shard_id: `size` consecutive items each, by item_ord.

    An item's number is its range's base, from counts of equal ranges of item_ord, plus its place there: no single-task sort.
    """
    if size <= 0:
        raise ValueError("shard size must be positive")
    lo, hi, n = items.agg(F.min("item_ord"), F.max("item_ord"), F.count("*")).first()
    ranges = max(1, n // RANGE_ITEMS)
    step = max(1, -(-((hi or 0) - (lo or 0) + 1) // ranges))
    dealt = items.withColumn("__p", F.floor((F.col("item_ord") - (lo or 0)) / step))
    base = dealt.groupBy("__p").agg(F.count("*").alias("__c")).withColumn("__base", F.coalesce(F.sum("__c").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__c")  # a row a range
    local = dealt.withColumn("__n", F.row_number().over(W.partitionBy("__p").orderBy("item_ord")) - 1)
    shard = F.floor((F.col("__base") + F.col("__n")) / size)
    return local.join(base, "__p").withColumn("shard", shard).withColumn("shard_id", ids.shard_id(F.lit(batch), F.col("shard"))).drop("__p", "__n", "__base")


def counts(results: DataFrame) -> DataFrame:
    """(shard, succeeded, failed), and a row with a null shard for the whole."""
    return results.rollup("shard").agg(F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") != "success").alias("failed"))


def indexable(results: DataFrame) -> DataFrame:
    return results.where((F.col("status") == "success") & (F.coalesce("tree_path", F.lit("")) != ""))


def report_rows(results: DataFrame) -> DataFrame:
    """results as text cells: nulls are blank, errors on one line and cut at 500 characters."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    error = F.substring(F.replace(F.coalesce("error", F.lit("")), F.lit("\n"), F.lit(" ")), 1, REPORT_LIMIT).alias("error")
    return results.select(*(error if c == "error" else cell(c) for c in results.columns))


def shortened(results: DataFrame, limit: int = ITEM_LIMIT) -> DataFrame:
    return results.withColumn("error", text.truncated(F.col("error"), limit))


def failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "success").select("document_id", "error")


def duration(literal: Column) -> Column:
    """30s, 15m, 24h, 7d as seconds; null for anything else."""
    n = F.regexp_extract(literal, r"^(\d+)[smhd]$", 1).try_cast("long")
    unit = F.regexp_extract(literal, r"^\d+([smhd])$", 1)
    return n * F.when(unit == "s", 1).when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400)


def human_duration(seconds: Column) -> Column:
    """Seconds or minutes with one decimal, hours with two."""
    return F.when(seconds < 60, F.format_string("%.1fs", seconds)).when(seconds < 3600, F.format_string("%.1fm", seconds / 60)).otherwise(F.format_string("%.2fh", seconds / 3600))


def signed(value: Column) -> Column:
    """Two decimals with a sign; a bare 0."""
    return F.when(value == 0, "0").otherwise(F.concat(F.when(value > 0, "+").otherwise("−"), F.format_string("%.2f", F.abs(value))))


def ratio(value: Column) -> Column:
    return F.when(F.isnan(value), "—").otherwise(F.format_string("%.2f×", value))


def of_batch(items: DataFrame, batch: str) -> DataFrame:
    """items, failing on one of another batch."""
    same = F.coalesce(F.col("batch_id") == batch, F.lit(False))
    return items.where(F.assert_true(same, F.lit(f"the manifest is not of batch {batch}")).isNull())


def with_failed_shards(items: DataFrame, results: DataFrame, failed: DataFrame) -> DataFrame:
    """(item_ord, document_id, shard, status, error) of every item in order of its manifest: its result; where its shard failed,
    or gave no result for it, a failure. failed(shard, error) overrules what the shard's items had reached."""
    r = results.select("item_ord", F.col("status").alias("own"), F.col("error").alias("own_error"))
    j = items.select("item_ord", "document_id", "shard").join(r, "item_ord", "left").join(failed.select("shard", F.col("error").alias("reason")), "shard", "left")
    lost = F.col("reason").isNotNull()
    told = F.when(lost, text.truncated(F.concat(F.lit("shard-level failure: "), "reason"), SHARD_LIMIT)).when(F.col("own").isNull(), "no result").otherwise(F.col("own_error"))
    return j.select("item_ord", "document_id", "shard", F.when(lost | F.col("own").isNull(), "failure").otherwise(F.col("own")).alias("status"), told.alias("error"))


def pending(targets: DataFrame, ready: DataFrame) -> DataFrame:
    """The targets that aren't ready."""
    return targets.select("name").distinct().join(ready.select("name").distinct(), "name", "left_anti")


def preview(items: DataFrame, n: int = 5) -> DataFrame:
    return items.orderBy("item_ord").limit(n)
