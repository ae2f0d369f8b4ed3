"""Host metrics: sampled series, rates, throughput over interfaces, and summaries by instance. metrics(instance, metric, interface, ts, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.operators.intervals import summarised

# Sampling periods by age in days.
PERIODS = ((15, 60), (63, 300))
OLDEST_PERIOD = 3600
PAD_BEFORE_S, PAD_AFTER_S = 60, 120


def period(age_days: Column) -> Column:
    """Seconds a sample covers, coarser with age."""
    out = F.when(age_days <= PERIODS[0][0], PERIODS[0][1])
    for days, s in PERIODS[1:]:
        out = out.when(age_days <= days, s)
    return out.otherwise(OLDEST_PERIOD)


def padded(start: Column, end: Column) -> tuple[Column, Column]:
    return start - F.make_dt_interval(secs=F.lit(PAD_BEFORE_S)), end + F.make_dt_interval(secs=F.lit(PAD_AFTER_S))


def sampled(metrics: DataFrame, seconds: int) -> DataFrame:
    """The average of each series in periods of so many seconds."""
    return metrics.groupBy("instance", "metric", F.window("ts", f"{seconds} seconds").alias("w")).agg(F.avg("value").alias("value")).select("instance", "metric", F.col("w.start").alias("ts"), "value")


def rates(counters: DataFrame) -> DataFrame:
    """Increase per second of each counter since its sample before."""
    w = W.partitionBy("instance", "metric", "interface").orderBy("ts")
    dt = (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))) / 1e6
    return counters.withColumn("rate", F.when(dt > 0, (F.col("value") - F.lag("value").over(w)) / dt)).where("rate is not null")


def instances(metrics: DataFrame) -> DataFrame:
    return metrics.select("instance").distinct().orderBy("instance")


def interfaces(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("interface").isNotNull() & (F.col("interface") != "lo")).select("instance", "interface").distinct().orderBy("instance", "interface")


def throughput(metrics: DataFrame) -> DataFrame:
    """(instance, summary): values of all but the loopback interface, summed at each time, then summarised."""
    at = metrics.where("interface is null or interface <> 'lo'").groupBy("instance", "ts").agg(F.sum("value").alias("v"))
    return summarised(at, ["instance"], summary=F.col("v"))


def summaries(metrics: DataFrame) -> DataFrame:
    return summarised(metrics, ["instance", "metric"], summary=F.col("value"))


def seen(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("instance").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def last_value(metrics: DataFrame) -> DataFrame:
    """(instance, metric, value) at the latest time."""
    return metrics.groupBy("instance", "metric").agg(F.max_by("value", "ts").alias("value"))


def average_p95(summary_rows: DataFrame) -> DataFrame:
    """(metric, avg_p95) over instances; 0 where there is none."""
    return summary_rows.groupBy("metric").agg(F.coalesce(F.avg("summary.p95"), F.lit(0.0)).alias("avg_p95"))
