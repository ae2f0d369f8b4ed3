"""Run history: records from events, statistics by type, windows of runs, anomaly flags and side-by-side comparisons.

Statuses, outcomes and event kinds are plain strings. A run is workflows(workflow_id, parent_id, type, started_at,
closed_at, status); activities(workflow_id, activity_type, scheduled_at, last_started_at, closed_at, attempts, outcome).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators import scratch
from leafline.operators.intervals import summarised

# Outcomes by terminal event, the type that counts as an item, flag limits.
OUTCOMES = {"completed": "success", "failed": "failure", "timed_out": "timed_out", "canceled": "canceled"}
ITEM_TYPE = "ProcessPdfWorkflow"
LONG_TAIL, CPU_LIMIT, MEMORY_LIMIT = 5, 95, 90


def subtree(workflows: DataFrame, root: str) -> DataFrame:
    """The run `root` and all runs started under it, each once, level by level until one is empty."""
    level = workflows.where(F.col("workflow_id") == root).withColumn("__path", F.array("workflow_id"))
    out = level
    while True:
        above = level.select(F.col("workflow_id").alias("__up"), F.col("__path").alias("__above")).dropDuplicates(["__up"])
        level = workflows.join(above, F.col("parent_id") == F.col("__up")).where(~F.coalesce(F.array_contains("__above", F.col("workflow_id")), F.lit(False)))
        level = level.withColumn("__path", F.concat("__above", F.array("workflow_id"))).drop("__up", "__above")
        level = scratch.stored(level, "level")
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.drop("__path").dropDuplicates(["workflow_id"])


def closed_between(workflows: DataFrame, kind: str, since: Column, until: Column) -> DataFrame:
    return workflows.where((F.col("type") == kind) & F.col("closed_at").between(since, until))


def folded(events: DataFrame) -> DataFrame:
    """activities from events(workflow_id, scheduled_id, kind, activity_type, attempt, ts): one row for each scheduled event."""
    at = lambda *k: F.when(F.col("kind").isin(*k), F.col("ts"))
    g = events.groupBy("workflow_id", "scheduled_id").agg(
        F.max(F.when(F.col("kind") == "scheduled", F.col("activity_type"))).alias("activity_type"),
        F.min(at("scheduled")).alias("scheduled_at"),
        F.max(at("started")).alias("last_started_at"),
        F.max(at(*OUTCOMES)).alias("closed_at"),
        F.coalesce(F.max(F.when(F.col("kind") == "started", F.col("attempt"))), F.lit(0)).alias("attempts"),
        F.max_by("kind", F.when(F.col("kind").isin(*OUTCOMES), F.col("ts"))).alias("last"),
    )
    outcome = F.coalesce(*(F.when(F.col("last") == k, F.lit(v)) for k, v in OUTCOMES.items()))
    return g.where("scheduled_at is not null").withColumn("outcome", outcome).drop("last")


def seconds(start: str, end: str) -> Column:
    return (F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))) / 1e6


def workflow_stats(workflows: DataFrame) -> DataFrame:
    """By type: count, successes, failures, others, and durations of the closed ones."""
    g = summarised(workflows, ["type"], F.count("*").alias("count"), F.count_if(F.col("status") == "COMPLETED").alias("success_count"), F.count_if(F.col("status") == "FAILED").alias("failure_count"), duration=seconds("started_at", "closed_at"))
    return g.withColumn("other_count", F.col("count") - F.col("success_count") - F.col("failure_count"))


def activity_stats(activities: DataFrame) -> DataFrame:
    """By type: count, successes, failures (time-outs too, cancellations not), retries, and both durations."""
    return summarised(
        activities, ["activity_type"],
        F.count("*").alias("count"),
        F.count_if(F.col("outcome") == "success").alias("success_count"),
        F.count_if(F.col("outcome").isin("failure", "timed_out")).alias("failure_count"),
        F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))).cast("long").alias("retry_count"),
        schedule_to_close=seconds("scheduled_at", "closed_at"),
        start_to_close=seconds("last_started_at", "closed_at"),
    )


def items(stats: DataFrame) -> DataFrame:
    """(items, succeeded, failed) of the item type; zeros without it."""
    w = F.col("type") == ITEM_TYPE
    s = lambda c: F.coalesce(F.sum(F.when(w, c)), F.lit(0)).cast("long")
    return stats.agg(s(F.col("count")).alias("items"), s(F.col("success_count")).alias("succeeded"), s(F.col("failure_count") + F.col("other_count")).alias("failed"))


def batch_window(workflows: DataFrame, root: str) -> DataFrame:
    return workflows.where(F.col("workflow_id") == root).select("started_at", "closed_at", "status")


def flags(activities: DataFrame, workflows: DataFrame, hosts: DataFrame) -> DataFrame:
    """(subject, flag): failures, retries, long tails, failed items, saturated hosts. hosts(instance, cpu, memory) hold summaries."""
    a, s = F.col("activity_type"), "start_to_close"
    one = lambda df, who, cond, *msg: df.where(cond).select(who.alias("subject"), F.format_string(*msg).alias("flag"))
    out = [
        one(activities, a, F.col("failure_count") > 0, "Activity %s: %d/%d terminal failures", a, "failure_count", "count"),
        one(activities, a, F.col("retry_count") > 0, "Activity %s: %d total retries across %d invocations", a, "retry_count", "count"),
        one(activities, a, (F.col(f"{s}.p50") > 0) & (F.col(f"{s}.p99") / F.col(f"{s}.p50") > LONG_TAIL), "Activity %s: p99=%.1fs vs p50=%.1fs (>5x — long tail)", a, f"{s}.p99", f"{s}.p50"),
        one(workflows, F.col("type"), (F.col("type") == ITEM_TYPE) & (F.col("failure_count") > 0), f"%d/%d {ITEM_TYPE} runs failed", "failure_count", "count"),
        one(hosts, F.col("instance"), F.col("cpu.p95") > CPU_LIMIT, "Instance %s: CPU p95=%.0f%% — saturated", F.col("instance"), "cpu.p95"),
        one(hosts, F.col("instance"), F.col("memory.max") > MEMORY_LIMIT, "Instance %s: memory max=%.0f%% — near limit", F.col("instance"), "memory.max"),
    ]
    first = out[0]
    for o in out[1:]:
        first = first.unionByName(o)
    return first


def compared(live: DataFrame, batch: DataFrame, key: str, value: str) -> DataFrame:
    """(key, live, batch, delta, ratio) of either side's keys; a missing side is 0, a ratio to 0 is NaN."""
    j = live.select(key, F.col(value).alias("live")).join(batch.select(key, F.col(value).alias("batch")), key, "full_outer").na.fill(0.0, ["live", "batch"])
    return j.select(key, "live", "batch", (F.col("live") - F.col("batch")).alias("delta"), F.when(F.col("batch") != 0, F.col("live") / F.col("batch")).otherwise(F.lit(float("nan"))).alias("ratio"))


def per_hour(count: Column, duration_s: Column) -> Column:
    return F.when(duration_s > 0, count / (duration_s / 3600.0)).otherwise(F.lit(0.0))


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, part / whole).otherwise(F.lit(0.0))
