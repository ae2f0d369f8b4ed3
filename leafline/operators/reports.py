"""Reports over runs and hosts: batch and live windows, comparisons, run records, and their Markdown and JSON."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.operators import history, hosts
from leafline.sources import sinks


@dataclass
class Report:
    """What a report holds, as tables of a row for each type or host."""

    workflows: DataFrame
    activities: DataFrame
    items: DataFrame
    window: DataFrame
    hosts: DataFrame
    flags: DataFrame


def of_runs(workflows: DataFrame, events: DataFrame, metrics: DataFrame, window: DataFrame) -> Report:
    w = history.workflow_stats(workflows).orderBy("type")
    a = history.activity_stats(history.folded(events.join(workflows.select("workflow_id"), "workflow_id", "left_semi"))).orderBy("activity_type")
    s = hosts.summaries(metrics)
    pick = lambda m: F.max_by("summary", F.when(F.col("metric") == m, F.lit(1)))
    h = s.groupBy(F.col("instance").cast("string").alias("instance")).agg(pick("cpu").alias("cpu"), pick("memory").alias("memory"))
    return Report(w, a, history.items(w), window, h, history.flags(a, w, h))


def batch_report(workflows: DataFrame, events: DataFrame, metrics: DataFrame, root: str) -> Report:
    """The run `root` with everything under it."""
    return of_runs(history.subtree(workflows, root), events, metrics, history.batch_window(workflows, root))


def live_report(workflows: DataFrame, events: DataFrame, metrics: DataFrame, since, until) -> Report:
    """Item runs that closed in the window; its bounds need a time zone."""
    if since.tzinfo is None or until.tzinfo is None:
        raise ValueError("the window's bounds need a time zone")
    chosen = history.closed_between(workflows, history.ITEM_TYPE, F.lit(since), F.lit(until))
    window = workflows.sparkSession.createDataFrame([(since, until, None)], "started_at timestamp, closed_at timestamp, status string")
    return of_runs(chosen, events, metrics, window)


def comparison(live: Report, batch: Report, percentile: str = "p95") -> DataFrame:
    """Activities of either side by a percentile of their running time."""
    side = lambda r: r.activities.select("activity_type", F.col(f"start_to_close.{percentile}").alias("v"))
    return history.compared(side(live), side(batch), "activity_type", "v").orderBy("activity_type")


def as_json(report: Report) -> str:
    """The report's tables, which have a row for each type or host, as one JSON text."""
    return json.dumps({k: [json.loads(x) for x in df.toJSON().collect()] for k, df in vars(report).items()}, ensure_ascii=False, indent=2)


def scaled(size: float) -> str:
    """Bytes as B, KiB or MiB."""
    return f"{size:.0f} B" if size < 1024 else f"{size / 1024:.1f} KiB" if size < 1024**2 else f"{size / 1024**2:.1f} MiB"


def table(df: DataFrame) -> str:
    """Rows as a Markdown table; structs as JSON, numbers to two places, null as a dash."""

    def cell(v: object) -> str:
        return "—" if v is None else f"{v:.2f}" if isinstance(v, float) else json.dumps(v.asDict(), default=str) if hasattr(v, "asDict") else str(v)

    rows = df.collect()
    if not rows:
        return "_None._"
    return "\n".join([f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}", *(f"| {' | '.join(map(cell, r))} |" for r in rows)])


def as_markdown(report: Report, title: str) -> str:
    """Flags first, then the tables."""
    out = [f"# {title}", "", "## Flags", "", *(f"- {r['flag']}" for r in report.flags.orderBy("flag").collect()), ""]
    for name in ("window", "items", "workflows", "activities", "hosts"):
        df: DataFrame = getattr(report, name)
        out += [f"## {name.capitalize()}", "", table(df.orderBy(df.columns[0])), ""]
    return "\n".join(out)


def write_pair(report: Report, title: str, path: str) -> dict[str, str]:
    """report.json and report.md under path, in any store Spark writes."""
    spark = report.workflows.sparkSession
    for name, body in (("json", as_json(report)), ("md", as_markdown(report, title))):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/report.{name}")
        out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
        out.write(bytearray(body.encode()))
        out.close()
    return {name: f"{path}/report.{name}" for name in ("json", "md")}


#: What each table of a written report holds, as DDL; a row may lack what is null, but has no other fields.
STAT = "count long, max double, p50 double, p95 double, p99 double"
RECORDS = {
    "workflows": f"type string not null, count long not null, success_count long not null, failure_count long not null, duration struct<{STAT}>, other_count long not null",
    "activities": f"activity_type string, count long not null, success_count long not null, failure_count long not null, retry_count long, schedule_to_close struct<{STAT}>, start_to_close struct<{STAT}>",
    "items": "items long not null, succeeded long not null, failed long not null",
    "window": "started_at timestamp, closed_at timestamp, status string",
    "hosts": f"instance string not null, cpu struct<{STAT}>, memory struct<{STAT}>",
    "flags": "subject string, flag string not null",
}


def conforms(value: object, kind: T.DataType) -> bool:
    """Whether a JSON value is of this type: objects with no field more than the type's and all those that can't be null."""
    if value is None:
        return True
    if isinstance(kind, T.StructType):
        fields = {f.name: f for f in kind}
        return isinstance(value, dict) and value.keys() <= fields.keys() and all(f.nullable or value.get(n) is not None for n, f in fields.items()) and all(conforms(v, fields[k].dataType) for k, v in value.items())
    if isinstance(kind, T.ArrayType):
        return isinstance(value, list) and all(conforms(v, kind.elementType) for v in value)
    if isinstance(kind, T.NumericType):
        return isinstance(value, int | float) and not isinstance(value, bool) and (isinstance(kind, T.FractionalType) or value == int(value))
    return isinstance(value, bool) if isinstance(kind, T.BooleanType) else isinstance(value, str)


def cached(spark: SparkSession, path: str) -> dict | None:
    """A written report, or null where there is none or it isn't made of RECORDS."""
    try:
        found = json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/report.json").collect()))
    except Exception:  # noqa: BLE001 - then it is built again
        return None
    fine = isinstance(found, dict) and found.keys() == RECORDS.keys() and all(isinstance(rows, list) and all(isinstance(r, dict) and conforms(r, T.StructType.fromDDL(RECORDS[k])) for r in rows) for k, rows in found.items())
    return found if fine else None


def side_by_side(pulls: dict[str, Callable[[], object]], enabled: dict[str, bool] | None = None) -> dict[str, object]:
    """The results of independent pulls, each a job or several, run at once, each in a fair pool of its own; None for those that
    aren't enabled. Where several fail the first one's error, in the order of their names, is raised when all have ended."""
    spark = SparkSession.active()

    def within(name: str, pull: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return pull()

    chosen = {n: p for n, p in pulls.items() if (enabled or {}).get(n, True)}
    with ThreadPoolExecutor(max(1, len(chosen))) as pool:
        begun = {n: pool.submit(inheritable_thread_target(spark)(within), n, p) for n, p in chosen.items()}
    return {n: begun[n].result() if n in begun else None for n in sorted(pulls)}


def rows(report: Report) -> DataFrame:
    """(section, subject, name, value) of a report's numbers."""
    long = lambda df, section, subject, **values: df.select(F.lit(section).alias("section"), F.col(subject).cast("string").alias("subject"), F.explode(F.array(*(F.struct(F.lit(k).alias("name"), v.cast("double").alias("value")) for k, v in values.items()))).alias("x")).select("section", "subject", "x.*")
    counts = lambda *names: {n: F.col(n) for n in names}
    stats = lambda *names: {f"{n}_{p}": F.col(f"{n}.{p}") for n in names for p in ("max", "p50", "p95", "p99")}
    out = long(report.workflows, "workflows", "type", **counts("count", "success_count", "failure_count", "other_count"), **stats("duration"))
    out = out.unionAll(long(report.activities, "activities", "activity_type", **counts("count", "success_count", "failure_count", "retry_count"), **stats("schedule_to_close", "start_to_close")))
    out = out.unionAll(long(report.hosts, "hosts", "instance", **stats("cpu", "memory")))
    return out.unionAll(long(report.items.withColumn("all", F.lit("all")), "items", "all", **counts("items", "succeeded", "failed")))


def run_record(method: str, document_id: str, started_at: str, ended_at: str, inputs: dict, result: dict | None, metrics: dict | None = None, error: str | None = None) -> dict:
    """One run as a dictionary; without a result its status is error."""
    return {"method": method, "document_id": document_id, "inputs": inputs, "started_at": started_at, "ended_at": ended_at, "status": "ok" if result is not None else "error", "error": error, "result": result, "metrics": metrics or {}}


def write_run_record(spark: SparkSession, record: dict, folder: str) -> str:
    """A run's record as JSON under its document and start, in any store that Spark writes; returns its address."""
    name = "".join(c if c.isalnum() else "-" for c in record["started_at"])
    return sinks.write_bytes(spark, f"{folder.rstrip('/')}/{record['document_id']}/{record['method']}-{name}.json", json.dumps(record, ensure_ascii=False, indent=2).encode())
