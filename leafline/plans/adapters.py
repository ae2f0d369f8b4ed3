"""The driver's tables in the shapes that the operators take, as DataFrames and as SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions import text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("model"), start.alias("started_at"), (start + F.col("value") * 60).alias("ended_at"),
        (F.col("event_id") % 500).alias("input_tokens"), (F.col("user_id") % 100).alias("output_tokens"), (F.col("event_type") == "error").alias("errored"),
    )


CALLS = "calls AS (SELECT event_type AS model, epoch_us(ts) / 1e6 AS started_at, epoch_us(ts) / 1e6 + value * 60 AS ended_at, event_id % 500 AS input_tokens, user_id % 100 AS output_tokens, event_type = 'error' AS errored FROM events)"


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    nic = F.when(F.col("event_id") % 5 == 0, "lo").otherwise(F.concat(F.lit("eth"), (F.col("event_id") % 2).cast("string")))
    return table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("instance"), F.col("event_type").alias("metric"), nic.alias("interface"), F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")


METRICS = "metrics AS (SELECT user_id % 40 AS instance, event_type AS metric, CASE WHEN event_id % 5 = 0 THEN 'lo' ELSE 'eth' || (event_id % 2) END AS interface, ts, value, event_id FROM events)"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("page_idx", "text"))
    return lines.withColumns({"token_count": text.count_tokens(F.col("text")), "words": text.word_count(F.col("text"))})


PAGES = "pages_ AS (SELECT doc_id AS doc, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS page_idx, unnest(string_split(text, chr(10))) AS text FROM documents)"

STRUCTURE = "CASE {o} WHEN 1 THEN '1' WHEN 2 THEN '1.1' WHEN 3 THEN '1.1.1' WHEN 4 THEN '1.2' WHEN 5 THEN '2' WHEN 6 THEN '2.1' ELSE '3.' || {o} END"


def toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    o = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    t = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), o.alias("ord"), "l_linenumber", "l_quantity", "l_returnflag", "l_partkey")
    return t.select(
        "doc", "ord", F.expr(STRUCTURE.format(o="ord")).alias("structure"), F.concat(F.lit("Section "), F.col("l_partkey") % 7).alias("title"),
        F.when(F.col("l_quantity") <= 25, F.col("l_linenumber")).alias("physical_index"), F.when(F.col("l_returnflag") == "R", "yes").otherwise("no").alias("appear_start"), F.col("l_linenumber").alias("line"),
    )


TOC = f"""o_ AS (SELECT l_orderkey AS doc, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS ord, * FROM lineitem),
toc AS (SELECT doc, ord, {STRUCTURE.format(o="ord")} AS structure, 'Section ' || (l_partkey % 7) AS title, CASE WHEN l_quantity <= 25 THEN l_linenumber END AS physical_index, CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS appear_start, l_linenumber AS line FROM o_)"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree a region: the region, its nations, their suppliers."""
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    top = r.select(F.col("r_regionkey").alias("doc"), F.lit(0).cast("long").alias("ord"), F.lit(None).cast("long").alias("parent_ord"), F.col("r_name").alias("title"))
    mid = n.select(F.col("n_regionkey").alias("doc"), (F.lit(100) + F.col("n_nationkey")).cast("long").alias("ord"), F.lit(0).cast("long").alias("parent_ord"), F.col("n_name").alias("title"))
    low = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_regionkey").alias("doc"), (F.lit(10000) + F.col("s_suppkey")).alias("ord"), (F.lit(100) + F.col("n_nationkey")).cast("long").alias("parent_ord"), F.col("s_name").alias("title"))
    return top.unionByName(mid).unionByName(low)


PLACES = """places AS (SELECT r_regionkey AS doc, CAST(0 AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS parent_ord, r_name AS title FROM region
UNION ALL SELECT n_regionkey, 100 + n_nationkey, 0, n_name FROM nation
UNION ALL SELECT n_regionkey, 10000 + s_suppkey, 100 + n_nationkey, s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping nodes for each document."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.explode(F.array(*(F.struct(F.lit(k).alias("key"), F.lit(n).alias("dfs"), F.lit(a).alias("start_index"), F.lit(b).alias("end_index")) for n, (k, a, b) in enumerate((("root", 1, 5), ("first", 2, 3), ("last", 3, 99), ("none", 4, 3)))))).alias("x")).select("doc", "x.*")


RANGES = "ranges AS (SELECT doc_id AS doc, x.* FROM documents, (VALUES ('root', 0, 1, 5), ('first', 1, 2, 3), ('last', 2, 3, 99), ('none', 3, 4, 3)) x(key, dfs, start_index, end_index))"


def cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    title = F.when(k % 11 < 7, F.concat(F.lit("A. B. "), F.col("c_name"))).when(k % 11 == 8, F.concat("c_name", F.lit(", 2016, 6, 16"))).otherwise(F.col("c_name"))
    return table(spark, sf_dir, "customer").select(F.lit("d").alias("doc"), F.col("c_nationkey").alias("parent"), k.alias("ord"), title.alias("title"), (k % 40).alias("start_index"), (k % 40 + 1).alias("end_index"), (k % 13 != 0).alias("is_leaf"))


CITED = "cited AS (SELECT 'd' AS doc, c_nationkey AS parent, c_custkey AS ord, CASE WHEN c_custkey % 11 < 7 THEN 'A. B. ' || c_name WHEN c_custkey % 11 = 8 THEN c_name || ', 2016, 6, 16' ELSE c_name END AS title, c_custkey % 40 AS start_index, c_custkey % 40 + 1 AS end_index, c_custkey % 13 <> 0 AS is_leaf FROM customer)"


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderstatus") != "F"
    return o.select(
        F.col("o_orderkey").alias("item_ord"), F.concat(F.lit("doc-"), "o_orderkey").alias("document_id"), F.floor(F.col("o_orderkey") / 50).alias("shard"), F.when(ok, "success").otherwise("failure").alias("status"),
        F.when(ok & (F.col("o_orderkey") % 3 != 0), F.concat(F.lit("out/"), "o_orderkey", F.lit("/tree.json"))).alias("tree_path"),
        F.when(~ok, F.concat(F.lit("line one\nline two "), F.repeat(F.lit("x"), (F.col("o_orderkey") % 3000).cast("int")))).alias("error"),
    )


RESULTS = "results AS (SELECT o_orderkey AS item_ord, 'doc-' || o_orderkey AS document_id, CAST(floor(o_orderkey / 50) AS BIGINT) AS shard, CASE WHEN o_orderstatus <> 'F' THEN 'success' ELSE 'failure' END AS status, CASE WHEN o_orderstatus <> 'F' AND o_orderkey % 3 <> 0 THEN 'out/' || o_orderkey || '/tree.json' END AS tree_path, CASE WHEN o_orderstatus = 'F' THEN 'line one' || chr(10) || 'line two ' || repeat('x', CAST(o_orderkey % 3000 AS INTEGER)) END AS error FROM orders)"


def workflows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i, ts = table(spark, sf_dir, "events"), F.col("event_id"), F.col("ts").cast("timestamp")
    return e.select(
        i.alias("workflow_id"), F.when(i % 10 != 0, i - i % 10).alias("parent_id"), F.when(i % 4 == 0, "ProcessPdfWorkflow").otherwise(F.col("event_type")).alias("type"), ts.alias("started_at"),
        F.when(i % 7 != 0, F.timestamp_micros(F.unix_micros(ts) + F.floor(F.col("value") * 1000) * 1000)).alias("closed_at"),
        F.when(i % 9 == 0, "FAILED").when(i % 7 == 0, "RUNNING").otherwise("COMPLETED").alias("status"),
    )


WORKFLOWS = "workflows AS (SELECT event_id AS workflow_id, CASE WHEN event_id % 10 <> 0 THEN event_id - event_id % 10 END AS parent_id, CASE WHEN event_id % 4 = 0 THEN 'ProcessPdfWorkflow' ELSE event_type END AS type, ts AS started_at, CASE WHEN event_id % 7 <> 0 THEN make_timestamp(epoch_us(ts) + CAST(floor(value * 1000) AS BIGINT) * 1000) END AS closed_at, CASE WHEN event_id % 9 = 0 THEN 'FAILED' WHEN event_id % 7 = 0 THEN 'RUNNING' ELSE 'COMPLETED' END AS status FROM events)"


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled, started and terminal events in threes: event n belongs to the activity n // 3."""
    i = F.col("event_id")
    kind = F.when(i % 3 == 0, "scheduled").when(i % 3 == 1, "started").when(F.floor(i / 3) % 5 == 0, "failed").when(F.floor(i / 3) % 11 == 0, "timed_out").otherwise("completed")
    return table(spark, sf_dir, "events").select(F.floor(i / 300).alias("workflow_id"), F.floor(i / 3).alias("scheduled_id"), kind.alias("kind"), F.when(i % 3 == 0, F.col("event_type")).alias("activity_type"), (F.floor(i / 3) % 4 + 1).cast("int").alias("attempt"), F.col("ts").cast("timestamp").alias("ts"))


RUN_EVENTS = "run_events AS (SELECT CAST(floor(event_id / 300) AS BIGINT) AS workflow_id, CAST(floor(event_id / 3) AS BIGINT) AS scheduled_id, CASE WHEN event_id % 3 = 0 THEN 'scheduled' WHEN event_id % 3 = 1 THEN 'started' WHEN floor(event_id / 3) % 5 = 0 THEN 'failed' WHEN floor(event_id / 3) % 11 = 0 THEN 'timed_out' ELSE 'completed' END AS kind, CASE WHEN event_id % 3 = 0 THEN event_type END AS activity_type, CAST(floor(event_id / 3) % 4 + 1 AS INTEGER) AS attempt, ts FROM events)"
ACTIVITIES = f"""{RUN_EVENTS}, activities AS (SELECT workflow_id, scheduled_id, max(activity_type) AS activity_type, min(CASE WHEN kind = 'scheduled' THEN ts END) AS scheduled_at, max(CASE WHEN kind = 'started' THEN ts END) AS last_started_at,
max(CASE WHEN kind IN ('completed', 'failed', 'timed_out') THEN ts END) AS closed_at, CAST(coalesce(max(CASE WHEN kind = 'started' THEN attempt END), 0) AS INTEGER) AS attempts,
max(CASE kind WHEN 'completed' THEN 'success' WHEN 'failed' THEN 'failure' WHEN 'timed_out' THEN 'timed_out' END) AS outcome FROM run_events GROUP BY 1, 2 HAVING min(CASE WHEN kind = 'scheduled' THEN ts END) IS NOT NULL)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes on pages: parts as figures, tables and captions."""
    k = F.col("p_partkey")
    label = F.element_at(F.array(*map(F.lit, ("figure", "figure_caption", "table", "table_caption", "isolate_formula", "plain_text"))), (k % 6 + 1).cast("int"))
    x0, y0 = (k * 37) % 400, (k * 53) % 900
    return table(spark, sf_dir, "part").select(F.floor(k / 60).alias("doc"), (F.floor(k / 12) % 5).cast("int").alias("page"), k.alias("ord"), label.alias("label"), (F.col("p_size") / 50).alias("confidence"), x0.alias("x0"), y0.alias("y0"), (x0 + 150).alias("x1"), (y0 + 40).alias("y1"), F.lit(600).alias("width"), F.lit(1000).alias("height"), F.col("p_name").alias("name"), F.format_string("%04d", (k % 9).cast("int")).alias("node_id"))


BOXES = "boxes AS (SELECT CAST(floor(p_partkey / 60) AS BIGINT) AS doc, CAST(floor(p_partkey / 12) % 5 AS INTEGER) AS page, p_partkey AS ord, ['figure', 'figure_caption', 'table', 'table_caption', 'isolate_formula', 'plain_text'][CAST(p_partkey % 6 + 1 AS INTEGER)] AS label, p_size / 50 AS confidence, (p_partkey * 37) % 400 AS x0, (p_partkey * 53) % 900 AS y0, (p_partkey * 37) % 400 + 150 AS x1, (p_partkey * 53) % 900 + 40 AS y1, 600 AS width, 1000 AS height, p_name AS name, printf('%04d', p_partkey % 9) AS node_id FROM part)"
