"""Line dedup by distinct-site spread: lines that many sites repeat are boilerplate and are removed everywhere.

1. One aggregation over line hashes counts occurrences and the least and greatest site hash. A line with fewer
   occurrences than the threshold, or of one site, cannot reach it.
2. The others get a HyperLogLog sketch of their sites, made in each task and merged by aggregation. Estimates clear of the
   threshold by MARGIN decide; lines nearer than that get exact distinct counts, and only their (line, site) pairs are shuffled.
3. While the removed lines are few (counted), documents are cleaned where they are, against a table of the lines' hashes
   that goes to every task; beyond that, documents that hold one are found by (document, line hash), and joined.

A line is what stands between line feeds; it is compared without the blanks (U+0020) at its ends, other white space counts;
blank lines are kept. Everything is DataFrame operations: no Python runs on the executors.

Defined cases: null text stays null, with no line removed; a null source is a site of its own; a null doc_id is a document
like others; repeated rows are cleaned alike; lines recur within a document without adding sites; a document whose lines
all go keeps an empty text; an empty table gives no rows; further columns pass through `dedup_lines` unchanged, but one
named n_removed is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common

#: Sites that make a line boilerplate. A passage that a dozen documents share may stand at few sites where one source is hot.
SITES = 5
MARGIN = 0.25
LG_K = 12


def lines_of(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def site_lines(documents: DataFrame) -> DataFrame:
    """(site, line): a row for each distinct line of a document."""
    own = F.array_distinct(F.transform(F.filter(lines_of("text"), lambda x: F.trim(x) != ""), line_hash))
    return documents.select(F.coalesce(F.xxhash64("source"), F.lit(0)).alias("site"), F.explode(own).alias("line"))


def spread(documents: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """(line, n_sites, exact) of the lines that at least `sites` distinct sites hold.

    n_sites is an estimate where exact is false; those lie beyond (1 + margin) * sites, fifteen standard errors of the sketch.
    """
    each = site_lines(documents)
    often = each.groupBy("line").agg(F.count("*").alias("n"), F.min("site").alias("a"), F.max("site").alias("b")).where((F.col("n") >= sites) & ((F.col("a") != F.col("b")) | F.lit(sites <= 1))).select("line", "n")
    often = common.stored(often, "often")
    sketched = chosen(each, often).groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("estimate"))
    sketched = common.stored(sketched, "sketched")
    near = sketched.where(F.col("estimate").between(sites * (1 - margin), sites * (1 + margin))).select("line")
    near = common.stored(near.join(often, "line"), "near")
    exact = chosen(each, near).groupBy("line").agg(F.countDistinct("site").alias("n_sites")).where(F.col("n_sites") >= sites)
    sure = sketched.where(F.col("estimate") > sites * (1 + margin))
    return sure.select("line", F.col("estimate").alias("n_sites"), F.lit(False).alias("exact")).union(exact.select("line", "n_sites", F.lit(True).alias("exact")))


def chosen(each: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of each(site, line) whose line is in lines(line, n): the lines are broadcast while they are few; beyond that only
    those of very many rows are, whose rows stay where they are."""
    if common.few(lines):
        return each.join(F.broadcast(lines.select("line")), "line")
    return common.joined(each, lines, "line", lines.agg(F.sum("n")).first()[0])


def dedup_lines(documents: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """documents with boilerplate lines cut from text, and a column n_removed."""
    out = _cleaned(documents, sites, margin)
    return out.select(*common.unboxed(out, text=F.col("text"), n_removed=F.col("removed")))


def cleaned(documents: DataFrame, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """documents with boilerplate lines cut from text and n_chars, if there is one, following it; other columns as they are."""
    out = _cleaned(documents, sites, margin)
    n = {"n_chars": F.length("text").cast(documents.schema["n_chars"].dataType)} if "n_chars" in documents.columns else {}
    return out.select(*common.unboxed(out, text=F.col("text"), **n))


def _cleaned(documents: DataFrame, sites: int, margin: float) -> DataFrame:
    """(row, text, removed): each document's columns in a box, its text without boilerplate lines, and their number."""
    gone = common.stored(spread(documents, sites, margin).select("line"), "boilerplate")
    rows = documents.select(common.boxed(documents), F.col("text").alias("t"))
    n = gone.count()
    if n <= common.BROADCAST_ROWS:
        # the hashes in as many lists as there are lines, some of them empty: a look-up reads one short list
        size = max(1, n)
        lists = gone.groupBy(F.pmod("line", F.lit(size)).alias("at")).agg(F.collect_list("line").alias("own"))
        table = gone.sparkSession.range(size).join(F.broadcast(lists), F.col("id") == F.col("at"), "left")
        table = table.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("own", F.array().cast("array<long>")).alias("own")))), lambda x: x["own"]).alias("lists"))
        rows = rows.withColumn("lists", table.scalar())
        held = lambda h: F.array_contains(F.get("lists", F.pmod(h, F.lit(size)).cast("int")), h)
    else:
        key = lambda: F.struct(F.xxhash64("row.doc_id", "t"), F.xxhash64(F.lit(1), F.col("row.doc_id"), F.col("t")))
        rows = rows.withColumn("key", key())
        own = rows.where("t is not null").select("key", F.explode(F.array_distinct(F.transform(lines_of("t"), line_hash))).alias("line"))
        bad = own.join(gone, "line").distinct().groupBy("key").agg(F.collect_list("line").alias("gone"))  # a document's own lines at most
        rows = rows.join(common.maybe_broadcast(common.stored(bad, "affected")), "key", "left")
        held = lambda h: F.array_contains(F.coalesce("gone", F.array().cast("array<long>")), h)
    kept = F.filter(lines_of("t"), lambda x: (F.trim(x) == "") | ~held(line_hash(x)))
    out = rows.select("row", "t", kept.alias("kept"))
    removed = F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.size(lines_of("t")) - F.size("kept")).cast("int")
    out = out.select("row", "t", "kept", removed.alias("removed"))
    text = F.when(F.col("removed") == 0, F.col("t")).otherwise(F.array_join("kept", "\n"))
    return out.select("row", text.alias("text"), "removed")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(common.read(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


OP8_SQL = f"""
WITH each AS (SELECT DISTINCT source, trim(x, ' ') AS line FROM (SELECT source, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE trim(x, ' ') <> ''),
gone AS (SELECT line FROM each GROUP BY line HAVING count(*) >= {SITES}),
l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS n, unnest(string_split(text, chr(10))) AS x FROM documents),
k AS (SELECT l.*, (trim(x, ' ') <> '' AND gone.line IS NOT NULL) AS bad FROM l LEFT JOIN gone ON gone.line = trim(x, ' '))
SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY n) FILTER (WHERE NOT bad), '') AS text, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS INTEGER) AS n_removed
FROM k GROUP BY doc_id
"""
