"""URL filters by a temporal list join.

A list is a table of dated entries (entry, kind, action, at): kind is domain (the host and all under it), host (that host
alone) or path (host and leading path segments, whose case counts); action is add or remove. Per entry, consecutive dates become validity
intervals [from, until). A capture is expanded to the keys that could be listed: its host's parent domains, its host and
its path's prefixes, and an equi-join with an as-of condition finds the entries active at its fetch time.

Captures are joined by broadcast while the list's counted intervals are under a bound, which keeps a host with a third of
all captures in place; beyond it the shuffle is salted on both sides. Everything is DataFrame operations.

Defined cases: a null or unparsable URL, or a null time, matches nothing and is allowed; entries with a null field are
ignored; an entry added twice stays listed; adding and removing at one instant leaves it removed; an entry removed before
it was added has no interval there; hosts compare in lower case, without port, user or trailing dot, while paths keep their
case; a host in brackets (IPv6) has no parent domain; repeated captures are judged alike; URLs of any length are judged whole;
empty tables give no rows; further columns pass through, but those named blocked, n_entries or since are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common

SALTS = 16

#: A dated list: (entry, kind, action, date).
ENTRIES = [
    ("casino-win.example.com", "domain", "add", "2024-02-01"),
    ("casino-win.example.com", "domain", "remove", "2024-05-15"),
    ("casino-win.example.com", "domain", "add", "2024-09-01"),
    ("free-bets.example.com", "domain", "add", "2024-03-10"),
    ("cheap-pills.example.com", "domain", "add", "2024-01-01"),
    ("cheap-pills.example.com", "domain", "remove", "2024-11-01"),
    ("ads-track.example.com", "domain", "add", "2024-06-01"),
    ("m.ads-track.example.com", "host", "add", "2024-01-15"),
    ("m.ads-track.example.com", "host", "remove", "2024-03-01"),
    ("example.net", "domain", "add", "2024-07-01"),
    ("example.net", "domain", "remove", "2024-07-08"),
    ("blog.tionsh.example.com/de", "path", "add", "2024-04-01"),
]


def entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ENTRIES, "entry string, kind string, action string, day string").select("entry", "kind", "action", F.col("day").cast("timestamp").alias("at"))


def normal(entry: Column, kind: Column) -> Column:
    """An entry as keys() spells it: its host in lower case, without dots and slashes at the end."""
    bare = F.rtrim(F.trim(entry), F.lit("./"))
    name = F.rtrim(F.lower(F.substring_index(bare, "/", 1)), F.lit("."))
    return F.when(kind == "path", F.concat(name, F.substr(bare, F.length(F.substring_index(bare, "/", 1)) + 1))).otherwise(F.lower(bare))


def intervals(listed: DataFrame) -> DataFrame:
    """(entry, kind, valid_from, valid_until) of dated add and remove entries; until is null while an entry stays listed."""
    clean = listed.where("entry is not null and kind in ('domain', 'host', 'path') and action in ('add', 'remove') and at is not null")
    clean = clean.select(normal(F.col("entry"), F.col("kind")).alias("entry"), "kind", "action", "at")
    days = clean.groupBy("entry", "kind", "at").agg(F.max("action").alias("action"))  # remove wins
    w = W.partitionBy("entry", "kind").orderBy("at")
    turns = days.withColumn("was", F.lag("action").over(w)).where("was is null or was <> action")
    ends = turns.withColumn("valid_until", F.lead("at").over(w)).where("action = 'add'")
    return ends.select("entry", "kind", F.col("at").alias("valid_from"), "valid_until")


def host(url: Column) -> Column:
    """The host in lower case, without user, port and trailing dot; empty where there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?(\[[^/?#\]]*\]|[^/?#:@]+)", 1)), F.lit("."))


def keys(url: Column) -> Column:
    """Structs (kind, entry) under which a URL could be listed."""
    name = host(url)
    labels = F.when(F.startswith(name, F.lit("[")), F.array(name)).otherwise(F.split(name, r"\."))
    path = F.regexp_extract(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/([^?#]*)", 1)
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("entry")))
    paths = F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.struct(F.lit("path").alias("kind"), F.concat_ws("/", name, F.array_join(F.slice(steps, F.lit(1), i), "/")).alias("entry")))).otherwise(F.array().cast("array<struct<kind:string,entry:string>>"))
    return F.when(name != "", F.concat(domains, F.array(F.struct(F.lit("host").alias("kind"), name.alias("entry"))), paths))


def matches(captures: DataFrame, listed: DataFrame, key: str, url: str, at: str) -> DataFrame:
    """(key, kind, entry, valid_from) of each capture and each entry active at its fetch time."""
    spans = common.stored(intervals(listed), "intervals").withColumnsRenamed({"kind": "k", "entry": "e"})
    rows = captures.select(F.col(key).alias("key"), F.col(at).alias("at"), F.explode(keys(F.col(url))).alias("x")).select("key", "at", "x.kind", "x.entry")
    active = (F.col("kind") == F.col("k")) & (F.col("entry") == F.col("e")) & (F.col("at") >= F.col("valid_from")) & (F.col("valid_until").isNull() | (F.col("at") < F.col("valid_until")))
    if common.few(spans):
        hit = rows.join(F.broadcast(spans), active)
    else:
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", "at"), F.lit(SALTS)))
        spans = spans.withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        hit = salted.join(spans, active & (F.col("salt") == F.col("s")))
    return hit.select("key", "kind", "entry", "valid_from")


def judged(captures: DataFrame, listed: DataFrame, id_: str, url: str, at: str) -> DataFrame:
    """captures with blocked, n_entries (entries active then) and since (the latest date from which one of them holds)."""
    own = [F.col(common.quoted(c)).alias(n) for c, n in ((id_, "id"), (url, "url"), (at, "at"))]
    unique = captures.select(*own).distinct().select(F.struct("id", "url", "at").alias("cap"), "url", "at")
    found = matches(unique, listed, "cap", "url", "at").groupBy("key").agg(F.count("*").alias("n"), F.max("valid_from").alias("from"))
    found = found.select(F.col("key.id").alias("id_"), F.col("key.url").alias("url_"), F.col("key.at").alias("at_"), "n", "from")
    rows = captures.select(common.boxed(captures), *own)
    out = rows.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("url") == F.col("url_")) & (F.col("at") == F.col("at_")), "left")
    return out.select(*common.unboxed(out, blocked=F.col("n").isNotNull(), n_entries=F.coalesce("n", F.lit(0)), since=F.col("from")))


def captures(pages: DataFrame) -> DataFrame:
    """pages(page_id, url) as captures: the table has no fetch time, so page n is taken as fetched n hours into 2024, round the year."""
    return pages.select("page_id", "url", (F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id"), F.lit(8784)) * 3600)).alias("fetched"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(captures(common.read(spark, sf_dir, "pages")), entries(spark), "page_id", "url", "fetched")
    return out.select("page_id", "url", "blocked", "n_entries", F.date_format("since", "yyyy-MM-dd").alias("since"))


_VALUES = ", ".join(f"('{e}', '{k}', '{a}', TIMESTAMP '{d}')" for e, k, a, d in ENTRIES)
OP7_SQL = f"""
WITH listed(entry, kind, action, day) AS (VALUES {_VALUES}),
turns AS (SELECT *, lead(day) OVER (PARTITION BY entry, kind ORDER BY day) AS until FROM listed),
spans AS (SELECT entry, kind, day AS valid_from, until FROM turns WHERE action = 'add'),
c AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours(page_id % 8784) AS fetched, rtrim(lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?(\\[[^/?#\\]]*\\]|[^/?#:@]+)', 1)), '.') AS host,
  regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+(/[^?#]*)', 1) AS path FROM pages),
m AS (SELECT page_id, url, kind, entry, valid_from FROM c JOIN spans s ON host <> '' AND fetched >= valid_from AND (until IS NULL OR fetched < until) AND CASE kind
  WHEN 'domain' THEN host = entry OR (host NOT LIKE '[%' AND ends_with(host, '.' || entry)) WHEN 'host' THEN host = entry ELSE starts_with(host || regexp_replace(path, '/+', '/', 'g') || '/', entry || '/') END),
g AS (SELECT page_id, url, count(*) AS n, max(valid_from) AS since FROM (SELECT DISTINCT * FROM m) GROUP BY page_id, url)
SELECT page_id, url, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, strftime(since, '%Y-%m-%d') AS since FROM c LEFT JOIN g USING (page_id, url)
"""
