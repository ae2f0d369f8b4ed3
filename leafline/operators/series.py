"""Data points of charts, as a vision model's answer lists them, put into tables: a table for each series, with the same columns.

charts(key, data): data is a JSON list of points, or of lists of points, which are joined. A point is an object; its `series` names
the table it belongs to ("data" without one), `panel` is left out. The columns are the other keys of all points of a chart, in the
order in which they first come up; tables come in the order of their first points. A chart whose first entry is no object has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The name of points without a series, and the keys that are no column.
UNNAMED = "data"
APART = ("series", "panel")


def points(charts: DataFrame) -> DataFrame:
    """(key, nth, point map<string,string>): the points of each chart in order; values as JSON writes them."""
    entries = F.from_json("data", "array<string>")
    flat = F.flatten(F.transform(entries, lambda x: F.when(F.startswith(F.ltrim(x), F.lit("[")), F.from_json(x, "array<string>")).when(F.startswith(F.ltrim(x), F.lit("{")), F.array(x)).otherwise(F.array().cast("array<string>"))))
    each = charts.select("key", flat.alias("p")).where(F.startswith(F.ltrim(F.get("p", F.lit(0))), F.lit("{")))
    return each.select("key", F.posexplode("p").alias("nth", "x")).where(F.startswith(F.ltrim("x"), F.lit("{"))).select("key", "nth", F.from_json("x", "map<string,string>").alias("point"))


def columns(found: DataFrame) -> DataFrame:
    """(key, columns) of points."""
    each = found.select("key", "nth", F.posexplode(F.map_keys("point")).alias("at", "column")).where(~F.col("column").isin(*APART))
    first = each.groupBy("key", "column").agg(F.min(F.struct("nth", "at")).alias("first"))
    return first.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "column"))), lambda x: x["column"]).alias("columns"))


def tables(charts: DataFrame) -> DataFrame:
    """(key, series, series_nth, row_nth, columns, cells): a row for each point. A key that the point lacks is an empty cell, a null
    one reads None."""
    found = points(charts).withColumn("series", F.coalesce(F.col("point")["series"], F.lit(UNNAMED)))
    of_chart, of_series = W.partitionBy("key"), W.partitionBy("key", "series").orderBy("nth")
    placed = found.withColumns({"row_nth": F.row_number().over(of_series), "began": F.min("nth").over(W.partitionBy("key", "series"))})
    placed = placed.withColumn("series_nth", F.dense_rank().over(of_chart.orderBy("began")))
    cell = lambda c: F.when(F.map_contains_key("point", c), F.coalesce(F.try_element_at("point", c), F.lit("None"))).otherwise("")
    out = placed.join(columns(found), "key", "left").withColumn("columns", F.coalesce("columns", F.array().cast("array<string>")))
    return out.select("key", "series", "series_nth", "row_nth", "columns", F.transform("columns", cell).alias("cells"))
