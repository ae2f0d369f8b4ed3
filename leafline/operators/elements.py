"""Visual elements: detection filters, caption pairing, ids, recognised-text updates and assignment to tree nodes."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.functions import html, ids, text

CONTENT = ("figure", "table", "isolate_formula")
CAPTIONS = ("figure_caption", "table_caption")


def kept_detections(found: DataFrame, classes: list[str], confidence: float) -> DataFrame:
    """Detections of these classes from a confidence on, boxes as whole pixels and as shares of the page."""
    box = {f"n{c}": F.col(c).cast("int") / F.col("width" if c[0] == "x" else "height") for c in ("x0", "y0", "x1", "y1")}
    return found.where(F.col("label").isin(classes) & (F.col("confidence") >= confidence)).withColumns(box)


def caption_candidates(found: DataFrame, below: int = 80, ratio: float = 0.6) -> DataFrame:
    """(doc, page, content, caption, gap): captions close under or over a content box and centred within its width."""
    c = found.where(F.col("label").isin(*CONTENT)).select("doc", "page", F.col("ord").alias("content"), *(F.col(x).alias(f"c{x}") for x in ("x0", "y0", "x1", "y1")))
    k = found.where(F.col("label").isin(*CAPTIONS)).select("doc", "page", F.col("ord").alias("caption"), *(F.col(x).alias(f"k{x}") for x in ("x0", "y0", "x1", "y1")))
    j = c.join(k, ["doc", "page"])
    under, over = F.col("ky0") - F.col("cy1"), F.col("cy0") - F.col("ky1")
    gap = F.when(under.between(0, below), under).when(over.between(0, below), over)
    near = F.abs((F.col("cx0") + F.col("cx1")) / 2 - (F.col("kx0") + F.col("kx1")) / 2) <= (F.col("cx1") - F.col("cx0")) * ratio
    return j.where(near).withColumn("gap", gap).where("gap is not null").select("doc", "page", "content", "caption", "gap")


def paired_captions(found: DataFrame, below: int = 80, ratio: float = 0.6) -> DataFrame:
    """(doc, page, content, caption): each content box, in order, takes its nearest caption not yet taken.

    Taking captions in turn depends on the order, so each page's candidates go through one function call.
    """

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for content, g in pdf.sort_values(["content", "gap", "caption"]).groupby("content", sort=False):
            free = g[~g["caption"].isin(taken)]
            if len(free):
                taken.add(free["caption"].iloc[0])
                out.append((g["doc"].iloc[0], g["page"].iloc[0], content, free["caption"].iloc[0]))
        return pd.DataFrame(out, columns=["doc", "page", "content", "caption"])

    cand = caption_candidates(found, below, ratio)
    kinds = dict(cand.dtypes)
    return cand.groupBy("doc", "page").applyInPandas(assign, f"doc {kinds['doc']}, page {kinds['page']}, content {kinds['content']}, caption {kinds['caption']}")


def numbered(found: DataFrame) -> DataFrame:
    """found(doc, page, node_id, label, ord) with element_id, counted within page and label."""
    nth = F.row_number().over(W.partitionBy("doc", "page", "label").orderBy("ord"))
    return found.withColumn("element_id", ids.element_id(F.col("label"), F.col("node_id"), F.col("page"), nth))


def pixel_box(found: DataFrame, scale: float) -> DataFrame:
    return found.withColumns({c: (F.col(c) * scale).cast("int") for c in ("x0", "y0", "x1", "y1")})


def readable(elements: DataFrame) -> DataFrame:
    """Elements with a picture to read, and their index within the page."""
    nth = F.row_number().over(W.partitionBy("doc", "page_idx").orderBy("ord")) - 1
    return elements.withColumn("elem_idx", nth).where(F.coalesce("asset_uri", F.lit("")) != "")


def type_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("element_type").agg(F.count("*").alias("n"))


def merged_updates(elements: DataFrame, updates: DataFrame, fields: list[str]) -> DataFrame:
    """elements with the updates of the same place and id laid over; per field the last non-null update wins.

    updates(doc, page_idx, elem_idx, element_id, ord, fields...)
    """
    key = ["doc", "page_idx", "elem_idx", "element_id"]
    last = updates.groupBy(*key).agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("ord"))).alias(f"__{f}") for f in fields))
    j = elements.join(last, key, "left")
    return j.withColumns({f: F.coalesce(f"__{f}", f) for f in fields}).drop(*(f"__{f}" for f in fields))


@F.pandas_udf(T.StringType())
def table_markdown(tables: pd.Series) -> pd.Series:
    """Markdown of HTML tables; null and empty stay null."""
    return tables.map(lambda h: html.table_markdown(h) if h else None)


def parse_vision(contents: pd.Series) -> pd.Series:
    return contents.map(html.vision_json)


vision_json = F.pandas_udf(parse_vision, T.StringType())


def enriched(elements: DataFrame, seeds: list[str]) -> DataFrame:
    """elements with chem_entities from text and caption, and structured_data of tables from their first HTML table."""
    md = table_markdown(text.first_table(F.coalesce("ocr_text", F.lit(""))))
    return elements.withColumns({
        "chem_entities": text.entities(text.element_text(F.col("ocr_text"), F.col("caption")), seeds),
        "structured_data": F.when(F.col("element_type") == "table", F.coalesce(F.nullif(md, F.lit("")), F.col("structured_data"))).otherwise(F.col("structured_data")),
    })


def assigned(elements: DataFrame, owners: DataFrame) -> DataFrame:
    """elements(doc, page, ...) with the node that owns their page (trees.page_owner); pages of no node are dropped."""
    return elements.join(owners, ["doc", "page"])


def figure_blocks(elements: DataFrame) -> DataFrame:
    """(doc, key, block): a line a figure: id, type, page and what is known of it."""
    line = F.concat(
        F.lit("- "), F.col("element_id"), F.lit(" ("), F.col("element_type"), F.lit(", p."), F.col("page").cast("string"), F.lit(")"),
        F.coalesce(F.concat(F.lit(" caption: "), F.nullif("caption", F.lit(""))), F.lit("")),
        F.coalesce(F.concat(F.lit(" text: "), F.nullif("ocr_text", F.lit(""))), F.lit("")),
        F.when(F.size(F.coalesce("chem_entities", F.array().cast("array<string>"))) > 0, F.concat(F.lit(" entities: "), F.array_join("chem_entities", ", "))).otherwise(""),
    )
    g = elements.groupBy("doc", "key").agg(F.array_sort(F.collect_list(F.struct("page", "ord", line.alias("line")))).alias("x"))
    return g.select("doc", "key", F.array_join(F.transform("x", lambda r: r["line"]), "\n").alias("block"))


def suppressed(found: DataFrame, iou: float) -> DataFrame:
    """Detections without those that overlap a surer one of their page and class by more than iou (intersection over union);
    equally sure ones in their order. What is left depends on what was left before, so a page's boxes fold in order inside one
    expression; boxes without a coordinate overlap nothing, and those without a confidence come last."""
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    long = lambda a, b: F.when(b > a, b - a).when(b <= a, 0.0)
    x0, y0, x1, y1, sure = map(number, ("x0", "y0", "x1", "y1", "confidence"))
    area = long(x0, x1) * long(y0, y1)
    box = F.struct(sure.isNull().alias("unsure"), (-sure).alias("last"), "ord", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), area.alias("area"), F.struct(*found.columns).alias("row"))
    each = found.groupBy("doc", "page", "label").agg(F.array_sort(F.collect_list(box)).alias("boxes"))

    def over(a: Column, b: Column) -> Column:
        both = long(F.greatest(a["x0"], b["x0"]), F.least(a["x1"], b["x1"])) * long(F.greatest(a["y0"], b["y0"]), F.least(a["y1"], b["y1"]))
        return F.coalesce(both > iou * (a["area"] + b["area"] - both), F.lit(False))

    none = F.slice("boxes", 1, 0)
    kept = F.aggregate("boxes", none, lambda kept, b: F.when(F.exists(kept, lambda a: over(a, b)), kept).otherwise(F.concat(kept, F.array(b))))
    return each.select(F.explode(kept).alias("box")).select("box.row.*")
