import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.functions import providers
from leafline.operators import batch, building, elements, index, processing
from leafline.sources import documents, sinks

PAGES = "doc string, page_idx int, text string, token_count long"
BODY = ["Cover", "Contents\nAlpha ..... 1\nGamma ..... 2", "Alpha\ntext", "Gamma\nmore", "end"]


def pages(spark, *docs):
    return spark.createDataFrame([(d, i, t, 50) for d in docs for i, t in enumerate(BODY if d != "bare" else BODY[2:])], PAGES)


def told(name, prompt):
    """A model that reads the tagged pages of its prompt."""
    first, _, rest = prompt.partition("\n")
    tag = lambda title: next((f"<physical_index_{i}>" for i in range(1, 9) if f"<physical_index_{i}>\n{title}" in rest), None)
    if first.startswith("Does this page hold"):
        return json.dumps({"toc_detected": "yes" if rest.startswith("Contents") else "no"})
    if first.startswith("Does this table"):
        return json.dumps({"page_index_given_in_toc": "yes"})
    if first.startswith("Rewrite this table"):
        return json.dumps({"toc": [{"structure": "1", "title": "Alpha", "page": "1"}, {"structure": "2", "title": "Gamma", "page": "2"}]})
    if first.startswith("Is the rewritten"):
        return json.dumps({"completed": "yes"})
    if first.startswith("Give each section"):
        return json.dumps({"toc": [{"structure": "1", "title": "Alpha chapter"[:5], "physical_index": tag("Alpha")}]})
    if first.startswith("List the sections"):
        return json.dumps({"toc": [{"structure": str(n), "title": t, "physical_index": tag(t)} for n, t in enumerate(("Alpha", "Gamma"), 1)]})
    if first.startswith("On which of these"):
        return json.dumps({"physical_index": "<physical_index_4>"})
    if first.startswith("Find the page"):
        return json.dumps({"toc": [{"title": "Alpha" if "Alpha" in rest.split("\n")[0] else "Gamma", "physical_index": tag("Gamma")}]})
    raise RuntimeError("down")


def test_printed_numbers_become_pages(spark):
    opt = building.Options(toc_check_pages=3)
    p = pages(spark, "a")
    found = processing.detected_pages(p, opt, told)
    assert [tuple(r) for r in found.collect()] == [("a", 1)]
    printed = processing.printed_toc(found, p, opt, told)
    assert tuple(printed.first()) == ("a", "Contents\nAlpha :  1\nGamma :  2", 1, "yes")
    short = lambda m, x: told(m, x).replace("Alpha", "Alph a") if x.startswith("Rewrite") else told(m, x).replace("Alpha", "Alph a") if x.startswith("Give") else told(m, x)
    rows = processing.with_page_numbers(printed, p, opt, short).orderBy("ord").collect()
    assert [(r["title"], r["physical_index"]) for r in rows] == [("Alph a", 3), ("Gamma", 4)]


def test_the_cascade_gives_every_document_sections(spark):
    opt = building.Options(toc_check_pages=3)

    def down_for_bare(m, x):
        if "Contents" not in x and x.startswith("List the sections"):
            raise RuntimeError("down")
        return told(m, x).replace('"Alpha"', '"Alpha "') if x.startswith("Rewrite") or x.startswith("Give") else told(m, x)

    got = processing.processed(pages(spark, "a", "bare"), opt, down_for_bare).orderBy("doc", "ord").collect()
    assert [(r["doc"], r["title"].strip(), r["physical_index"], r["appear_start"], r["mode"]) for r in got] == [("a", "Alpha", 3, "yes", "with_pages"), ("a", "Gamma", 4, "yes", "with_pages"), ("bare", "Document", 1, "no", "none")]
    got = processing.processed(pages(spark, "bare"), opt, told).orderBy("ord").collect()
    assert [(r["title"], r["physical_index"], r["mode"]) for r in got] == [("Alpha", 1, "none"), ("Gamma", 2, "none")]


def test_gaps_are_filled_between_anchors(spark):
    rows = spark.createDataFrame([("a", 1, "1", "Alpha", None, 3), ("a", 2, "2", "Gamma", None, None), ("a", 3, "3", "End", None, 5), ("a", 4, "4", "Late", None, None)], "doc string, ord int, structure string, title string, page int, physical_index int")
    got = processing.filled(rows, pages(spark, "a"), building.Options(), told).orderBy("ord").collect()
    assert [r["physical_index"] for r in got] == [3, 4, 5, None]
    wrong = rows.withColumn("physical_index", F.when(F.col("ord") == 2, 1).otherwise(F.col("physical_index"))).where("ord < 3")
    p = pages(spark, "a")
    mended = lambda model: [r["physical_index"] for r in processing.fixed(processing.checked(wrong, p, building.Options()), p, processing.whole(p), building.Options(), model).orderBy("ord").collect()]
    assert mended(told) == [3, 4]
    lying = lambda m, x: json.dumps({"physical_index": 5}) if x.startswith("On which of these") else told(m, x)
    assert mended(lying) == [3, 1]  # page 5 lacks the title, so the section stays where it was


def test_overlapping_detections_give_way(spark, rows):
    r = np.random.default_rng(2)
    data = [("d", i % 2, i, "figure" if i % 3 else "table", float(r.integers(0, 5)), *map(int, (x, y, x + 40, y + 40))) for i, (x, y) in enumerate(r.integers(0, 120, (80, 2)))]
    df = spark.createDataFrame(data, "doc string, page int, ord int, label string, confidence double, x0 int, y0 int, x1 int, y1 int")
    kept = []
    for b in sorted(data, key=lambda x: (-x[4], x[2])):
        iou = lambda a: (i := max(0, min(a[7], b[7]) - max(a[5], b[5])) * max(0, min(a[8], b[8]) - max(a[6], b[6]))) / (3200 - i)  # noqa: E731, B023
        if not any(a[1] == b[1] and a[3] == b[3] and iou(a) > 0.3 for a in kept):
            kept.append(b)
    assert sorted(tuple(x) for x in elements.suppressed(df, 0.3).collect()) == sorted(kept) and len(kept) < 80


def test_embedding_and_index(spark, tmp_path):
    chunks = spark.createDataFrame([("p", f"p:{i}", "x" * i) for i in range(130)] + [("q", "q:0", "y")], "paper string, doc_id string, text string")
    made = index.embedded(chunks, lambda texts: [[len(t), 1.0 + len(texts) // 65] for t in texts], 2)
    assert {tuple(r["embedding"]) for r in made.collect()} == {(float(i), 1.0) for i in range(130)}
    with pytest.raises(Exception, match="cannot reshape|vectors for"):
        index.embedded(chunks, lambda texts: [[1.0, 2.0, 3.0] for _ in texts], 2).collect()
    rows = index.points(made)
    assert [sinks.index_chunks(spark, rows, str(tmp_path / "i"), 2) for _ in range(2)] == [131, 131]
    assert sinks.index_chunks(spark, rows.where("doc_id = 'p:1'"), str(tmp_path / "i"), 2) == 1
    assert {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "i" / "points")).collect()} == {"p:1", "q:0"}


def test_sources_and_batches(spark, tmp_path):
    for name in ("b.pdf", "A b.pdf", "c.txt"):
        sinks.write_bytes(spark, str(tmp_path / "in" / name), b"x")
    assert [(r["item_ord"], r["document_id"]) for r in documents.inputs(spark, pdf_dir=str(tmp_path / "in")).collect()] == [(0, "a-b"), (1, "b")]
    sinks.write_bytes(spark, str(tmp_path / "t" / "one" / "tree.json"), b"{}")
    assert [r["document_id"] for r in documents.inputs(spark, tree_dir=str(tmp_path / "t")).collect()] == ["one"]
    with pytest.raises(ValueError):
        documents.inputs(spark, pdf_dir="a", tree_dir="b")
    items = spark.createDataFrame([("b1", 1), ("b1", 2)], "batch_id string, item_ord int")
    assert batch.of_batch(items, "b1").count() == 2
    with pytest.raises(Exception, match="not of batch"):
        batch.of_batch(items, "b2").collect()


def test_calls_are_patient():
    waits, tries = [], []

    def flaky(model, prompt):
        tries.append(1)
        if len(tries) < 3:
            raise RuntimeError("busy")
        return "ok"

    assert providers.patient(flaky, "cpu", waits.append)("m", "p") == "ok" and waits == [2.0, 6.0]
    with pytest.raises(RuntimeError):
        providers.patient(lambda m, p: flaky(m, tries.clear()), "gpu", waits.append)("m", "p")
    assert waits[2:] == [2.0, 6.0, 18.0, 54.0]


def test_overlaps_need_no_python_call_a_page(spark):
    data = [("d", 1, 1, "figure", 0.5, 0, 0, 10, 10), ("d", 1, 2, "figure", 0.9, 1, 0, 11, 10), ("d", 1, 3, "figure", None, 0, 0, 10, 10), ("d", 1, 4, "figure", 0.1, None, 0, 10, 10), ("d", 2, 5, "figure", 0.1, 0, 0, 10, 10)]
    got = elements.suppressed(spark.createDataFrame(data, "doc string, page int, ord int, label string, confidence double, x0 int, y0 int, x1 int, y1 int"), 0.3)
    assert sorted(r["ord"] for r in got.collect()) == [2, 4, 5]
    assert "Pandas" not in got._jdf.queryExecution().executedPlan().toString()
