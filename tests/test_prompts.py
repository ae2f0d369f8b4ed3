import json
import re

import pytest
from pyspark.sql import functions as F

from leafline.functions import prompts, providers
from leafline.operators import pagetext, reports, trees

PAGES = "doc string, page_idx int, text string"


def asked(spark, spec, doc="a"):
    pages = spark.createDataFrame([("a", i, t) for i, t in enumerate(["one ......", "two", " three ", "four"])], PAGES)
    rows = spark.createDataFrame([(doc, 1)], "doc string, key int").withColumn("spec", spec)
    return pagetext.assembled(rows, pages).first()["text"]


def test_pages_by_spec(spark):
    idx = lambda *i: F.array(*map(F.lit, i)) if i else F.array().cast("array<int>")
    assert asked(spark, prompts.page_spec(idx(2, 0, 2))) == " three one ...... three "
    assert asked(spark, prompts.page_spec(idx(0), "physical_index", dots=True)) == "<physical_index_1>\none : \n<physical_index_1>\n\n"
    assert asked(spark, prompts.page_spec(idx())) == ""
    marks = "<<<context-before>>>\none ......\n<<<section-content>>>\ntwo three \n<<<context-after>>>\n"
    assert asked(spark, prompts.page_spec(idx(1, 2), before=idx(0))) == marks
    assert asked(spark, prompts.page_spec(idx(1, 2), before=idx(0), after=idx(3), section_only=True)) == "two three"
    assert asked(spark, prompts.page_spec(idx(2), section_only=True)) == " three "
    for spec, error in ((prompts.page_spec(idx(1), "physical_index", before=idx(0)), "need wrap raw"), (prompts.page_spec(idx(1), "bold"), "not bold"), (prompts.page_spec(idx(9)), "no page 9")):
        with pytest.raises(Exception, match=error):
            asked(spark, spec)


def test_prompts_by_spec(spark):
    pages = spark.createDataFrame([("a", 0, "p {title}"), ("b", 0, "q")], PAGES)
    uri = F.lit("store/pages")
    body = prompts.page_spec(F.array(F.lit(0)))
    with_pages = prompts.spec("check_title_appearance", "upstream", uri, {"title": F.lit("T {page_text}")}, {"page_text": body})
    without = prompts.spec("toc_transformer", "upstream", uri, {"toc": F.lit("x")})
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "doc string, key int").withColumn("spec", with_pages)
    rows = rows.unionAll(spark.createDataFrame([("a", 2)], "doc string, key int").withColumn("spec", without))
    assert {(r["key"], r["u"]) for r in rows.select("key", F.col("spec.pages_uri").alias("u")).collect()} == {(1, "store/pages"), (2, None)}
    got = {(r["doc"], r["key"]): r["prompt"] for r in pagetext.rendered(rows, pages).collect()}
    assert got["a", 1].endswith("Title: T {page_text}\nPage:\np {title}") and got["b", 1].endswith("Page:\nq")
    assert got["a", 2] == "Rewrite this table of contents as a JSON list of structure, title and page.\nx"  # the other style's
    with pytest.raises(Exception, match="no value for .toc."):
        pagetext.rendered(spark.createDataFrame([("a", 3)], "doc string, key int").withColumn("spec", prompts.spec("toc_transformer", "local", uri)), pages).collect()
    with pytest.raises(ValueError):
        prompts.spec("toc_transformer", "loud", uri)
    with pytest.raises(KeyError):
        prompts.spec("nothing", "local", uri)


def test_every_style_asks_for_the_same_values():
    fields = lambda t: set(re.findall(r"\{(\w+)\}", t))
    assert all(fields(prompts.template(n, "upstream")) == fields(prompts.template(n)) for n in prompts._LOCAL)


def test_answers_say_how_they_ended(spark):
    model = lambda m, p: providers.Answer("cut off", "max_tokens", 7) if p == "long" else "whole"
    rows = spark.createDataFrame([("m", "long"), ("m", "short text")], "model string, prompt string")
    got = {r["prompt"]: (r["content"], r["finish_reason"], r["input_tokens"], r["output_tokens"]) for r in providers.call(rows, model).collect()}
    assert got == {"long": ("cut off", "length", 7, 2), "short text": ("whole", "stop", 2, 1)}


def test_postorder(spark):
    nodes = spark.createDataFrame([("d", [1]), ("d", [1, 1]), ("d", [1, 2]), ("d", [1, 2, 1]), ("d", [2])], "doc string, path array<int>")
    assert [r["path"] for r in trees.postorder(nodes).orderBy("visit").collect()] == [[1, 1], [1, 2, 1], [1, 2], [1], [2]]


def test_run_records_are_written(spark, tmp_path):
    record = reports.run_record("process", "doc", "2024-01-01T10:00:00Z", "2024-01-01T10:01:00Z", {"pdf": "x"}, {"nodes": 3})
    uri = reports.write_run_record(spark, record, str(tmp_path / "log"))
    assert json.load(open(uri)) == record and record["status"] == "ok"
