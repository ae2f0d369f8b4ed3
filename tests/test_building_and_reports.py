import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leafline.functions import answers, prompts
from leafline.operators import building, reports

PAGES = "doc string, page_idx int, text string, token_count long"
TOC = "doc string, ord int, title string, physical_index int"


def pages(spark):
    body = ["Introduction\nall begins", "more", "text then  Meth ods", "Results\nend"]
    return spark.createDataFrame([("d", i, t, 50) for i, t in enumerate(body)], PAGES)


def test_titles_are_checked_and_repaired(spark):
    rows = spark.createDataFrame([("d", 1, "Introduction", 1), ("d", 2, "Methods", 2), ("d", 3, "Results", 4), ("d", 4, "Nowhere", 4), ("d", 5, "Lost", None)], TOC)
    got = {r["title"]: (r["answer"], r["appear_start"]) for r in building.title_checks(rows, pages(spark)).collect()}
    assert got == {"Introduction": ("yes", "yes"), "Methods": ("no", "no"), "Results": ("yes", "yes"), "Nowhere": ("no", "no"), "Lost": ("no", "no")}
    fixed = {r["title"]: r["physical_index"] for r in building.repaired(rows, pages(spark)).collect()}
    assert fixed == {"Introduction": 1, "Methods": 3, "Results": 4, "Nowhere": 4, "Lost": None}


def test_section_text_has_context_marks(spark):
    n = spark.createDataFrame([("d", "k", 2, 2), ("d", "all", 1, 4)], "doc string, key string, start_index int, end_index int")
    got = {r["key"]: r["node_text"] for r in building.section_text(n, pages(spark), 1).collect()}
    assert got["k"] == "<<<context-before>>>\nIntroduction\nall begins\n<<<section-content>>>\nmore\n<<<context-after>>>\ntext then  Meth ods"
    assert got["all"].startswith("Introduction") and "<<<" not in got["all"]
    assert {r["node_text"] for r in building.section_text(n.where("key = 'k'"), pages(spark), 1, True).collect()} == {"more"}


def model(name, prompt):
    if "faithful" in prompt.split("\n")[0]:
        return json.dumps({"faithful": "no", "missed_topics": ["x"] if "more" in prompt else []})
    if prompt.startswith("Rewrite this summary"):
        return "better"
    if prompt.startswith("List the sections"):
        return json.dumps({"toc": [{"title": "First part", "structure": "1", "physical_index": "<physical_index_1>"}]})
    if prompt.startswith("Continue this list"):
        return json.dumps({"toc": [{"title": "Later part", "structure": "2", "physical_index": "<physical_index_3>"}]})
    if "abstract" in prompt:
        raise RuntimeError("down")
    return "summary"


def test_summaries_are_rewritten_where_topics_are_missed(spark):
    n = spark.createDataFrame([("d", "a", "A", 2, 2, None), ("d", "b", "B", 4, 4, None)], "doc string, key string, title string, start_index int, end_index int, summary string")
    got = {r["key"]: r["summary"] for r in building.summarised(n, pages(spark), building.Options(overlap_pages=0), model).collect()}
    assert got == {"a": "better", "b": "summary"}


def test_groups_are_asked_in_turn_and_failures_stay_rows(spark):
    got = building.generated_toc(pages(spark), building.Options(), model, budget=160).orderBy("ord").collect()
    assert [(r["ord"], r["title"], r["physical_index"]) for r in got] == [(1, "First part", 1), (2, "Later part", 3), (3, "Later part", 3)]
    assert building.abstracts(pages(spark), building.Options(), model).first()["abstract"] is None


def test_figures_change_leaf_and_parents(spark):
    nodes = "doc string, key string, parent string, ord int, depth int, node_id string, title string, raw_text string, summary string"
    n = spark.createDataFrame([("d", "r", None, 0, 1, "0000", "Root", "", "old r"), ("d", "a", "r", 1, 2, "0001", "A", "text", "old a"), ("d", "b", "r", 2, 2, "0002", "B", "text", "old b"), ("e", "s", None, 0, 1, "0000", "S", "", "old s")], nodes)
    el = spark.createDataFrame([("d", "a", 1, 1, "fig_1", "figure", "cap", None, None)], "doc string, key string, page int, ord int, element_id string, element_type string, caption string, ocr_text string, chem_entities array<string>")
    got = {r["key"]: r["summary"] for r in building.figure_summaries(n, el, building.Options(), lambda m, p: "new " + p.split("\n")[0][:24]).collect()}
    assert got == {"r": "new Summarise the section fr", "a": "new Summarise the section wi", "b": "old b", "s": "old s"}


def test_transformed_toc_goes_on_until_complete(spark):
    def talk(name, prompt):
        return json.dumps({"completed": "yes" if "bb" in prompt else "no"}) if prompt.startswith("Is the") else "a" if prompt.startswith("Rewrite") else "bb"

    t = spark.createDataFrame([("d", "toc")], "doc string, toc string")
    assert tuple(building.transformed_toc(t, building.Options(), talk).first()) == ("d", "abb", 2)


def test_answers():
    assert json.loads(answers.normalised("toc_detection", '{"toc_detected": true, "x": 1}')) == {"toc_detected": "yes"}
    assert json.loads(answers.normalised("summary_verdict", "{}")) == {"faithful": "no", "missed_topics": []}
    for key, bad in (("toc_list_initial", '{"toc": []}'), ("toc_list", '{"toc": [{"title": "abc"}]}'), ("toc_list", '{"toc": [{"title": "abcdef", "extra": 1}]}'), ("abstract", "[]"), ("abstract", "no json")):
        with pytest.raises(ValueError):
            answers.normalised(key, bad)
    with pytest.raises(KeyError):
        answers.known("nope")


@pytest.mark.parametrize(
    ("body", "titles"),
    [('[{"title":"A","page":3}]', ["A"]), ('{"toc":[{"title":"A"}]}', ["A"]), ('{"table_of_contents":[{"title":"A"},{"title":"B"}]}', ["A", "B"]), ('{"contents":[]}', []), ('{"other":[{"title":"Z"}]}', ["Z"]), ('{"a":1,"b":[{"title":"Z"}]}', []), ("broken", []), ("", [])],
)
def test_assembled_toc(spark, body, titles):
    got = spark.createDataFrame([(body,)], "b string").select(answers.assembled_rows(F.col("b")).alias("r")).first()["r"]
    assert [r["title"] for r in got] == titles


def test_prompts(spark):
    assert prompts.template("generate_node_summary", "upstream") != prompts.template("generate_node_summary")
    assert prompts.template("toc_transformer", "upstream") == prompts.template("toc_transformer")
    for bad in (("nope", "local"), ("toc_transformer", "other")):
        with pytest.raises((KeyError, ValueError)):
            prompts.template(*bad)
    assert spark.range(1).select(prompts.render("toc_transformer", toc=F.lit("x")).alias("p")).first()["p"].endswith("\nx")
    with pytest.raises(ValueError):
        building.Options.of({"tree_llm": {"model": "m", "prompt_style": "odd"}, "tree": {}})


def test_reports(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    w = spark.createDataFrame([("b", None, "Batch", at(0), at(100), "COMPLETED"), ("p1", "b", "ProcessPdfWorkflow", at(1), at(50), "COMPLETED"), ("p2", "b", "ProcessPdfWorkflow", at(1), at(90), "FAILED"), ("x", None, "ProcessPdfWorkflow", at(0), at(10), "COMPLETED")], "workflow_id string, parent_id string, type string, started_at timestamp, closed_at timestamp, status string")
    e = spark.createDataFrame([("p1", 1, "scheduled", "ocr", 0, at(1)), ("p1", 1, "started", None, 2, at(2)), ("p1", 1, "failed", None, 0, at(4)), ("x", 1, "scheduled", "embed", 0, at(1))], "workflow_id string, scheduled_id long, kind string, activity_type string, attempt int, ts timestamp")
    m = spark.createDataFrame([(7, "cpu", None, at(1), 99.0), (7, "memory", None, at(1), 50.0)], "instance int, metric string, interface string, ts timestamp, value double")
    r = reports.batch_report(w, e, m, "b")
    assert tuple(r.items.first()) == (2, 1, 1)
    assert sorted(x["flag"] for x in r.flags.collect()) == ["1/2 ProcessPdfWorkflow runs failed", "Activity ocr: 1 total retries across 1 invocations", "Activity ocr: 1/1 terminal failures", "Instance 7: CPU p95=99% — saturated"]
    live = reports.live_report(w, e, m, at(0), at(20))
    assert tuple(live.items.first()) == (1, 1, 0)
    got = {x["activity_type"]: (x["live"], x["batch"]) for x in reports.comparison(live, r).collect()}
    assert got == {"embed": (0.0, 0.0), "ocr": (0.0, 2.0)}
    assert reports.cached(spark, str(tmp_path)) is None
    paths = reports.write_pair(r, "Batch b", str(tmp_path))
    assert open(paths["md"]).read().startswith("# Batch b\n\n## Flags") and reports.cached(spark, str(tmp_path))["items"] == [{"items": 2, "succeeded": 1, "failed": 1}]
    with pytest.raises(ValueError):
        reports.live_report(w, e, m, dt.datetime(2024, 1, 1), at(1))
    assert reports.scaled(2048) == "2.0 KiB" and reports.run_record("process", "d", "a", "b", {}, None, error="e")["status"] == "error"


def test_every_prompt_is_asked_once(spark, tmp_path):
    log = str(tmp_path / "log")

    def counted(name, prompt):
        with open(log, "a") as f:
            f.write(prompt.split("\n")[0] + "\n")
        return model(name, prompt)

    grouped = building.generated_toc(pages(spark), building.Options(), counted, budget=160)
    groups = building.toc.page_groups(pages(spark), 160, 1, 15).agg(F.max("grp")).first()[0] + 1
    assert grouped.count() == grouped.count() == groups and len(open(log).readlines()) == groups
    open(log, "w").close()
    n = spark.createDataFrame([("d", "a", "A", 2, 2, None), ("d", "b", "B", 4, 4, None)], "doc string, key string, title string, start_index int, end_index int, summary string")
    out = building.summarised(n, pages(spark), building.Options(overlap_pages=0), counted)
    assert out.count() == 2 and len(out.collect()) == 2
    asked = open(log).readlines()
    assert len(asked) == 5 and sum(x.startswith("Summarise") for x in asked) == 2


def test_stored_answers_hold_no_prompts_and_sections_are_cut_where_their_pages_are(spark):
    asked = spark.createDataFrame([("d", "stub", "long prompt")], "doc string, model string, prompt string")
    assert "prompt" not in building.asked_of(asked, model).columns
    n = spark.createDataFrame([("d", "k", 2, 2), ("d", "far", 9, 12), ("none", "k", 1, 1)], "doc string, key string, start_index int, end_index int")
    got = building.section_text(n, pages(spark), 1)
    assert {(r["doc"], r["key"]): r["node_text"] for r in got.where("key = 'far' or doc = 'none'").collect()} == {("d", "far"): "", ("none", "k"): ""}
    assert got._jdf.queryExecution().executedPlan().toString().count("Join") <= 2  # one join, named once or twice in a plan


def test_batches_to_python_are_small(spark):
    from leafline.operators import scratch

    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for before, after in ((10_000, "512"), (0, "512"), (64, "64")):
        spark.conf.set(size, before)
        scratch.small_batches(spark)
        assert spark.conf.get(size) == after
    spark.conf.unset(size)


def test_later_rounds_read_only_documents_with_more_groups(spark, monkeypatch):
    plans, ask = [], building.asked_of

    def seen(asked, *more):
        plans.append(asked._jdf.queryExecution().optimizedPlan().toString())
        return ask(asked, *more)

    monkeypatch.setattr(building, "asked_of", seen)
    p = pages(spark).unionByName(spark.createDataFrame([("e", 0, "Single", 50)], PAGES))
    got = building.generated_toc(p, building.Options(), model, budget=160).orderBy("doc", "ord").collect()
    assert [(r["doc"], r["title"], r["physical_index"]) for r in got] == [("d", "First part", 1), ("d", "Later part", 3), ("d", "Later part", 3), ("e", "First part", 1)]
    # neither are answers parsed again nor pages put together again for a later group
    assert len(plans) == 3 and not any(x in plan for plan in plans[1:] for x in ("Generate", "LogicalRDD", "page_idx"))


def test_tokens_are_counted_as_their_pattern_finds_them(spark):
    import re

    from leafline.functions import text

    texts = ["", " ", "abcd efghi j", "  a1b2c3, d.e\t\nf--g  ", "ÄÖ ab cd ef 😀😀 x", "a\x0bb\x0cc\rd", "12345678 123456789"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string").select("i", text.count_tokens(F.col("t")).alias("n")).collect()
    pattern = re.compile(r"[A-Za-z0-9]{1,4}|[^ \t\n\x0b\f\rA-Za-z0-9]")
    assert {r["i"]: r["n"] for r in got} == {**{i: len(pattern.findall(t)) for i, t in enumerate(texts)}, len(texts): 0}


def test_titles_that_stand_as_they_are_and_others(spark):
    body = ["Alpha  Beta\tgamma", "one alpha beta", "ΟΔΟΣ street", "İx", "nothing"]
    p = spark.createDataFrame([("d", i, t, 1) for i, t in enumerate(body)], PAGES)
    asked = [("Alpha  Beta", 1), ("alpha BETA", 1), ("Alpha", 2), ("ΟΔΟΣ", 3), ("ΟΔΟ", 3), ("Street", 3), ("", 5), (None, 5), ("beta", 9)]
    rows = spark.createDataFrame([("d", n, t, i) for n, (t, i) in enumerate(asked)], TOC)
    squeeze = F.udf(lambda x: None if x is None else "".join(x.lower().split()))
    by = rows.join(p.select("doc", (F.col("page_idx") + 1).alias("physical_index"), squeeze("text").alias("s")), ["doc", "physical_index"], "left").withColumn("t", squeeze("title")).collect()
    yes = lambda x: "yes" if x else "no"
    known = lambda r: r["s"] is not None and r["t"] is not None
    want = {r["ord"]: (yes(known(r) and r["t"] in r["s"]), yes(known(r) and r["s"].startswith(r["t"]))) for r in by}
    assert {r["ord"]: (r["answer"], r["appear_start"]) for r in building.title_checks(rows, p).collect()} == want
