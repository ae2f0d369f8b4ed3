import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from leafline.functions import providers
from leafline.operators import building, index, intervals, ledger, processing, reports, series, treebuild

PAGES = "doc string, page_idx int, text string, token_count long"


# --- calls


def test_calls_keep_their_order_and_their_bound():
    lock, open_now, most = threading.Lock(), [0], [0]

    def ask(n):
        with lock:
            open_now[0] += 1
            most[0] = max(most[0], open_now[0])
        time.sleep(0.02 if n % 3 else 0.05)
        with lock:
            open_now[0] -= 1
        return n * n

    assert list(providers.in_order(ask, iter(range(40)), 5)) == [n * n for n in range(40)]
    assert 2 <= most[0] <= 5
    most[0] = 0
    assert list(providers.in_order(ask, iter(range(4)), 1)) == [0, 1, 4, 9] and most[0] == 1
    assert list(providers.in_order(ask, iter([]), 5)) == []


def test_each_prompt_is_asked_once_and_failures_are_rows(spark, tmp_path):
    log = str(tmp_path / "asked")

    def counting(model, prompt):
        with open(log, "a") as f:  # a line an asked prompt, with the time it was under way
            f.write(f"{prompt} {time.time()}\n")
        time.sleep(0.01)
        if prompt.endswith("7"):
            raise RuntimeError("busy")
        return prompt.upper()

    rows = spark.createDataFrame([("m", f"p{n}", n) for n in range(60)], "model string, prompt string, n int")
    service = providers.Service(counting, window=4, tasks=2)
    told = building.asked_of(rows, service)
    for _ in range(2):  # read twice, asked once
        assert {(r["n"], r["content"], r["ok"]) for r in told.collect()} == {(n, f"P{n}" if n % 10 != 7 else "ERROR: RuntimeError: busy", n % 10 != 7) for n in range(60)}
    assert sorted(x.split()[0] for x in open(log)) == sorted(f"p{n}" for n in range(60))
    calls = service.calls(spark)
    s = intervals.summary(calls).first()
    assert (s["count"], s["errors"], s["input_tokens"]) == (60, 6, 60) and 1 <= s["max_concurrent"] <= 8
    assert providers.Service().calls(spark).count() == 0


def test_partials_of_any_cut_add_up(spark):
    calls = spark.createDataFrame([(f"m{i % 3}", float(i * 7 % 50), float(i * 7 % 50 + i % 9), i, 2 * i, i % 11 == 0) for i in range(200)], "model string, started_at double, ended_at double, input_tokens long, output_tokens long, errored boolean")
    want = sorted(map(str, intervals.summary(calls).collect()))
    parts = [ledger.partial(calls.where(F.col("input_tokens") % 4 == k)) for k in range(4)]
    assert sorted(map(str, ledger.finished(ledger.merged(parts)).collect())) == want
    assert sorted(map(str, ledger.finished(ledger.merged([ledger.merged(parts[:2]), parts[2], ledger.merged(parts[3:])])).collect())) == want
    runs = spark.createDataFrame([("a",), ("b",), ("a",)], "run_id string")
    got = {r["run_id"]: r for r in ledger.call_maps(intervals.summary(calls).withColumn("run_id", F.lit("a")), runs).collect()}
    assert got["b"]["llm_calls"] == {} and tuple(got["b"]["token_totals"]) == (0, 0, 0)
    assert set(got["a"]["llm_calls"]) == {"m0", "m1", "m2"} and got["a"]["token_totals"]["total"] == 3 * sum(range(200))
    added = spark.sql("select map('a', 1D, 'b', 2D) as x, map('b', 3D) as y, cast(null as map<string,double>) as z").select(ledger.merged_maps(F.col("x"), F.col("y")).alias("xy"), ledger.merged_maps(F.col("z"), F.col("y")).alias("zy")).first()
    assert added["xy"] == {"a": 1.0, "b": 5.0} and added["zy"] == {"b": 3.0}


# --- percentiles, charts


def test_selected_percentiles_equal_those_in_one_task(spark):
    rows = spark.createDataFrame([(("hot" if i % 3 else f"k{i % 5}") if i % 7 else None, None if i % 13 == 0 else float(i * 31 % 97) if i % 2 else 5.0) for i in range(900)] + [("one", 2.0), ("none", None)], "k string, v double")
    a = intervals.summarised(rows, ["k"], F.count("*").alias("n"), s=F.col("v"))
    b = intervals.summarised(rows, ["k"], F.count("*").alias("n"), s=F.col("v"), most=10, ranges=7)
    key = lambda r: str(r["k"])
    for x, y in zip(sorted(a.collect(), key=key), sorted(b.collect(), key=key), strict=True):
        assert (x["k"], x["n"]) == (y["k"], y["n"]) and (x["s"] is None) == (y["s"] is None)
        assert x["s"] is None or tuple(x["s"]) == pytest.approx(tuple(y["s"]))


def test_series_tables(spark):
    data = [("a", json.dumps([{"series": "s", "x": 1, "panel": "p"}, [{"y": 2.5, "x": None}, {"series": "s", "y": "t"}], 7])), ("b", "[]"), ("c", "[3]"), ("d", None), ("e", "no json")]
    got = series.tables(spark.createDataFrame(data, "key string, data string")).orderBy("series_nth", "row_nth").collect()
    assert [tuple(r) for r in got] == [("a", "s", 1, 1, ["x", "y"], ["1", ""]), ("a", "s", 1, 2, ["x", "y"], ["", "t"]), ("a", "data", 2, 1, ["x", "y"], ["None", "2.5"])]


# --- reports and the index tail


def test_pulls_run_at_once_and_only_if_enabled(spark):
    both = threading.Barrier(2, timeout=30)

    def pull(n):
        both.wait()  # each waits for the other
        return spark.range(n).count()

    assert reports.side_by_side({"a": lambda: pull(3), "b": lambda: pull(5), "c": lambda: 1 / 0}, {"c": False}) == {"a": 3, "b": 5, "c": None}
    with pytest.raises(ZeroDivisionError):
        reports.side_by_side({"a": lambda: 1, "c": lambda: 1 / 0})


def test_reports_of_other_schemas_are_built_again(spark, tmp_path):
    good = {"workflows": [{"type": "t", "count": 1, "success_count": 1, "failure_count": 0, "other_count": 0, "duration": {"count": 1, "max": 2.0, "p50": 2, "p95": 2.0, "p99": 2.0}}], "activities": [], "items": [{"items": 0, "succeeded": 0, "failed": 0}], "window": [], "hosts": [], "flags": []}
    bad = [dict(good, extra=[]), dict(good, workflows=[{"type": "t", "count": 1}]), dict(good, items=[{"items": 0.5, "succeeded": 0, "failed": 0}]), dict(good, flags=[{"flag": "x", "colour": "red"}]), {k: v for k, v in good.items() if k != "hosts"}]
    for n, report in enumerate([good, *bad]):
        (tmp_path / str(n)).mkdir()
        (tmp_path / str(n) / "report.json").write_text(json.dumps(report))
    assert reports.cached(spark, str(tmp_path / "0")) == good
    assert [reports.cached(spark, str(tmp_path / str(n))) for n in range(1, 7)] == [None] * 6


def test_one_failing_paper_leaves_the_others_indexed(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i % 4}", i) for i in range(20)], "paper string, n long")
    out, waits = str(tmp_path), str(tmp_path / "waits")

    def write(paper, points):
        if paper == "p2":
            raise OSError("store is down")
        points.to_parquet(f"{out}/{paper}.parquet")

    def sleep(seconds):
        with open(waits, "a") as f:
            f.write(f"{seconds} ")

    outcomes = index.tail(rows, write, "cpu", sleep)
    assert {tuple(r) for r in outcomes.collect()} == {("p0", True, 5, 1, None), ("p1", True, 5, 1, None), ("p2", False, 0, 3, "OSError: store is down"), ("p3", True, 5, 1, None)}
    assert open(waits).read() == "2.0 6.0 " and spark.read.parquet(*(f"{out}/p{k}.parquet" for k in (0, 1, 3))).count() == 15
    assert tuple(index.outcome_summary(outcomes).first()) == (4, 3, 1)


# --- trees from pages

READER = providers.heading_reader("[A-D]", "[E-R]")
BODY = ["x cover", "Alpha part one", "x", "Early topic here", "x", "x", "Final topic here", "x", "x", "Beta part two", "x", "Chapter last one", "x", "x", "x", "x", "Gone again now"]


def pages(spark, **docs):
    return spark.createDataFrame([(d, i, t, 50) for d, body in docs.items() for i, t in enumerate(body)], PAGES)


def told(df):
    return [(r["node_id"], ".".join(map(str, r["path"])), r["title"], r["start_index"], r["end_index"]) for r in df.orderBy("doc", "path").collect()]


def test_oversized_nodes_are_divided_on_their_own_pages(spark):
    opt = building.Options(toc_check_pages=1, max_pages=4, max_tokens=100)
    got = told(treebuild.structured(pages(spark, a=BODY), opt, READER))
    # Alpha spans pages 2 to 9, so its own headings become nodes under it, and it ends where the first of them begins;
    # of Chapter's pages 12 to 17 the first heading is the chapter itself
    assert got == [("0000", "0", "Preface", 1, 1), ("0001", "1", "Alpha part one", 2, 4), ("0002", "1.2", "Early topic here", 4, 6), ("0003", "1.3", "Final topic here", 7, 9), ("0004", "2", "Beta part two", 10, 11), ("0005", "3", "Chapter last one", 12, 17), ("0006", "3.2", "Gone again now", 17, 17)]
    small = told(treebuild.structured(pages(spark, a=BODY), building.Options(toc_check_pages=1, max_pages=4, max_tokens=10_000), READER))
    assert [x[1:] for x in small] == [("0", "Preface", 1, 1), ("1", "Alpha part one", 2, 9), ("2", "Beta part two", 10, 11), ("3", "Chapter last one", 12, 17)]


def test_a_division_without_progress_stops(spark, tmp_path):
    log = str(tmp_path / "asked")

    def stubborn(model, prompt):  # one section from the first page on, under another title each time
        if not prompt.startswith(("List", "Continue")):
            raise RuntimeError("down")
        with open(log, "a") as f:
            f.write("x")
        return json.dumps({"toc": [{"structure": "1", "title": f"Whole {os.path.getsize(log)}", "physical_index": "<physical_index_1>"}]})

    yes = lambda m, x: json.dumps({"answer": "yes", "start_begin": "yes"})
    nodes = told(treebuild.structured(pages(spark, a=["text"] * 12), building.Options(toc_check_pages=1, max_pages=4, max_tokens=100), stubborn, yes))
    assert [x[2:] for x in nodes] == [("Whole 1", 1, 1), ("Whole 2", 1, 12)] and os.path.getsize(log) == 2


def test_built_trees_with_summaries_and_a_ledger(spark):
    def model(name, prompt):
        if prompt.startswith("Summarise"):
            return "A concise summary."
        return json.dumps({"faithful": "yes", "missed_topics": []}) if prompt.startswith("Is this summary") else READER(name, prompt)

    service = providers.Service(model, window=3, tasks=2)
    opt = building.Options(toc_check_pages=1, max_pages=4, max_tokens=100, overlap_pages=0)
    got = treebuild.built(pages(spark, a=BODY, b=["Alpha part one", "x"]), opt, service)
    nodes = got.nodes.collect()
    assert {r["doc"] for r in nodes} == {"a", "b"} and {r["summary"] for r in nodes} == {"A concise summary."}
    assert sorted((r["doc"], r["total_pages"], r["description"]) for r in got.documents.collect()) == [("a", 17, None), ("b", 2, None)]
    calls = service.calls(spark)
    assert intervals.summary(calls).first()["count"] == calls.count() >= 2 * len(nodes)


def test_slices_are_fixed_within_their_pages(spark):
    p = pages(spark, a=BODY)
    units = spark.createDataFrame([("a/1", "a", 4, 9)], "doc string, source string, first int, last int")
    made = spark.createDataFrame([("a/1", 1, "1", "Early topic here", 4), ("a/1", 2, "2", "Final topic here", 9), ("a/1", 3, "3", "Beta part two", 20)], "doc string, ord int, structure string, title string, physical_index int")
    ask = lambda m, x: json.dumps({"physical_index": "<physical_index_7>"}) if "Final" in x.split("\n")[0] else "{}"
    got = processing.accepted(made, p, units, building.Options(), ask, None, True)
    assert sorted((r["ord"], r["physical_index"]) for r in got.collect()) == [(1, 4), (2, 9)]  # half right: not enough to be fixed
    more = made.where("ord < 3").unionByName(spark.createDataFrame([("a/1", 0, "0", "Early topic here", 4)], made.schema))
    got = processing.accepted(more, p, units, building.Options(), ask, None, True)
    assert sorted((r["ord"], r["physical_index"]) for r in got.collect()) == [(0, 4), (1, 4), (2, 7)]


def test_each_section_is_checked_once(spark, tmp_path):
    log = str(tmp_path / "checked")

    def checks(model, prompt):
        if prompt.startswith("Does the section"):
            with open(log, "a") as f:
                f.write(prompt.split(" on this page")[0].split(" this page?")[0] + "\n")
        return json.dumps({"answer": "yes", "start_begin": "yes"})

    opt = building.Options(toc_check_pages=1, max_pages=4, max_tokens=10_000)
    nodes = told(treebuild.structured(pages(spark, a=BODY), opt, READER, checks))
    assert [x[1:] for x in nodes] == [("0", "Preface", 1, 1), ("1", "Alpha part one", 2, 9), ("2", "Beta part two", 10, 11), ("3", "Chapter last one", 12, 17)]
    assert len(open(log).readlines()) == 6  # two questions for each of three sections


def test_tagged_pages_are_read_as_a_pattern_finds_them():
    import re

    pattern = re.compile(r"<physical_index_(\d+)>\n(.*?)\n<physical_index_\1>", re.DOTALL)
    tag = "<physical_index_{}>".format
    parts = [tag(1), tag(2), tag(12), "\n", "Alpha part one", "Beta\npart", "x", "<physical_index_"]
    for n in range(400):
        prompt = "".join(parts[(n * 31 + k * k * (n % 7 + 1) + k) % len(parts)] for k in range(24))
        pages_of = {int(a): x for a, x in pattern.findall(prompt)}
        got = json.loads(providers.heading_reader("[A-R]", "[A-R]")("m", prompt))["toc"]
        want = [p for p, x in pages_of.items() if 5 <= len(" ".join(x.split(" ")[:4])) <= 300 and re.match("[A-R]", x)]
        assert [int(re.search(r"\d+", r["physical_index"])[0]) for r in got] == want
