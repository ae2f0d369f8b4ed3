import pytest
from pyspark.sql import functions as F

from leafline.operators import history, toc, trees
from leafline.sources import documents, sinks

TOC = "doc string, ord int, structure string, title string, physical_index int, appear_start string"
NODES = "doc string, key string, dfs int, start_index int, end_index int"
PAGES = "doc string, page_idx int, text string, token_count long"


def test_node_text_clamps_and_joins_in_order(spark):
    p = spark.createDataFrame([("d", 0, "PAGE-1 ", 1), ("d", 1, "PAGE-2 ", 1), ("d", 2, "PAGE-3 ", 1)], PAGES)
    n = spark.createDataFrame([("d", "a", 0, 1, 2), ("d", "b", 1, 2, 99), ("d", "c", 2, 3, 2), ("e", "x", 0, 1, 1)], NODES)
    got = {r["key"]: r["raw_text"] for r in trees.node_text(n, p).collect()}
    assert got == {"a": "PAGE-1 PAGE-2 ", "b": "PAGE-2 PAGE-3 ", "c": "", "x": ""}


def test_the_last_node_in_preorder_owns_a_page(spark, rows):
    n = spark.createDataFrame([("d", "root", 0, 1, 4), ("d", "a", 1, 2, 3), ("d", "b", 2, 3, 3)], NODES)
    assert rows(trees.page_owner(n)) == [("d", 1, "root"), ("d", 2, "a"), ("d", 3, "b"), ("d", 4, "root")]


def test_ranges_and_preface(spark, rows):
    t = spark.createDataFrame([("d", 1, "1", "A", 2, "no"), ("d", 2, "2", "B", 5, "yes"), ("d", 3, "3", "C", 5, "no")], TOC)
    got = trees.section_ranges(t, F.lit(9)).select("ord", "start_index", "end_index")
    assert rows(got) == [(1, 2, 4), (2, 5, 5), (3, 5, 9)]
    assert [r["title"] for r in trees.with_preface(t).orderBy("ord").collect()] == ["Preface", "A", "B", "C"]


def test_parents_must_come_earlier_and_the_latest_wins(spark):
    t = spark.createDataFrame([("d", 1, "1.1", "x", 1, ""), ("d", 2, "1", "y", 1, ""), ("d", 3, "1", "z", 1, ""), ("d", 4, "1.2", "w", 1, ""), ("d", 5, None, "v", 1, "")], TOC)
    assert {r["ord"]: r["parent_ord"] for r in trees.parents(t).collect()} == {1: None, 2: None, 3: None, 4: 3, 5: None}


def test_preorder_breadcrumbs_and_leaves(spark):
    n = spark.createDataFrame([("d", 0, None, "Root"), ("d", 1, 0, "Kid"), ("d", 2, 1, "Grand"), ("d", 3, 0, "Leaf2")], "doc string, ord int, parent_ord int, title string")
    walked = trees.preorder(n)
    assert [(r["node_id"], r["title"]) for r in walked.orderBy("node_id").collect()] == [("0000", "Root"), ("0001", "Kid"), ("0002", "Grand"), ("0003", "Leaf2")]
    assert {r["title"]: r["breadcrumb"] for r in trees.leaves(walked).collect()} == {"Grand": ["Root", "Kid", "Grand"], "Leaf2": ["Root", "Leaf2"]}
    j = sinks.nested_trees(walked.withColumns({"start_index": F.lit(1), "end_index": F.lit(2)})).first()["tree"]
    assert j.startswith('[{"title":"Root"') and j.count('"nodes"') == 2


def test_citation_runs_collapse_once(spark, rows):
    titles = ["Introduction"] + [f"S. Y. Sayed{i}, 2016, 6, 16{i}" for i in range(6)]
    n = spark.createDataFrame([("d", "p", i, t, 40 + i, 41 + i, True) for i, t in enumerate(titles)], "doc string, parent string, ord int, title string, start_index int, end_index int, is_leaf boolean")
    once = trees.citation_runs(n)
    assert [(r["title"], r["start_index"], r["end_index"]) for r in once.orderBy("ord").collect()] == [("Introduction", 40, 41), ("References", 41, 47)]
    assert rows(trees.citation_runs(once)) == rows(once)
    assert trees.citation_runs(n.where("ord < 5")).count() == 5


def reference_groups(tokens, most, overlap):
    if sum(tokens) <= most:
        return [list(range(len(tokens)))]
    cap = toc.expected_group_cap(sum(tokens), most)
    out, now = [], []
    for k, n in enumerate(tokens):
        if now and sum(tokens[i] for i in now) + n > cap:
            out.append(now)
            now = list(range(max(k - overlap, 0), k))
        now.append(k)
    return [*out, now]


def test_page_groups_match_a_plain_loop(spark):
    import random

    random.seed(3)
    docs = {f"d{n}": [random.randint(1, 60) for _ in range(random.randint(1, 30))] for n in range(20)}
    p = spark.createDataFrame([(d, i, "", n) for d, t in docs.items() for i, n in enumerate(t)], PAGES)
    got = {}
    for r in toc.page_groups(p, 100, 1).orderBy("doc", "grp", "page_idx").collect():
        got.setdefault(r["doc"], {}).setdefault(r["grp"], []).append(r["page_idx"])
    assert {d: list(g.values()) for d, g in got.items()} == {d: reference_groups(t, 100, 1) for d, t in docs.items()}


def test_offset_ties_go_to_the_first_seen(spark):
    pairs = spark.createDataFrame([("d", "a", 1, 3, 1), ("d", "b", 5, 6, 2), ("d", "c", 9, 11, 3), ("d", "d", 8, 9, 4), ("d", "e", None, 4, 5)], "doc string, title string, page int, physical_index int, ord int")
    assert toc.page_offset(pairs).first()["offset"] == 2


def test_anchors_and_corrections(spark, rows):
    t = spark.createDataFrame([("d", i, "", "", x, "") for i, x in enumerate([None, 3, None, 7, None])], TOC)
    assert rows(toc.anchors(t, F.lit(0), F.lit(-1)).select("ord", "prev_index", "next_index")) == [(0, 0, 3), (1, 0, 7), (2, 3, 7), (3, 3, -1), (4, 7, -1)]


def test_tree_files_become_rows(spark, tmp_path):
    (tmp_path / "tree.json").write_text('{"paper_id":"p","total_pages":4,"root_nodes":[{"title":"A","node_id":"0000","start_index":1,"end_index":4,"nodes":[{"title":"B","node_id":"0001","start_index":2,"end_index":3}]}]}')
    got = documents.trees(spark, str(tmp_path / "tree.json"))
    assert {(r["title"], tuple(r["path"]), tuple(r["parent_path"]), r["depth"]) for r in got.collect()} == {("A", (0,), (), 1), ("B", (0, 0), (0,), 2)}


def test_deep_trees_are_walked_whole(spark):
    n = spark.createDataFrame([("d", i, i - 1 if i else None, f"t{i}") for i in range(34)], "doc string, ord int, parent_ord int, title string").repartition(1)
    assert sorted((r["ord"], r["depth"], r["node_id"]) for r in trees.preorder(n).collect()) == [(i, i + 1, f"{i:04d}") for i in range(34)]
    w = n.select(F.col("ord").alias("workflow_id"), F.col("parent_ord").alias("parent_id"), F.col("title").alias("type"))
    assert sorted(r["workflow_id"] for r in history.subtree(w, 15).collect()) == list(range(15, 34))
    loop = w.where("workflow_id > 0").unionByName(spark.createDataFrame([(0, 3, "t")], "workflow_id int, parent_id int, type string"))
    assert history.subtree(loop.where("workflow_id < 6"), 2).count() == 6
    spark.catalog.clearCache()


def test_a_node_above_itself_is_an_error(spark):
    n = spark.createDataFrame([("d", 1, None, "a"), ("d", 1, 1, "b")], "doc string, ord int, parent_ord int, title string")
    with pytest.raises(Exception, match="own ancestor"):
        trees.preorder(n).collect()


def test_deep_trees_are_read_and_written_whole(spark, tmp_path):
    import json

    node = None
    for d in range(40, 0, -1):
        node = {"title": f"T{d}", "node_id": f"{d:04d}", "start_index": d, "end_index": 40} | ({"nodes": [node]} if node else {})
    (tmp_path / "tree.json").write_text(json.dumps({"paper_id": "p", "root_nodes": [node]}))
    got = documents.trees(spark, str(tmp_path / "tree.json"))
    assert [(r["depth"], r["title"], len(r["path"])) for r in got.orderBy("depth").collect()] == [(d, f"T{d}", d) for d in range(1, 41)]
    assert json.loads(sinks.nested_trees(got).first()["tree"]) == [node]


def test_parents_need_no_join_and_merge_equal_rows(spark):
    """One window instead of a join of the table with itself; equal rows are one, and rows of one ord aren't each other's parents."""
    data = [("d", 1, "1"), ("d", 2, "1.1"), ("d", 2, "1.1"), ("d", 2, "1"), ("d", 3, "1.1"), ("d", 4, "1.1.1"), ("d", 5, None), ("d", 6, "2.1"), ("e", 1, "1.1"), ("e", 2, "1")]
    got = trees.parents(spark.createDataFrame(data, "doc string, ord int, structure string"))
    want = [("d", 1, "1", None), ("d", 2, "1.1", 1), ("d", 2, "1", None), ("d", 3, "1.1", 2), ("d", 4, "1.1.1", 3), ("d", 5, None, None), ("d", 6, "2.1", None), ("e", 1, "1.1", None), ("e", 2, "1", None)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_post_processing_moves_sections_by_document_alone(spark):
    from leafline.operators import processing

    data = [("d", n, s, t, n, "no") for n, (s, t) in enumerate([("1", "One"), ("1.1", "Two"), *((f"1.1.{k}", f"A. B. Name{k}") for k in range(6)), ("2", "Three")], 1)]
    made = processing.post_processed(spark.createDataFrame(data, "doc string, ord int, structure string, title string, physical_index int, appear_start string"), F.lit(9))
    assert sorted(tuple(r) for r in made.select("ord", "title", "start_index", "end_index", "is_leaf").collect()) == [(1, "One", 1, 2, False), (2, "Two", 2, 3, False), (3, "References", 3, 9, True), (9, "Three", 9, 9, True)]
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString()
