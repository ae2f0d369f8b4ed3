import uuid

import pytest
from pyspark.sql import functions as F

from leafline.functions import html, ids, providers, text
from leafline.operators import batch, chunks, elements, history, index
from leafline.sources import config, documents, sinks
from leafline.streaming import ingest


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (text.transform_dots, "Intro ....... 5 . . . . . .", "Intro :  5 : "),
        (text.slug, "My Paper (v2).pdf", "my-paper-v2-pdf"),
        (text.slug, "!!!", "unknown"),
        (text.yes_no, " Yes ", "yes"),
        (text.yes_no, "maybe", "no"),
        (text.yes_no, None, "no"),
        (lambda c: text.yes_no(F.lit(1)), "x", "no"),
        (lambda c: text.yes_no(F.lit(True)), "x", "yes"),
        (lambda c: text.yes_no(F.lit(False)), "x", "no"),
        (lambda c: text.yes_no(F.lit("1")), "x", "yes"),
        (text.render_kind, "x <analyze>y</analyze>", "analyze"),
        (text.render_kind, "x <analyze>y", "pre"),
        (text.render_kind, '<div data-bbox="1">', "layout"),
        (text.render_kind, "data-bbox", "pre"),
        (text.render_kind, "a | b\nc | d", "table"),
        (text.render_kind, "a | b", "pre"),
        (text.parse_page_tag, "<physical_index_12>", 12),
        (text.parse_page_tag, "page 12", None),
        (text.without_fences, '```json\n{"a": 1}\n```', '{"a": 1}'),
        (text.without_fences, '{"a": 1}', '{"a": 1}'),
        (text.looks_like_citation, "S. Y. Sayed, K. P. Yao", True),
        (text.looks_like_citation, "Results", False),
        (text.looks_like_citation, None, False),
        (text.first_table, "x <TABLE><tr></tr></TABLE> y", "<TABLE><tr></tr></TABLE>"),
        (text.first_table, "none", None),
        (text.section_block, "<<<context-before>>>\nb\n<<<section-content>>>\n core \n<<<context-after>>>\na", "core"),
        (text.section_block, "plain", "plain"),
        (text.word_count, None, 0),
        (lambda c: text.truncated(c, 100), "x" * 150, "x" * 100 + "…[+50 more chars]"),
        (lambda c: text.truncated(c, 100), "x" * 100, "x" * 100),
        (batch.duration, "30m", 1800),
        (batch.duration, "7x", None),
    ],
)
def test_text(spark, f, value, want):
    assert one(spark, value, f) == want


def test_entities(spark):
    got = one(spark, "NaPF6 in EC and Hard Carbon: 3.5 eV, P2-type NaxMnO2, 42", lambda c: text.entities(c, ["EC", "hard carbon", "DME"]))
    assert {"EC", "NaPF6", "hard carbon", "3.5 eV"} <= set(got) and got == sorted(got) and "DME" not in got and "42" not in got
    assert one(spark, "", lambda c: text.entities(c, ["EC"])) == []


def test_uuid5(spark):
    for name in ("p1:n1:0", "é:ü:1"):
        assert one(spark, name, ids.uuid5) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<table><thead><tr><th>A</th><th>B</th></tr></thead><tr><td>1</td><td>2</td></tr></table>", "| A | B |\n| --- | --- |\n| 1 | 2 |"),
        ("<table><tr><td>a</td></tr><tr><th>H</th></tr></table>", "| H |\n| --- |\n| a |"),
        ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "| a | b |\n| --- | --- |\n| c |  |"),
        ("<table><tr><td> hello \n world </td><td>a|b</td><td>line1<br>line2</td><td><b>bold</b> value</td></tr></table>", "| hello world | a\\|b | line1 line2 | bold value |\n| --- | --- | --- | --- |"),
        ("<table></table>", ""),
        ("<td>x</td><TABLE><TR><TH>a &amp; b</TH><TD>c</td></TR>lost<tr></tr><tr><td>d</td></tr></TABLE><td>y</td>", "| a & b | c |\n| --- | --- |\n| d |  |"),
        ("<table><tr><td>open<td>a</td></tr><tr><th>never<td>b</td></tr><tr><td>c</td></table>", "| b |\n| --- |\n| a |"),  # an open cell or row is dropped, an open header cell still leads
        ("<table><!-- <tr><td>no</td></tr> --><tr class='a>b'><td>x<!-- y --></td><td/><td>z</th></tr></table>", "| x | z |\n| --- | --- |"),
    ],
)
def test_tables(source, want):
    assert html.table_markdown(source) == want


def test_vision():
    assert html.vision("") is None and html.vision(None) is None
    assert html.vision('<analyze>[{"titles":"T","x_labels":""},{}]</analyze>') == {"format": "figure_analysis", "panels": [{"title": "T"}]}
    assert html.vision('<analyze>[{"titles":"T"},{"titles":"U') == {"format": "figure_analysis", "panels": [{"title": "T"}], "truncated": True}
    assert html.vision("<analyze>[")["error"] == "unrecoverable"
    assert html.vision('<analyze>[{"titles":["a"]},{"titles":"b","x":{"y":1},') == {"format": "figure_analysis", "truncated": True, "panels": [], "error": "unrecoverable"}
    assert html.vision('<analyze> {"titles":"T"} and more')["panels"] == [{"title": "T"}]
    block = html.vision('<div data-label="T"><!-- c --><P CLASS=\'x "y"\' hidden>a &amp; b &lt;i&gt;<BR/></P></div>')["blocks"][0]
    assert (block["html"], block["text"]) == ('<p class="x "y"">a & b <i><br/></p>', "a & b")
    got = html.vision('<div data-label="Text" data-bbox="1 2 3 4"><div>a <math>x</math></div></div><div data-label="B" data-bbox="no">b</div>')
    assert [(b["label"], b["bbox"], b["text"]) for b in got["blocks"]] == [("Text", [1, 2, 3, 4], "a x"), ("B", None, "b")] and got["blocks"][0]["math"] == ["x"]
    assert html.vision("z" * 900)["raw_head"] == "z" * 500
    assert html.vision('<ANALYZE>{"legends":["a"],"other":1}</Analyze>')["panels"] == [{"legend": ["a"]}]
    assert "error" in html.vision("<analyze>[}</analyze>")
    nested = html.vision('<div><div data-label="A">x<div data-label="In">y</div></div></div><div data-bbox="1 2 3 -4" data-label=C>z<br/></div><div data-label="open">w')
    assert [(b["label"], b["bbox"], b["text"]) for b in nested["blocks"]] == [("A", None, "x y"), ("C", None, "z")]


def test_captions_go_one_to_one(spark, rows):
    box = "doc string, page int, ord int, label string, x0 int, y0 int, x1 int, y1 int"
    b = spark.createDataFrame([("d", 1, 1, "figure", 0, 0, 100, 100), ("d", 1, 2, "figure", 0, 150, 100, 200), ("d", 1, 3, "figure_caption", 0, 110, 100, 140), ("d", 1, 4, "figure_caption", 400, 110, 500, 140)], box)
    assert rows(elements.paired_captions(b)) == [("d", 1, 1, 3)]


def test_updates_need_place_and_id(spark, rows):
    e = spark.createDataFrame([("d", 0, 0, "a", "old"), ("d", 0, 1, "b", None)], "doc string, page_idx int, elem_idx int, element_id string, caption string")
    u = spark.createDataFrame([("d", 0, 0, "a", 1, "new"), ("d", 0, 0, "a", 2, None), ("d", 0, 1, "x", 3, "lost")], "doc string, page_idx int, elem_idx int, element_id string, ord int, caption string")
    assert rows(elements.merged_updates(e, u, ["caption"]).select("element_id", "caption")) == [("a", "new"), ("b", None)]


def test_chunks(spark):
    papers = spark.createDataFrame([("p", "An abstract.", 5), ("q", None, 1)], "paper string, abstract string, total_pages int")
    leaves = spark.createDataFrame([("p", "0001", "M", ["Root", "M"], 1, 2, "word " * 400), ("q", "0000", "W", ["W"], 1, 1, "  ")], "paper string, node_id string, title string, breadcrumb array<string>, start_index int, end_index int, raw_text string")
    el = spark.createDataFrame([("p", "0001", 0, "tbl_1", "table", 2, "<b>| a |</b>", "Table 1")], "paper string, node_id string, ord int, element_id string, element_type string, page_index int, structured_data string, caption string")
    got = chunks.chunk(chunks.units(papers, leaves, el), 128, 16).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(len(got)))
    assert got[0]["doc_id"] == "p:abstract:0" and got[0]["depth"] == 0 and got[0]["page_end"] == 3
    section = [r for r in got if r["kind"] == "section_text"]
    assert [r["sub_index"] for r in section] == list(range(len(section))) and len(section) > 2 and max(r["token_count"] for r in section) <= 128 and section[0]["depth"] == 2
    assert [(r["kind"], r["text"]) for r in got[-2:]] == [("table", "| a |"), ("caption", "Table 1")]
    with pytest.raises(ValueError):
        chunks.chunk(chunks.units(papers, leaves, el), 16, 16)


def test_split_covers_the_text():
    s = "One two three. " * 200 + "x" * 3000
    parts = chunks.split(s, 64, 8)
    assert all(chunks.tokens(p) <= 64 for p in parts) and parts[0].startswith("One two") and parts[-1].endswith("xxx")
    assert chunks.split("  ") == [] and chunks.split("short") == ["short"]


def test_manifest_and_shards(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"batch_id":"b","items":[{"document_id":"a","pdf_uri":"x"},{"document_id":"b c","pdf_uri":"y"}]}')
    m = documents.manifest(spark, str(tmp_path / "m.json"))
    assert [r["error"] for r in batch.manifest_errors(m).collect()] == ["bad id"]
    with pytest.raises(ValueError):
        batch.validated(m)
    with pytest.raises(ValueError):
        batch.sharded(m, "b", 0)
    many = spark.range(123).select(F.col("id").alias("item_ord"), F.concat(F.lit("d"), "id").alias("document_id"))
    got = {r["shard_id"]: r["n"] for r in batch.sharded(many, "q2").groupBy("shard_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"q2-shard-0000": 50, "q2-shard-0001": 50, "q2-shard-0002": 23}


def test_points_replace_a_paper(spark, tmp_path):
    p = spark.createDataFrame([("a", "a:1:0", 1), ("b", "b:1:0", 1)], "paper string, doc_id string, v int")
    at = str(tmp_path / "t")
    assert sinks.create_table(spark, at, 4) and not sinks.create_table(spark, at, 4)
    assert sinks.upsert_points(index.points(p), at) == 2
    assert sinks.upsert_points(index.points(p.where("paper = 'a'").withColumn("v", F.lit(2))), at) == 1
    assert sinks.upsert_points(index.points(p.limit(0)), at) == 0
    got = lambda: {r["paper"]: r["v"] for r in spark.read.parquet(f"{at}/paper=*").select(F.regexp_extract(F.input_file_name(), "paper=([a-z])", 1).alias("paper"), "v").collect()}
    assert got() == {"a": 2, "b": 1}
    sinks.delete_papers(spark, at, ["a", "zzz"])
    assert got() == {"b": 1}


def test_zip_needs_equal_lengths(spark):
    c = spark.createDataFrame([("p", 0), ("p", 1)], "paper string, position int")
    with pytest.raises(Exception, match="differ"):
        index.zipped(c, c.withColumn("d", F.lit(1)).limit(1), c.withColumn("s", F.lit(1))).collect()


def test_provider_failures_are_rows(spark):
    p = spark.createDataFrame([("m", "good"), ("m", "bad")], "model string, prompt string")

    def model(name, prompt):
        if prompt == "bad":
            raise RuntimeError("down")
        return '{"answer": "yes"}'

    got = {r["prompt"]: r for r in providers.call(p, model, "title_appearance").collect()}
    assert got["good"]["ok"] and not got["bad"]["ok"] and got["bad"]["attempts"] == 3 and got["bad"]["content"].startswith("ERROR: ")
    assert providers.call(p).where("ok").count() == 2
    with pytest.raises(KeyError):
        providers.call(p, response="nope")


def test_compared_is_a_full_join(spark, rows):
    a = spark.createDataFrame([("x", 2.0), ("y", 1.0)], "t string, v double")
    b = spark.createDataFrame([("y", 2.0), ("z", 4.0)], "t string, v double")
    assert [r[:4] for r in rows(history.compared(a, b, "t", "v"))] == [("x", 2.0, 0.0, 2.0), ("y", 1.0, 2.0, -1.0), ("z", 0.0, 4.0, -4.0)]


def test_redelivery_adds_nothing(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"uri":"s3://b/My Doc.pdf","received_at":"2024-01-01T00:00:00Z"}\n{"uri":"","received_at":"2024-01-01T00:00:00Z"}\n')
    for n in range(2):
        ingest.ingest(ingest.messages(spark, str(src)), str(tmp_path / "out"), str(tmp_path / f"cp{n}")).awaitTermination()
    assert [r["document_id"] for r in ingest.collected(spark, str(tmp_path / "out")).collect()] == ["my-doc"]


def test_config(tmp_path):
    assert config.merged({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"y": 3}, "b": None}) == {"a": {"x": 1, "y": 3}, "b": 1}
    (tmp_path / "c.json").write_text('{"output_dir": "out", "layout": {"model_path": "hf://m"}, "entities": ["EC"]}')
    c = config.load(str(tmp_path / "c.json"))
    assert c["output_dir"] == str((tmp_path / "out").resolve()) and c["layout"]["model_path"] == "hf://m"
    assert config.seeds(str(tmp_path / "none.json")) == [] and config.seeds(str(tmp_path / "c.json")) == ["EC"]
