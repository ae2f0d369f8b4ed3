import os

import pytest

import __spark_entry__ as entry
from leafline.plans import registry

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    got = registry.QUERIES[name](spark, SF)
    found = con.execute(registry.ORACLES[name])
    names, want = [x[0] for x in found.description], found.fetchall()
    cols = sorted(got.columns)
    assert sorted(names) == cols

    def canon(rows):
        cell = lambda v: repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
        return sorted(tuple(cell(r[c]) for c in cols) for r in rows)

    assert canon(r.asDict() for r in got.collect()) == canon(dict(zip(names, r, strict=True)) for r in want)


def test_assembled_text_holds_all_pages(spark, tmp_path):
    docs = [(1, "\n".join(f"page {i} ....... {i}" for i in range(12))), (2, "one"), (3, "a\n\nb\nc")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc"]: r["core"] for r in registry.QUERIES["p8_assembled"](spark, str(tmp_path)).collect()}
    tag = lambda i, x: f"<physical_index_{i}>\n{x}\n<physical_index_{i}>\n\n"
    assert got == {k: "".join(tag(i, x) for i, x in enumerate(t.split("\n"), 1)).replace(".......", ": ") for k, t in docs}


def test_headings_of_all_page_groups_settle_the_level(spark, tmp_path):
    """A document of several page groups, and an oversized section of several, whose kinds of headings only meet in later groups."""
    duckdb = pytest.importorskip("duckdb")
    fill = lambda n: [f"x {' '.join(['word'] * 120)}" for _ in range(n)]
    late = ["Early topic of one", *fill(60), "Further topic of two", *fill(60), "Beta part that is late", *fill(3)]
    long = ["Alpha part that is long", *fill(130), "Final topic of the part", *fill(3), "Chapter that is last"]
    spark.createDataFrame([(1, "\n".join(late)), (2, "\n".join(long))], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got = registry.QUERIES["h10_tree_structure"](spark, str(tmp_path))
    found = con.execute(registry.ORACLES["h10_tree_structure"])
    want = [dict(zip([x[0] for x in found.description], r, strict=True)) for r in found.fetchall()]
    assert sorted(tuple(r[c] for c in got.columns) for r in want) == sorted(map(tuple, got.collect()))
