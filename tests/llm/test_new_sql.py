import os

import pytest

from leafline.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_decontamination", "op12_collocations", "op13_periodic_runs"])
def test_query_matches_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    got = registry.QUERIES[name](spark, SF)
    found = con.execute(registry.ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, found.fetchall()))
