import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.llm import search, vectors

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def rows(seed=1, n=300, d=8):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, d))
    base[::3] = base[0] + r.normal(size=(len(base[::3]), d)) * 0.05
    base[5::7] = base[5]
    x = (base / np.linalg.norm(base, axis=1)[:, None]).astype(np.float32)
    out = [(i, v.tolist(), int(i % 3), "x") for i, v in enumerate(x)]
    odd = [(900, None, 1, "x"), (901, [], 1, "x"), (902, [0.0] * d, 1, "x"), (903, [NAN] + [1.0] * (d - 1), 1, "x"), (904, [INF] + [1.0] * (d - 1), 1, "x"), (905, [None] + [1.0] * (d - 1), 1, "x"), (906, x[0].tolist(), None, "x"), (None, x[0].tolist(), 1, "x"), (950, x[3].tolist(), 0, None)]
    return out + odd


def usable(v, zero=False):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and (zero or any(v))


@pytest.mark.parametrize(("block", "k"), [(4096, 5), (16, 5), (7, 2)])
def test_top_k_is_exact(spark, block, k):
    data = rows()
    got = search.top_k(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 50 == 0, k=k, block=block, query_block=3)
    use = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64)) for i, v, *_ in data if i is not None and usable(v, True)]
    want = []
    for q, x in use:
        if q % 50 == 0:
            best = sorted((-int(x @ y), i) for i, y in use if i != q)[:k]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize(("block", "k"), [(4096, 5), (16, 5), (7, 2)])
def test_repeated_ids_leave_room_for_others(spark, block, k):
    r = np.random.default_rng(8)
    x = r.normal(size=(200, 8)).round(2)
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    data += [(0, x[0].tolist())] * 7 + [(3, x[0].tolist())] * 9 + [(50, (x[50] * (1 + i / 50)).tolist()) for i in range(12)]
    data += [(i, (x[150] * 1.5).tolist()) for i in (4, 4, 4, 5, 150, 9, 9, 6, 7, 8)] + [(6, (x[100] * (1 + i)).tolist()) for i in range(9)]
    got = search.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, k=k, block=block, query_block=3)
    use = [(i, np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(np.int64)) for i, v in data]
    want = []
    for q, v in {(q, tuple(v)) for q, v in use if q % 50 == 0}:
        best = sorted((-int(np.array(v) @ y), i) for i, y in use if i != q)[:k]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(x) for x in got.collect()) == sorted(want)


def test_large_components_and_scores_beyond_64_bits(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(120, 6))
    x[::4] *= 1e8
    x[::10] *= 1e9
    x[7] = 1e300
    x[50] = -1e300
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    got = search.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, block=16, query_block=2)
    low, high = -(2**63), 2**63 - 1
    use = [(i, [max(low, min(high, math.floor(256 * c))) for c in v]) for i, v in data]
    want = []
    for q, a in use:
        if q % 50 == 0:
            best = sorted((-max(low, min(high, sum(s * t for s, t in zip(a, b, strict=True)))), i) for i, b in use if i != q)[:5]
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(t) for t in got.collect()) == sorted(want)


def test_query_equals_its_sql(spark, tmp_path):
    import duckdb

    df = spark.createDataFrame([x[:2] for x in rows(7, 400) if x[0] is not None], "vec_id long, embedding array<float>")
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    got = search.op6_topk_search(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(search.OP6_SQL).fetchall())


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame([(0, [0.5, 0.5], 1, ""), (50, [0.1, 0.2], 1, "")], SCHEMA)
    assert sorted(tuple(r)[:3] for r in search.top_k(df, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 50), (50, 1, 0)]
    assert search.top_k(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_approximations_bound_scores():
    r = np.random.default_rng(2)
    q, v = r.integers(-200, 200, (20, 16)), r.integers(-300, 300, (50, 16))
    low, up = search.bounds(q, v // search.CELL_WIDTH)
    assert (low <= q @ v.T).all() and (q @ v.T <= up).all()


@pytest.mark.parametrize("cell", [1000, 5])
def test_near_vectors_match_all_pairs(spark, cell):
    data = rows(3)
    got = {(r["vec_id"]): r for r in vectors.near_duplicates(spark.createDataFrame(data, SCHEMA), cell=cell).collect()}
    use = [(i, np.array(v, dtype=np.float32).astype(np.float64), l) for i, v, l, _ in data if i is not None and l is not None and usable(v)]
    x = np.array([v / np.linalg.norm(v) for _, v, _ in use])
    label = np.array([l for *_, l in use])
    link = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(len(use))
    for _ in use:
        comp = np.minimum(comp, np.where(link, comp[None, :], len(use)).min(axis=1))
    assert len(got) == len(data)
    for n, (i, *_) in enumerate(use):
        root = use[comp[n]][0]
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (link[n].sum(), root, root == i)
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["n_links"] == 0 and not got[None]["kept"]


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, ""), (1, [1.0, 0.0], 1, ""), (2, [1.0, 0.01], 1, ""), (3, [1.0, 0.0], 2, "")], SCHEMA)
    assert sorted(tuple(r) for r in vectors.near_duplicates(df).collect()) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_text_labels_compare_as_they_are(spark):
    v = [[1.0, 0.0], [1.0, 0.02], [1.0, 0.0], [1.0, 0.01], [0.0, 1.0]]
    df = spark.createDataFrame([(i, x, l) for i, (x, l) in enumerate(zip(v, ["a", "a", "A", " a", "a"], strict=True))], "vec_id long, embedding array<double>, label string")
    assert sorted(tuple(r) for r in vectors.near_duplicates(df).collect()) == [(0, 1, 0, True), (1, 1, 0, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True)]


def test_colliding_hashes_keep_vectors_apart(spark, monkeypatch):
    whole = vectors.hashes
    monkeypatch.setattr(vectors, "hashes", lambda *v: (F.pmod(whole(*v)[0], F.lit(3)), whole(*v)[1]))
    test_near_vectors_match_all_pairs(spark, 5)


def test_hot_keys_join_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(vectors.common, "HOT", 2)
    monkeypatch.setattr(vectors.common, "BROADCAST_ROWS", 40)
    test_near_vectors_match_all_pairs(spark, 5)
    test_components_of_chains_and_stars(spark)


def test_tables_reach_their_recall():
    bits, tables = vectors.plan(5000)
    p = (1 - np.arccos(0.93) / np.pi) ** bits
    assert 2**bits >= 8 * 5000 and 1 - (1 - p) ** tables >= vectors.RECALL


def test_components_of_chains_and_stars(spark):
    from leafline.llm import graph

    random.seed(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)] + [(random.randint(200, 260), random.randint(200, 260)) for _ in range(40)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {a: find(a) for a in list(root)}
    assert graph.components(spark.createDataFrame([], "src long, dst long")).count() == 0
