import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafline.llm import common, periods

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w):
    """All runs by trying every period at every place."""
    ids = np.array([{x: k for k, x in enumerate(dict.fromkeys(w))}[x] for x in w] if len(w) < 50 else np.unique(np.array(w, dtype=object), return_inverse=True)[1])
    out, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s + q >= max(6, 4 * q):
                out.setdefault((s, e + q), q)  # the smallest period comes first
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_small_alphabets(w):
    assert periods.runs_of(w) == brute(w)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=5), min_size=1, max_size=4), st.lists(st.integers(4, 9), max_size=6))
def test_runs_of_nested_repeats(parts, rest):
    w = [x for p in parts for x in p * 5] * 4 + rest + parts[0] * 30
    assert periods.runs_of(w) == brute(w)
    assert periods.found(w, [w, [-x for x in w]], periods.by_words(w), 6, 4) == set(brute(w))


def test_extensions_by_hash_equal_those_by_words():
    rng = np.random.default_rng(3)
    w = [*rng.integers(0, 2, 60).tolist() * 6, 7, *[1] * 90]
    (a, b), (c, d) = periods.by_hash(w), periods.by_words(w)
    for i in range(0, len(w), 7):
        for j in range(i + 1, len(w), 5):
            assert (a(i, j), b(i, j)) == (c(i, j), d(i, j))


def test_a_wrong_hash_is_noticed(monkeypatch):
    monkeypatch.setattr(periods, "BASE", 0)  # only the last word counts
    w = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15] * 6 + [3, 2, 1]
    assert periods.runs_of(w) == brute(w)


def check(spark, docs):
    got = periods.periodic_runs(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(got) == len(docs)
    want = sorted(((i if i is not None else -1), len(w := words_of(t)), brute(w), collapsed(w, brute(w))) for i, t in docs)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got) == want


def test_odd_rows(spark):
    rep = "a b " * 8
    docs = [(1, None), (2, ""), (3, " \n "), (4, "a a a a a"), (5, "a a a a a a"), (5, "a a a a a a"), (None, rep), (7, f"x {rep}{rep}y"), (8, "A a A a A a A a"), (9, "é  " * 9), (10, "one " + "two three " * 5000), (11, " lead\tand  tail \r\n")]
    check(spark, docs)


def test_stretches_don_t_cross_texts(spark):
    check(spark, [(i, t) for i, t in enumerate(["p q r s t", "p q r s t", "p q r s t u " * 4, "u p q r s", "z " * 7, "z z", "z z z z"])])


def test_clashing_and_empty(spark):
    df = spark.createDataFrame([(1, "a " * 9, "x", 4)], "doc_id long, text string, runs string, N_Words int")
    assert periods.periodic_runs(df).first()["collapsed"] == "a"
    assert periods.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(df, shortest=4)


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r.asDict() for r in periods.op13_periodic_runs(spark, SF).collect()}
    docs = common.read(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    several = 0
    for d in docs:
        w, h = words_of(d["text"]), zlib.crc32(str(d["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs, r = brute(w), got[d["doc_id"]]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        several += bool(runs)
        assert r["n_runs"] == len(runs) and r["n_words"] == n
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert several > 5
