import re
from collections import Counter

import pytest

from leafline.llm import collocations, common

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, lang string, text string"


def brute(docs, least, longest):
    """All phrases with their scores by counting every n-gram."""
    f, n = Counter(), Counter()
    for _, lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\v\f\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    often = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    held = {(lang, p[i : i + k]): max(a for (x, q), a in often.items() if x == lang and len(q) > k and any(q[j : j + k] == p[i : i + k] for j in range(len(q)))) for (lang, p), _ in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)}
    out = []
    for (lang, p), a in often.items():
        if held.get((lang, p), 0) < a:
            score, cut, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, left, right, n[lang], score, cut))
    return sorted(out)


def mined(spark, docs, schema=SCHEMA, **how):
    return sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(docs, schema), **how).collect())


TEXT = "New York is far. new york IS far, a b a b a b\nNew  York\tis near; x new york"
ODD = [(1, "en", TEXT), (1, "en", TEXT), (2, None, "a b a b"), (3, "und", "a b"), (None, "en", None), (4, "en", ""), (5, "en", " ... \n"), (6, "de", "Élan ÉLAN élan 7 7 7 7 élan élan"), (7, "", "p q p q")]


@pytest.mark.parametrize("broadcast", [1000, 0])
def test_odd_rows(spark, broadcast):
    for least, longest in ((2, 5), (3, 3), (1, 5)):
        assert mined(spark, ODD, least=least, longest=longest, broadcast=broadcast) == brute(ODD, least, longest)
    assert mined(spark, ODD[4:6], least=1, broadcast=broadcast) == []
    assert mined(spark, [], least=1, broadcast=broadcast) == []


def test_clashing_columns(spark):
    rows = [(1, "en", "a b a b", 9, "z")]
    assert mined(spark, rows, SCHEMA + ", n int, Phrase string", least=2) == brute([r[:3] for r in rows], 2, 5)


def test_very_long_text(spark):
    docs = [(1, "en", "one two three four five six " * 40_000)]
    assert mined(spark, docs, least=100) == brute(docs, 100, 5)


def test_scores_past_64_bits(spark):
    df = spark.sql(f"select {10**16}L as a, {3 * 10**18}L as n, array({10**16}L) as heads, array({10**16 + 1}L) as tails").withColumn("s", collocations.scored(2)[0]["score"])
    assert df.first()["s"] == 1000 * 10**16 * 3 * 10**18 // (10**16 * (10**16 + 1))


@pytest.mark.parametrize("broadcast", [collocations.BROADCAST_GRAMS, 0])
def test_documents_against_brute_force(spark, broadcast):
    docs = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "lang", "text").collect()]
    assert mined(spark, docs, least=20, broadcast=broadcast) == brute(docs, 20, 5)


def test_query_ranks_by_language(spark):
    got = collocations.op12_collocations(spark, SF).collect()
    docs = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "lang", "text").collect()]
    want = {}
    for lang, p, a, left, right, n, score, _ in sorted(brute(docs, 100, 5), key=lambda r: (-r[6], -r[2], r[1].encode())):
        want.setdefault(lang, []).append((p, a, left, right, n, score))
    assert sorted(tuple(r) for r in got) == sorted((lang, k, *r) for lang, rows in want.items() for k, r in enumerate(rows[:2000], 1))
