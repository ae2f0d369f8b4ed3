import hashlib
import re

import numpy as np
import pytest

from leafline.llm import common, decontamination, fmindex

SF = "/root/testdata/sf0.001"
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """(id, n_words, spans, items) by looking every window up in a dictionary."""
    at = {}
    for item, text in items:
        w = words_of(text)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            at.setdefault(tuple(w[a : a + window]), set()).add(item)
    sizes = sorted({len(k) for k in at})
    out = []
    for doc, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if own := at.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= own
        edge = sorted(hit)
        cuts = [(a, next(b for b in range(a, len(w) + 1) if b not in hit)) for a in edge if a - 1 not in hit]
        out.append((doc, len(w), cuts, sorted(str(i) for i in found if i is not None)))
    return out


def sets(rows):
    return sorted(rows, key=str)


def check(spark, docs, items, **how):
    got = decontamination.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **how).collect()
    assert sets((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]) for r in got) == sets(brute(docs, items, how.get("window", 10)))


@pytest.mark.parametrize("letters", [1, 2, 40])
def test_index_equals_plain_search(letters):
    rng = np.random.default_rng(letters)
    texts = [rng.integers(1, letters + 1, n).astype(np.uint64) for n in (0, 5, 70, 200, 1, 0, 130)]
    texts += [texts[3], np.concatenate([texts[2], texts[4]])]
    fm = fmindex.FmIndex(**fmindex.build(texts))
    phrases = [texts[k][a : a + n] for k in (2, 3, 6) for a in (0, 3, 64) for n in (1, 2, 5)] + [np.array([1, 99], np.uint64), rng.integers(1, letters + 1, 5).astype(np.uint64)]
    table = np.zeros((len(phrases), 5), dtype=np.uint64)
    for k, p in enumerate(phrases):
        table[k, 5 - len(p) :] = p
    low, high = fm.search(table, np.array([len(p) for p in phrases]))
    starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    for p, a, b in zip(phrases, low, high, strict=True):
        want = [starts[k] + i for k, t in enumerate(texts) for i in range(len(t) - len(p) + 1) if (t[i : i + len(p)] == p).all()]
        assert sorted(fm.locate(np.arange(a, b))) == want


def test_suffixes_are_sorted():
    rng = np.random.default_rng(5)
    sym = np.concatenate([np.append(rng.integers(1, 3, n), 0) for n in (40, 0, 40, 7)] + [np.ones(50, int), [0], np.ones(50, int), [0]])
    gaps = np.cumsum(sym == 0)
    key = lambda i: [(0, gaps[k]) if not sym[k] else (1, sym[k]) for k in range(i, len(sym))]
    assert fmindex.suffixes(sym).tolist() == sorted(range(len(sym)), key=key)


PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away into the dark wood"


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "...!"), (4, PASSAGE), (4, PASSAGE), (None, f"x {PASSAGE.upper()} y"), (6, "Élan 9 vital"), (7, "élan, 9-VITAL"), (8, " ".join(PASSAGE.split()[:9])), (9, f"{PASSAGE} {PASSAGE} tail")]
    items = [(1, PASSAGE), (1, "élan 9"), (2, None), (3, "?"), (10, "dog"), (11, " ".join(PASSAGE.split()[2:13])), (None, "tail"), (11, PASSAGE)]
    check(spark, docs, items)
    check(spark, docs, items, block=3)
    check(spark, docs, [])
    check(spark, [], items)


def test_long_texts_are_indexed_in_parts(spark):
    rng = np.random.default_rng(1)
    words = [f"w{x}" for x in rng.integers(0, 6, 900)]
    docs = [(1, " ".join(words)), (2, "w1 w2"), (3, " ".join(words)), (4, " ".join(words[100:230]))]
    items = [(k, " ".join(words[a : a + n])) for k, (a, n) in enumerate([(45, 14), (96, 10), (0, 12), (888, 12), (899, 1), (300, 60), (197, 3)])]
    for shard in (50, 64, 10_000):
        check(spark, docs, items, shard=shard)
        check(spark, docs, items, shard=shard, window=4, block=7)


def test_spans():
    s, e = decontamination.spans(np.array([5, 1, 2, 9, 20]), np.array([7, 4, 9, 12, 21]))
    assert (s.tolist(), e.tolist()) == ([1, 20], [12, 21])


def test_decontaminated_cuts_spans(spark):
    docs = [(1, f"Before, {PASSAGE}! After.", 5), (2, "clean", 6), (3, None, 7), (4, PASSAGE, 8), (1, f"Before, {PASSAGE}! After.", 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, Spans int")
    got = decontamination.decontaminated(df, spark.createDataFrame([(1, PASSAGE)], ITEMS))
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.where("text is not null").collect()) == [(1, "Before, ! After.", 5), (1, "Before, ! After.", 9), (2, "clean", 6), (4, "", 8)]
    assert got.where("text is null").count() == 1


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in decontamination.op11_decontamination(spark, SF).collect()}
    docs, items = (common.read(spark, SF, t).select(i, "text").collect() for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = brute(docs, items)
    assert len(got) == len(docs) and sum(bool(w[3]) for w in want) > 2
    for doc, n, cuts, found in want:
        r, hit = got[doc], sum(b - a for a, b in cuts)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
