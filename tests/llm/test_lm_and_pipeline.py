import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafline.llm import lm
from leafline.llm.eliasfano import EliasFano, mapped, write


@pytest.mark.parametrize(("n", "top"), [(0, 1), (1, 5), (1, 2**63), (1000, 2000), (1000, 2**64 - 1), (30000, 10**9)])
def test_elias_fano(n, top, tmp_path):
    r = np.random.default_rng(1)
    v = np.sort(r.integers(0, top, n, dtype=np.uint64))
    path = str(tmp_path / "a")
    write(path, EliasFano.build(v).arrays("v"))
    e = EliasFano.of(mapped(path), "v")
    assert (e.access(np.arange(n)) == v).all()
    x = np.concatenate([v, r.integers(0, top, 500, dtype=np.uint64)])
    i = np.searchsorted(v, x)
    want = [int(k) if k < n and v[k] == y else -1 for k, y in zip(i, x, strict=True)]
    assert e.find(x).tolist() == want


def test_crowded_buckets():
    v = np.concatenate([np.arange(5000, dtype=np.uint64), np.array([2**50], dtype=np.uint64)])
    assert (EliasFano.build(v).find(v) == np.arange(5001)).all()


def words(text):
    return [*(text or "").encode().lower().split(), None]


def brute(docs, order=2):
    train = [words(t) for i, t in docs if i is not None and crc32(str(i).encode()) % 7 != 2]
    uni = Counter(w for t in train for w in t)
    pair = Counter(p for t in train for p in zip([None, *t[:-1]], t, strict=True))
    types = Counter(a for a, _ in pair)
    n, v = sum(uni.values()), len(uni)
    n1, n2 = (sum(c == k for c in uni.values()) for k in (1, 2))
    d1 = min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 else 0.5))
    p1 = lambda w: (uni[w] - d1) / n if w in uni else d1 * v / n

    def p(c, w):
        if c not in uni:
            return p1(w)
        return max(pair[c, w] - lm.DISCOUNT, 0) / uni[c] + lm.DISCOUNT * types[c] / uni[c] * p1(w)

    three = Counter(x for t in train for x in zip([None, *t[:-1]], t, t[1:], strict=False))
    after = Counter(x[:2] for x in three)

    def p3(a, b, w):
        if order < 3 or not pair[a, b]:
            return p(b, w)
        return max(three[a, b, w] - lm.DISCOUNT, 0) / pair[a, b] + lm.DISCOUNT * after[a, b] / pair[a, b] * p(b, w)

    out = {}
    for i, t in docs:
        w = words(t)
        out[i, t] = (len(w), sum(x in uni for x in w), n, sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w), math.log10(p(None, w[0])) + sum(math.log10(p3(a, b, c)) for a, b, c in zip([None, *w[:-1]], w, w[1:], strict=False)))
    return out, uni, p


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize(("segment", "part"), [(1 << 20, 1 << 22), (8, 64)])
def test_scores_match_a_plain_model(spark, monkeypatch, segment, part, order):
    monkeypatch.setattr(lm, "SEGMENT", segment)
    monkeypatch.setattr(lm, "PART", part)
    random.seed(3)
    vocab = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(random.choices(vocab, weights=range(60, 0, -1), k=random.randint(0, 30)))) for i in range(150)]
    docs += [(500, None), (501, ""), (None, "w1 unknown"), (502, "THE w1\tW1\nw2"), (503, "w1 " * 30000), (7, docs[7][1])]
    df = spark.createDataFrame([(a, b, 1.0) for a, b in docs], "doc_id long, text string, score double")
    got = lm.scores(df, order).collect()
    want, _, _ = brute(docs, order)
    assert len(got) == len(docs)
    for r in got:
        text = next(t for i, t in docs if i == r["doc_id"])
        n, known, total, base, score = want[r["doc_id"], text]
        assert r["held_out"] == (r["doc_id"] is None or crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base))
        assert abs(r["score"] - score) < 0.02 * n + 1e-6  # probabilities are quantised


def test_ids_of_any_width_give_the_same_pairs():
    r = np.random.default_rng(3)
    context, word = r.integers(0, 50, 4000), r.integers(0, 30, 4000)
    for shift, by in ((5, 0), (5, 2**58), (40, 2**33)):
        c, w, n = lm.pairs_counted(context + by, word, shift)
        want = Counter(zip((context + by).tolist(), word.tolist(), strict=True))
        assert dict(zip(zip(c.tolist(), w.tolist(), strict=True), n.tolist(), strict=True)) == want
        assert list(zip(c.tolist(), w.tolist(), strict=True)) == sorted(want)


def test_pairs_lie_between_their_cuts():
    r = np.random.default_rng(4)
    cuts = sorted({(int(c), int(w)) for c, w in zip(r.integers(0, 6, 40), r.integers(0, 9, 40), strict=True)})
    pairs = [(c, w) for c in range(-1, 8) for w in range(-1, 11)]
    c, w, a, b = (np.array(x) for x in ([x for x, _ in cuts], [y for _, y in cuts], [x for x, _ in pairs], [y for _, y in pairs]))
    assert lm.placed(c, w, a, b).tolist() == [sum(x <= p for x in cuts) for p in pairs]
    assert lm.placed(c[:0], w[:0], a, b).tolist() == [0] * len(pairs)


def test_probabilities_sum_to_one(spark):
    docs = [(i, t) for i, t in enumerate(["a b a", "b c", "a a c", "", "c b a b"])]
    _, uni, p = brute(docs)
    for c in [*uni, "never"]:
        assert abs(sum(p(c, w) for w in [*uni, "unknown"]) - 1) < 1e-9


def test_nothing_to_learn(spark):
    held = next(i for i in range(100) if crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    r = lm.scores(df).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert lm.scores(df.limit(0)).count() == 0


def test_tokens_end_each_text():
    t, to = lm.tokens(pa.array(["a b", None, "a"]))
    assert to.tolist() == [0, 3, 4, 6] and t[2] == t[3] == t[5] == lm.END and t[0] == t[4]


def test_quantised_keeps_few_values():
    book, code = lm.quantised(np.array([-1.5, -2.0, -1.5]))
    assert np.allclose(book[code], [-1.5, -2.0, -1.5])
    x = np.random.default_rng(1).normal(size=5000)
    book, code = lm.quantised(x)
    assert len(book) <= 256 and np.abs(book[code] - x).mean() < 0.02


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    random.seed(4)
    vocab = [f"word{i}" for i in range(300)]
    good = lambda: " ".join(random.choices(vocab, k=random.randint(30, 120)))
    docs = []
    for i in range(400):
        body = good() if i % 5 else " ".join(w + "$$$" for w in random.choices(vocab, k=60))
        docs.append((i, body + ("\ncommon footer line" if i % 2 else ""), "en", f"s{i % 15}", len(body)))
    docs += [(1000 + i, docs[6][1], "en", "s1", 1) for i in range(5)]
    labels = [(i, int(i % 5 > 0), 0) for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, str(tmp_path))
        if name != "packing":
            assert out.columns == at.columns and out.dtypes == at.dtypes
        seen[name] = out.collect()
        at = spark.createDataFrame(seen[name], out.schema)
    kept = {r["doc_id"] for r in seen["quality"]}
    assert sum(i % 5 == 0 for i in kept if i < 400) < 8 and sum(i % 5 > 0 for i in kept if i < 400) > 310
    assert not any("common footer line" in r["text"] for r in seen["line dedup"])
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line dedup"])
    after = {r["doc_id"] for r in seen["near duplicates"]}
    assert after == kept - {1000 + i for i in range(5)}
    mixed = {r["doc_id"] for r in seen["mixing"]}
    assert mixed < after and {r["doc_id"] for r in seen["packing"]} == mixed
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, seen["packing"]))
    assert run.select(F.sum("length")).first()[0] == sum(r["length"] for r in seen["packing"])


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(5)
    prose = lambda n: " ".join(r.choices([f"word{i}" for i in range(200)], k=n))
    names = ["__k", "__doc", "__gone", "n_removed", "__topic", "row", "h1", "key", "blocked"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    row = lambda i, t, lang="en", source="s", *x: (i, t, lang, source, None if t is None else len(t), *(x or ["v"] * len(names)))
    rows = [row(i, prose(40) + "\nfoot", "en", f"s{i % 7}") for i in range(60)]
    rows += [row(100, None), row(101, ""), row(None, prose(30)), row(102, "foot", None, None), row(103, prose(30000)), rows[3], rows[3], row(104, rows[4][1], *[None] * (2 + len(names)))]
    labels = [(i, int(i % 6 > 0), 0) for i in range(60)] + [(None, 1, 0), (3, None, 0)]
    for name, docs in (("all", rows), ("none", [])):
        at = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, schema).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        docs, left = spark.read.parquet(f"{at}/documents.parquet"), {}
        for stage, f in corpus_pipeline.STAGES:
            out = f(spark, docs, at)
            left[stage] = out.collect()
            if stage != "packing":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
                docs = spark.createDataFrame(left[stage], out.schema)
        assert bool(left["quality"]) == bool(name == "all")
        if name == "all":
            texts = [x["text"] for x in left["near duplicates"]]
            assert len(texts) == len(set(texts)) and not any("foot" in (t or "") for t in texts)
            assert {x["text"] for x in left["near duplicates"]} <= {x["text"] for x in left["line dedup"]}
            assert all(x["key"] == "v" for x in left["mixing"] if x["doc_id"] not in (4, 104))
        got = corpus_pipeline.run(spark, at)
        assert got.count() == len(left["packing"]) and sum(x["length"] for x in left["packing"]) == (got.agg(F.sum("length")).first()[0] or 0)
