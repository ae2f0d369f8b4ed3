import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leafline.llm import jaccard, words


def grams(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(docs, t=0.8):
    n, sets = len(docs), [grams(x) for _, x in docs]
    same = lambda i, j: (docs[i][1] or "") == (docs[j][1] or "")
    near = lambda i, j: bool(sets[i]) and bool(sets[j]) and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= t
    links = [[j for j in range(n) if j != i and (same(i, j) or near(i, j))] for i in range(n)]
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(n):
        for j in links[i]:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    group = {}
    for i in range(n):
        group.setdefault(find(i), []).append(i)
    least = lambda g: min((docs[i][0] for i in g if docs[i][0] is not None), default=None)
    return sorted(((docs[i][0], least(g), len(links[i])) for g in group.values() for i in g), key=str)


def corpus(n=60, seed=4):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        base = r.choices(vocab, k=r.randint(30, 150))
        docs.append(" ".join(base))
        for _ in range(r.randint(0, 4)):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(vocab)
            docs.append(" ".join(copy))
    return list(enumerate(docs))


@pytest.mark.parametrize("cell", [256, 3])
def test_matches_all_pairs(spark, cell):
    docs = corpus() + [(5000, "Short one"), (5001, "short  ONE"), (5002, ""), (5003, None), (5004, "a b c d e"), (5005, "a b c d e f"), (None, "w1 w2 w3 w4 w5 w6"), (None, "w1 w2 w3 w4 w5 w6"), (7, "same id other text"), (6000, "z " * 30000)]
    df = spark.createDataFrame([(a, b, "s", 1) for a, b in docs], "doc_id long, text string, source string, size int")
    got = jaccard.near_duplicates(df, cell=cell)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in got.collect()), key=str) == brute(docs)


def test_colliding_hashes_keep_texts_apart(spark, monkeypatch):
    whole = jaccard.hashes
    monkeypatch.setattr(jaccard, "hashes", lambda t: (F.pmod(whole(t)[0], F.lit(5)), whole(t)[1]))
    docs = corpus(30) + [(5002, ""), (5003, None), (900, "a b c d e f"), (901, "a b c d e f")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df).collect()), key=str) == brute(docs)
    assert {r["doc_id"] for r in jaccard.deduplicated(df).collect()} == {c for _, c, _ in brute(docs)}


def test_shuffled_sides_and_hot_keys_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard.common, "few", lambda df, rows=0: False)
    monkeypatch.setattr(jaccard.common, "HOT", 3)
    monkeypatch.setattr(jaccard.common, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(jaccard.graph, "LISTED", 2)
    docs = corpus(40, seed=8) + [(2000 + i, "the same text in many rows " * 3) for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.near_duplicates(df, cell=4).collect()), key=str) == brute(docs)


def test_clashing_columns_pass_through(spark):
    names = ["__k", "h1", "h2", "id", "id_", "root", "row", "node", "k1", "n", "bands"]
    docs = [(1, "a b c d e f g", *[f"v{k}" for k in range(len(names))]), (2, "a b c d e f g", *["w"] * len(names)), (3, "x y", *[None] * len(names))]
    df = spark.createDataFrame(docs, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = jaccard.deduplicated(df)
    assert kept.columns == df.columns and sorted(tuple(r) for r in kept.collect()) == [docs[0], docs[2]]


def test_large_group_in_cells(spark):
    r = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(r.choices(range(200), k=120))] + [(500 + i, " ".join(base)) for i in range(80)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = jaccard.near_duplicates(df, cell=16)
    assert sorted(((x["doc_id"], x["class_id"], x["n_links"]) for x in got.collect()), key=str) == brute(docs)


def test_repeated_bodies_meet_in_a_large_group(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(r.choices(range(200), k=40))]
    docs += [(100 + i, " ".join([text] * (2 + i % 2))) for i, text in docs[:20]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = jaccard.near_duplicates(df, cell=8)
    assert sorted(((x["doc_id"], x["class_id"], x["n_links"]) for x in got.collect()), key=str) == brute(docs)


def test_one_of_each_group_stays(spark):
    docs = [(3, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (9, "other words stand here today"), (8, "")]
    df = spark.createDataFrame([(a, b, "k") for a, b in docs], "doc_id long, text string, k1 string")
    kept = jaccard.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 8, 9]


def test_one_stays_where_ids_repeat_or_are_null(spark):
    near = [" ".join(f"{g}{i}" for i in range(60)) + f" end{k}" for g in "ab" for k in range(3)]
    docs = [(None, x) for x in near[:3]] + [(None, near[0])] + [(4, near[3]), (4, near[4]), (4, near[4]), (6, near[5]), (None, near[5]), (4, "other text"), (None, "alone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = [tuple(r) for r in jaccard.deduplicated(df).collect()]
    assert len(kept) == 4 and sum(r in [(None, x) for x in near[:3]] for r in kept) == 1
    assert sum(r in [(4, near[3]), (4, near[4])] for r in kept) == 1 and {(4, "other text"), (None, "alone")} < {*kept}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(df).count() == 0 and jaccard.deduplicated(df).count() == 0


def test_bands_reach_their_recall():
    b = jaccard.bands_for(0.8, 7, 0.9999)
    assert 1 - (1 - 0.8**7) ** b >= 0.9999 > 1 - (1 - 0.8**7) ** (b - 1)


def test_words_split_and_hash_alike():
    texts = ["One  two\tONE", "", None, "x" * 3_000_000 + " one", "\n two ", "é É"]
    h, to = words.word_hashes(pa.array(texts))
    assert to.tolist() == [0, 3, 3, 3, 5, 6, 8]
    assert h[0] == h[2] == h[4] and h[1] == h[5] and h[6] != h[7]
    assert len({*h.tolist()}) == 5
    s, at = words.shingles(h, to)
    assert at.tolist() == [0, 1, 1, 1, 2, 3, 4] and len(s) == 4
