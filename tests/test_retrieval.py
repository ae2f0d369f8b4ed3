import re

import numpy as np
import pyarrow as pa

from leafline.operators import index, retrieval


def brute(asked, docs, k):
    out = {}
    for q in sorted({a for a, _, _ in asked}):
        w = {t: x for a, t, x in asked if a == q}
        hits = [(-round(sum(w[t] * x for t, x in terms.items() if t in w), 6), i) for i, terms in docs.items() if w.keys() & terms.keys()]
        out[q] = [(i, -s) for s, i in sorted(hits)[:k]]
    return out


def test_whole_scores_of_documents_stay_in_their_task(monkeypatch):
    """Common terms as columns of a matrix, others posting by posting, a few documents and products at a time."""
    r = np.random.default_rng(1)
    docs = {int(i): {f"t{t}": float(r.integers(1, 4)) for t in set(r.zipf(1.3, 12) % 90)} for i in r.permutation(300)}
    docs[7] = {}
    asked = [(q, f"t{t}", float(r.integers(1, 3))) for q in range(40) for t in sorted(set(r.zipf(1.3, 9) % 120))]
    table = pa.table({"query_id": [a for a, _, _ in asked], "term": [t for _, t, _ in asked], "w": [w for _, _, w in asked]})
    batch = pa.RecordBatch.from_arrays([pa.array(list(docs)), pa.array([list(x) for x in docs.values()], pa.list_(pa.string())), pa.array([list(x.values()) for x in docs.values()], pa.list_(pa.float64()))], ["id", "term", "weight"])
    for rows, products, common in ((256, 1_000_000, 0.05), (7, 60, 0.3), (1, 1, 1.0), (50, 500, -1.0)):
        for name, value in (("ROWS", rows), ("PRODUCTS", products), ("COMMON", common)):
            monkeypatch.setattr(retrieval, name, value)
        known, top = retrieval.asked_terms(table), retrieval.Best(40, 5)
        for part in (batch.slice(0, 130), batch.slice(130)):
            for score, own in retrieval.scored(part, known):
                top.add(score, own)
        got = {}
        for x in top.rows(known[0]).to_pylist():
            got.setdefault(x["query_id"], []).append((x["id"], x["score"]))
        assert got == {q: x for q, x in brute(asked, docs, 5).items() if x}


def test_best_takes_no_number_first_and_smaller_ids_on_ties():
    top = retrieval.Best(1, 3)
    for scores, ids in (([[1.0, 2.0, 2.0, 2.0]], [9, 8, 5, 7]), ([[2.0, -np.inf, np.nan]], [6, 1, 4])):
        top.add(np.array(scores), np.array(ids))
    assert [x["id"] for x in top.rows(np.array([3])).to_pylist()] == [4, 5, 6]


def test_words_are_counted_as_a_pattern_finds_them():
    """Words end with their text, in slices too; a document's texts count together, and a word's length is its first text's."""
    texts = ["ab cd", "ef ab ab", "", "ä é1x", "  ", "9a-9a--k", "x", "x y", "tail"]
    word = re.compile("[a-z0-9]+")
    for a, b in ((0, 9), (1, 7), (2, 5), (4, 5), (2, 3), (3, 3)):
        got, text = retrieval.words(pa.array(texts, pa.string()).slice(a, b - a))
        want = [(w, n) for n, t in enumerate(texts[a:b]) for w in word.findall(t)]
        assert list(zip(got.to_pylist(), text.tolist(), strict=True)) == want
    for doc in ([0, 1, 2, 3, 4, 5, 6, 7, 8], [0, 0, 0, 2, 2, 2, 5, 5, 6]):
        of, code, terms, n, length = retrieval.counted(pa.array(texts, pa.string()), np.array(doc))
        want = {}
        for d, t in zip(doc, texts, strict=True):
            for w in word.findall(t):
                was = want.get((d, w), (0, len(word.findall(t))))
                want[d, w] = (was[0] + 1, was[1])
        assert {(d, terms[c].as_py()): (k, x) for d, c, k, x in zip(of.tolist(), code.tolist(), n.tolist(), length.tolist(), strict=True)} == want and sorted(of) == of.tolist()


def test_postings_and_frequencies_are_those_of_counted_terms(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "TERMS", 5)
    texts = spark.createDataFrame([(1, "The cat, the CAT\nsat"), (2, "a cat"), (3, None), (4, "..."), (5, "KK cat1 ÄB"), (6, "x" * 9), (6, "x y cat"), (None, "lost cat")], "doc_id long, text string").repartition(2)
    counted = index.terms(texts)
    want = {(r["doc_id"], r["term"]): round(r["weight"], 9) for r in index.term_weights(counted).collect() if r["doc_id"] not in (6, None)}
    found = retrieval.postings(texts)
    got = {}
    for part in found.toArrow().to_batches():
        for ids, known, begin, terms, code, weight in retrieval.unpacked(part, "id", "known", "begin", "term", "code", "weight"):
            each = zip(np.repeat(np.where(known, ids, -1), np.diff(begin)).tolist(), terms.take(pa.array(code)).to_pylist(), weight.tolist(), strict=True)
            got |= {(-1 if d < 0 else d, t): round(w, 9) for d, t, w in each}
    assert {k: v for k, v in got.items() if k[0] not in (6, -1)} == want and {t for d, t in got if d == 6} == {"x" * 9, "x", "y", "cat"}
    assert {t for d, t in got if d == -1} == {"cat", "lost"} and len({d for d, _ in got}) == 5
    idf = {r["term"]: round(r["idf"], 9) for r in index.document_frequency(counted).collect()}
    assert {r["term"]: round(r["idf"], 9) for r in retrieval.inverse_frequencies(found).collect()} == idf


def test_scores_wait_until_there_are_many_and_sorting_them_in_is_seldom(monkeypatch):
    r, sorts = np.random.default_rng(2), []
    score, ids = np.round(r.normal(size=(7, 4000)) * 50, 1), r.permutation(4000)
    sort_in = retrieval.Best.sort_in
    monkeypatch.setattr(retrieval.Best, "sort_in", lambda self: (sorts.append(1), sort_in(self)))
    for least in (0.0, -np.inf):
        sorts.clear()
        top = retrieval.Best(7, 5, least)
        for a in range(0, 4000, 20):
            top.add(score[:, a : a + 20], ids[a : a + 20])
        got = [(x["query_id"], x["id"], x["score"]) for x in top.rows(np.arange(7)).to_pylist()]
        assert got == [(q, int(ids[i]), score[q, i]) for q in range(7) for i in sorted(range(4000), key=lambda i, q=q: (-score[q, i], ids[i]))[:5]]
        assert len(sorts) < 20  # of 200 parts


def test_bounds_and_single_precision_leave_no_pair_out(monkeypatch):
    """Scores that only differ beyond single precision, ties, packets in any order, and bounds that are the k-th best of some."""
    r, pairs = np.random.default_rng(3), []
    docs = {int(i): {f"t{t}": float(r.integers(1, 3)) / 3 + float(r.integers(0, 3)) * 1e-6 for t in set(r.zipf(1.2, 15) % 60)} for i in r.permutation(600)}
    asked = [(q, f"t{t}", float(r.integers(1, 3)) * 100) for q in range(30) for t in sorted(set(r.zipf(1.2, 12) % 70))]
    known = retrieval.asked_terms(pa.table({"query_id": [a for a, _, _ in asked], "term": [t for _, t, _ in asked], "w": [w for _, _, w in asked]}))

    def packets(ids):
        for n in range(0, len(ids), 50):
            own = ids[n : n + 50]
            terms = sorted({t for i in own for t in docs[i]})
            batch = retrieval.packed(pa.array([*own, None], pa.int64()), np.cumsum([0, *(len(docs[i]) for i in own), 1]), pa.array(terms), np.array([terms.index(t) for i in own for t in docs[i]] + [0]), np.array([w for i in own for w in docs[i].values()] + [1e9]))
            yield from retrieval.unpacked(batch, "id", "known", "begin", "term", "hash", "code", "weight")

    def got(ids, floor=None):
        out = {}
        for x in retrieval.best_of(packets(ids), known, 5, floor).rows(known.ids).to_pylist():
            out.setdefault(x["query_id"], []).append((x["id"], x["score"]))
        return out

    exact_at = retrieval.Part.exact_at
    monkeypatch.setattr(retrieval.Part, "exact_at", lambda self, at: (pairs.append(len(at)), exact_at(self, at))[1])
    want, some = {q: x for q, x in brute(asked, docs, 5).items() if x}, got(list(docs)[:150])
    floor = np.array([some[q][4][1] if len(some.get(q, [])) == 5 else -np.inf for q in known.ids.tolist()])
    for few, common in ((0.01, 0.05), (1.0, 0.05), (1.0, 1.0), (0.2, -1.0)):
        monkeypatch.setattr(retrieval, "FEW", few)
        monkeypatch.setattr(retrieval, "COMMON", common)
        known = retrieval.asked_terms(pa.table({"query_id": [a for a, _, _ in asked], "term": [t for _, t, _ in asked], "w": [w for _, _, w in asked]}))
        assert got(list(docs)) == want
        pairs.clear()
        assert got(list(docs), floor) == want
        assert few < 1 or 0 < sum(pairs) < 0.1 * 30 * 600


def test_terms_that_share_a_hash_are_told_apart(monkeypatch):
    words = [f"w{n % 37}{'x' * (n % 5)}" for n in range(200)]
    terms = pa.array(sorted(set(words)))
    assert len(set(retrieval.hashes(terms).tolist())) == len(terms) and retrieval.hashes(terms.slice(3, 4)).tolist() == retrieval.hashes(terms)[3:7].tolist()
    asked = pa.table({"query_id": [1] * 40, "term": terms[:40], "w": [1.0] * 40})
    for factor in (retrieval.FACTOR, np.uint64(0)):  # with no factor all terms share a hash
        monkeypatch.setattr(retrieval, "FACTOR", factor)
        for some in (asked, asked.slice(0, 1), asked.slice(0, 0)):
            known = retrieval.asked_terms(some)
            place = known.places(terms, retrieval.hashes(terms))
            assert [known.terms[i].as_py() if i >= 0 else None for i in place.tolist()] == [t if t in some["term"].to_pylist() else None for t in terms.to_pylist()]
