"""Hybrid retrieval over index rows: a lexical leg over postings, a dense leg over vectors, and the fusion of their ranks.

Queries are a stated set, taken in blocks of at most QUERIES: a block goes to every task, documents and vectors stay where they
are. A document's postings are counted where its text is and stay in one row, a packet of some hundred documents, so that a task
knows whole scores; it keeps the best k of its documents for each query and gives only these, so that the final ranking sees k rows a
query and task. Every query meets every row: time grows with their product, memory and what moves don't. What a part of the
documents gives as k-th best bounds the k-th best of all from below, and sums in single precision, whose error is bounded, tell which
pairs can reach it; these few are summed in double precision. Scores are compared after rounding to DIGITS places, so that the order of
additions does not decide; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.operators import index, scratch

QUERIES = 4096
DIGITS = 6
# Public constant of reciprocal-rank fusion.
RRF = 60
#: Rows scored at a time, pairs of them and queries, products of single postings at a time, the share of a block's queries from which
#: a term is multiplied as a column of a matrix, how many times the best scores may wait before they are sorted in, and terms of
#: documents counted at a time. FIRST: one packet in so many gives the first bounds. FEW: the share of pairs up to which they are summed
#: again one by one.
ROWS, PAIRS, PRODUCTS, COMMON, WAITING, TERMS, FIRST, FEW = 256, 1 << 19, 1_000_000, 0.05, 3, 1 << 20, 32, 0.01


def best(scores: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) of the k highest scores of each query."""
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def in_blocks(queries: DataFrame, leg, size: int = QUERIES) -> DataFrame:
    """The union of leg(block) over blocks of queries, by ranges of their hashes; each block's result is stored."""
    queries = scratch.stored(queries, "queries")
    blocks = max(1, -(-queries.count() // size))
    out = [scratch.stored(leg(queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)), "leg") for b in range(blocks)]
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


class Best:
    """The k best of the scores seen so far above `least`, by query, rounded; not a number counts as the highest, as in a descending
    sort. Scores that may be among them wait until there are enough to be sorted in together. known: by query, a k-th best score of some
    of the rows, or -inf."""

    def __init__(self, queries: int, k: int, least: float = 0.0, known: np.ndarray | None = None):
        self.k, self.score, self.id = k, np.full((queries, k), -np.inf), np.zeros((queries, k), np.int64)
        self.floor = np.full(queries, np.nextafter(least, np.inf))
        if known is not None:
            self.floor = np.maximum(self.floor, known - 10.0**-DIGITS)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        """score: queries by ids, `least` or less where a pair is none."""
        by_id = score.T
        doc, q = np.divmod(np.flatnonzero(~(by_id < self.floor)), max(1, len(self.floor)))
        self.take(q, by_id[doc, q], ids[doc])

    def take(self, q: np.ndarray, s: np.ndarray, ids: np.ndarray) -> None:
        """Scores of pairs of a query and an id each."""
        self.waiting.append((q, np.round(np.where(np.isnan(s), np.inf, s), DIGITS), ids))
        if sum(len(w[0]) for w in self.waiting) > WAITING * self.score.size:
            self.sort_in()

    def sort_in(self) -> None:
        own = np.repeat(np.arange(len(self.score)), self.k), self.score.ravel(), self.id.ravel()
        q, s, i = (np.concatenate(x) for x in zip(own, *self.waiting, strict=True))
        order = np.lexsort((i, -s, q))
        q = q[order]
        order = order[np.arange(len(q)) - np.searchsorted(q, q) < self.k]
        self.score, self.id, self.waiting = s[order].reshape(-1, self.k), i[order].reshape(-1, self.k), []
        self.floor = np.maximum(self.floor, self.score[:, -1] - 10.0**-DIGITS)

    def rows(self, queries: np.ndarray) -> pa.RecordBatch:
        self.sort_in()
        q, n = np.nonzero(self.score > -np.inf)
        score = self.score[q, n]
        score[np.isposinf(score)] = np.nan
        return pa.RecordBatch.from_arrays([pa.array(queries[q]), pa.array(self.id[q, n]), pa.array(score)], ["query_id", "id", "score"])


def at_a_time(queries: int) -> int:
    """So many rows are scored at a time."""
    return max(1, min(ROWS, PAIRS // max(1, queries)))


SCORES = "query_id long, id long, score double"


class Asked(NamedTuple):
    """A block of queries: their ids; their terms, the terms' hashes in order and the terms' places in this order; the column of each
    common term or -1, and the matrix of queries by common terms; and for the others, by term, where its queries begin, and their
    places and weights."""

    ids: np.ndarray
    terms: pa.Array
    hash: np.ndarray
    order: np.ndarray
    column: np.ndarray
    matrix: np.ndarray
    begins: np.ndarray
    query: np.ndarray
    weight: np.ndarray

    def places(self, terms: pa.Array, hashed: np.ndarray | None = None) -> np.ndarray:
        """The places of terms, or -1: by their hashes, where no two asked terms share one, and then by the terms that these name."""
        if hashed is None or not len(self.hash) or (self.hash[1:] == self.hash[:-1]).any():
            return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy()
        at = np.minimum(np.searchsorted(self.hash, hashed), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == hashed)
        place = self.order[at[hit]]
        same = pc.equal(terms.take(pa.array(hit)), self.terms.take(pa.array(place))).to_numpy(zero_copy_only=False)
        found = np.full(len(terms), -1, np.int32)
        found[hit[same]] = place[same]
        return found


def asked_terms(asked: pa.Table) -> Asked:
    """Asked of asked(query_id, term, w)."""
    ids, q = np.unique(asked.column("query_id").to_numpy(), return_inverse=True)
    coded = asked.column("term").combine_chunks().dictionary_encode()
    term, w = coded.indices.to_numpy().astype(np.int64), asked.column("w").to_numpy()
    n = np.bincount(term, minlength=len(coded.dictionary))
    common = n > COMMON * len(ids)
    column = np.where(common, np.cumsum(common) - 1, -1).astype(np.int32)
    matrix = np.zeros((len(ids), int(common.sum())))
    hot = common[term]
    matrix[q[hot], column[term[hot]]] = w[hot]
    cold = np.flatnonzero(~hot)
    cold = cold[np.argsort(term[cold], kind="stable")]
    begins = np.concatenate([[0], np.cumsum(np.where(common, 0, n))])
    hashed = hashes(coded.dictionary)
    order = np.argsort(hashed, kind="stable")
    return Asked(ids, coded.dictionary, hashed[order], order, column, matrix, begins, q[cold].astype(np.int32), w[cold])


@dataclass
class Part:
    """Some documents that are scored at once: their ids, and of the postings whose term is asked the document's place and the term's,
    and the weight."""

    own: np.ndarray
    doc: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    asked: Asked

    def __post_init__(self) -> None:
        hot = self.asked.column[self.term] >= 0
        self.common = np.zeros((len(self.own), self.asked.matrix.shape[1]))
        self.common[self.doc[hot], self.asked.column[self.term[hot]]] = self.weight[hot]
        term, doc, self.cold = self.term[~hot], self.doc[~hot], self.weight[~hot]
        begins = self.asked.begins
        # a posting's products stand together: where its term's queries begin, and on
        self.n = (begins[1:] - begins[:-1])[term] if len(term) else np.zeros(0, np.int64)
        self.each = np.repeat((begins[term] - np.cumsum(self.n) + self.n).astype(np.int32), self.n)
        self.each += np.arange(len(self.each), dtype=np.int32)
        self.place = np.take(self.asked.query, self.each, out=np.empty(len(self.each), np.int32), mode="clip")
        self.place += np.repeat((doc * len(self.asked.ids)).astype(np.int32), self.n)

    def exact(self) -> np.ndarray:
        """The scores, documents by queries; 0 where a pair shares no term, as all products are positive."""
        score = self.common @ self.asked.matrix.T
        score += np.bincount(self.place, self.asked.weight[self.each] * np.repeat(self.cold, self.n), score.size).reshape(score.shape)
        return score

    def exact_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, score, id) of the pairs at these places, ascending, of the scores in a row."""
        doc, q = np.divmod(at, max(1, len(self.asked.ids)))
        score = np.einsum("ij,ij->i", self.common[doc], self.asked.matrix[q])
        wanted = np.zeros(len(self.own) * len(self.asked.ids), bool)
        wanted[at] = True
        of = np.flatnonzero(wanted.take(self.place))
        posting = np.searchsorted(np.cumsum(self.n), of, "right")
        score += np.bincount(np.searchsorted(at, self.place[of]), self.asked.weight[self.each[of]] * self.cold[posting], len(at))
        return q, score, self.own[doc]

    def rough(self, matrix: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The scores in single precision, of the queries' matrix, turned, and weights in single precision."""
        # arrays of our own make: numpy adds in place slowly where a type has come through a pickle
        score = np.matmul(self.common.astype(np.float32), matrix, out=np.empty((len(self.own), len(self.asked.ids)), np.float32))
        product = np.take(weight, self.each, out=np.empty(len(self.each), np.float32), mode="clip")
        product *= np.repeat(self.cold.astype(np.float32), self.n)
        np.add.at(score.reshape(-1), self.place, product)
        return score


def parts(own: np.ndarray, to: np.ndarray, found: np.ndarray, weight: np.ndarray, asked: Asked) -> Iterator[Part]:
    """Documents `own`, some at a time, whose postings begin at `to`: the places of their terms among the asked ones, and weights."""
    size = asked.begins[1:] - asked.begins[:-1]
    products = np.where(found >= 0, size[found], 0) if len(size) else np.zeros(len(found), np.int64)
    upto = np.concatenate([[0], np.cumsum(products)])[to]
    a, rows = 0, at_a_time(len(asked.ids))
    while a < len(own):
        b = int(np.clip(np.searchsorted(upto, upto[a] + PRODUCTS, "right") - 1, a + 1, min(a + rows, len(own))))
        at = np.arange(to[a], to[b])
        doc = np.repeat(np.arange(b - a), np.diff(to[a : b + 1]))
        doc, at = doc[found[at] >= 0], at[found[at] >= 0]
        yield Part(own[a:b], doc, found[at], weight[at], asked)
        a = b


def scored(batch: pa.RecordBatch, asked: Asked) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(scores, ids) of a batch(id, term, weight) of documents, queries by documents, some documents at a time."""
    found = asked.places(batch.column(1).values)
    for part in parts(batch.column(0).to_numpy(), batch.column(1).offsets.to_numpy(), found, batch.column(2).values.to_numpy(), asked):
        yield part.exact().T, part.own


def best_of(packets: Iterator[list], asked: Asked, k: int, known: np.ndarray | None = None) -> Best:
    """The k best documents of packets (id, known, begin, term, hash, code, weight). A pair is summed in double precision if its sum in single
    precision, of at most so many positive products, can be that of a score at the bound."""
    top = Best(len(asked.ids), k, known=known)
    matrix, weight = np.ascontiguousarray(asked.matrix.T, np.float32), asked.weight.astype(np.float32)
    for ids, named, begin, terms, hashed, code, own in packets:
        many = np.diff(begin)
        if not named.all():
            kept = np.repeat(named, many)
            ids, many, code, own = ids[named], many[named], code[kept], own[kept]
            begin = np.append(0, np.cumsum(many))
        for part in parts(ids, begin, asked.places(terms, hashed)[code], own, asked):
            score = part.rough(matrix, weight)
            products = np.bincount(part.doc, minlength=1).max()  # of a document and any query
            low = (top.floor * max(0, 1 - (products + 16) * 2.0**-23)).astype(np.float32)
            at = np.flatnonzero(score >= np.maximum(np.nextafter(low, np.float32(-1)), np.finfo(np.float32).tiny))
            if len(at) > FEW * score.size:
                top.add(part.exact().T, part.own)
            else:
                top.take(*part.exact_at(at))
    return top


def signs_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where texts begin, and the bytes of all."""
    to = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
    signs = np.frombuffer(texts.buffers()[2], np.uint8)[to[0] : to[-1]] if to[-1] > to[0] else np.zeros(0, np.uint8)
    return to - to[0], signs


#: Of a sign and of a place in a word, what it adds to a hash.
SIGN = np.random.default_rng(17).integers(1, 2**63, 256).astype(np.uint64)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def hashes(terms: pa.StringArray) -> np.ndarray:
    """64 bits of each term, none of which is empty; two terms may share them."""
    to, signs = signs_of(terms)
    if not len(terms):
        return np.zeros(0, np.uint64)
    place = np.arange(len(signs)) - np.repeat(to[:-1], np.diff(to))
    factor = np.cumprod(np.full(int(place.max()) + 1, FACTOR))
    return np.add.reduceat(SIGN[signs] * factor[place], to[:-1])


WORD = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))


def words(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The runs of lower-case ASCII letters and digits of all texts in order, and the text of each."""
    to, signs = signs_of(texts)
    inside = WORD[signs]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = to[:-1][to[:-1] < len(signs)]
    begins[first] = inside[first]  # words end with their text
    at = np.flatnonzero(begins)
    upto = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(upto), pa.py_buffer(signs[inside])), np.searchsorted(to, at, "right") - 1


def counted(texts: pa.StringArray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.StringArray, np.ndarray, np.ndarray]:
    """The documents' terms: (doc, code of the term, terms by code, how often, words of the first text that has it), by doc. doc: the
    document of each text, ascending."""
    word, text = words(texts)
    coded = word.dictionary_encode()
    length, many = np.bincount(text, minlength=len(texts)), max(1, len(coded.dictionary))
    key, n = np.unique(text * many + coded.indices.to_numpy(), return_counts=True)
    text, code = np.divmod(key, many)
    length = length[text]
    if len(np.unique(doc)) < len(doc):
        key, first, again = np.unique(doc[text] * many + code, return_index=True, return_inverse=True)
        n, length, (of, code) = np.bincount(again, n, len(key)).astype(np.int64), length[first], np.divmod(key, many)
        return of, code, coded.dictionary, n, length
    return doc[text], code, coded.dictionary, n, length


#: A packet: ids of documents, which of them are known, where their postings begin; the packet's terms one after another, where they
#: begin and their hashes; and of each posting the term's place there and the weight. Cells are bytes, so that the JVM needn't touch each.
POSTINGS = "documents long, id binary, known binary, begin binary, term binary, at binary, hash binary, code binary, weight binary"
KIND = {"id": np.dtype("<i8"), "known": np.dtype("?"), "begin": np.dtype("<i8"), "at": np.dtype("<i4"), "hash": np.dtype("<u8"), "code": np.dtype("<i4"), "weight": np.dtype("<f8")}


def packed(ids: pa.Array, begin: np.ndarray, terms: pa.StringArray, code: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
    """A row of POSTINGS; an id may be null."""
    at, signs = signs_of(terms)
    values = {"id": pc.fill_null(ids, 0).to_numpy(), "known": ids.is_valid().to_numpy(zero_copy_only=False), "begin": begin, "at": at, "hash": hashes(terms), "code": code, "weight": weight}
    cells = {k: pa.array([v.astype(KIND[k]).tobytes()], pa.binary()) for k, v in values.items()}
    cells |= {"documents": pa.array([len(ids) - ids.null_count], pa.int64()), "term": pa.array([signs.tobytes()], pa.binary())}
    names = [f.split(" ")[0] for f in POSTINGS.split(", ")]
    return pa.RecordBatch.from_arrays([cells[n] for n in names], names)


def unpacked(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    """The named cells of each packet of a batch that has these columns, as arrays; "term" needs "at" in the batch."""
    column = {n: batch.column(batch.schema.get_field_index(n)) for n in {*names, "at"}}
    for i in range(batch.num_rows):
        cell = lambda n: np.array(np.frombuffer(column[n][i].as_buffer(), KIND[n]))  # noqa: E731, B023
        yield [pa.StringArray.from_buffers(len(column["at"][i].as_buffer()) // 4 - 1, pa.py_buffer(cell("at")), column["term"][i].as_buffer()) if n == "term" else cell(n) for n in names]


def postings(texts: DataFrame, id_: str = "doc_id") -> DataFrame:
    """POSTINGS: the words of index.terms of each document that has any, with their weights; texts are counted where they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(1)
            doc, code, terms, n, length = counted(own.flatten(), np.repeat(np.arange(len(own)), np.diff(own.offsets.to_numpy())))
            some, begin = np.unique(doc, return_index=True)
            if len(some):
                yield packed(b.column(0).take(pa.array(some)), np.append(begin, len(doc)), terms, code, index.saturated(n, length))

    whole = texts.groupBy(F.col(id_).cast("long").alias("id")).agg(F.collect_list(F.lower("text")).alias("texts"))
    scratch.small_batches(texts.sparkSession)
    return scratch.stored(whole.mapInArrow(work, POSTINGS), "postings")


def inverse_frequencies(found: DataFrame) -> DataFrame:
    """(term, idf) over all documents of POSTINGS; tasks give the sums of packets, about TERMS terms at a time."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for packet in chain((x for b in batches for x in unpacked(b, "term", "code")), [None]):
            if held and (packet is None or sum(t.num_rows for t in held) > TERMS):
                yield from pa.concat_tables(held).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"]).combine_chunks().to_batches()
                held = []
            if packet is not None:
                held.append(pa.table({"term": packet[0], "n": np.bincount(packet[1], minlength=len(packet[0]))}))

    total = found.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("total"))
    df = found.select("term", "at", "code").mapInArrow(counts, "term string, n long").groupBy("term").agg(F.sum("n").alias("df"))
    each = df.crossJoin(F.broadcast(total))  # the one row of the total
    return scratch.stored(each.select("term", index.inverse_frequency(F.col("df"), F.col("total")).alias("idf")), "idf")


def lexical(texts: DataFrame, queries: DataFrame, k: int, id_: str = "doc_id") -> DataFrame:
    """(query_id, id, score, rank): the k best documents by term weights times inverse document frequency, a query's term counting
    as often as it stands there. texts(id, text); queries(query_id, text)."""
    found = postings(texts, id_)
    idf = inverse_frequencies(found)

    first = scratch.stored(found.where(F.pmod(F.xxhash64("id"), F.lit(FIRST)) == 0), "first")

    def leg(block: DataFrame) -> DataFrame:
        asked = index.terms(block, "query_id").join(idf, "term").select("query_id", "term", (F.col("n") * F.col("idf")).alias("w"))
        asked = asked_terms(asked.toArrow())  # the terms of QUERIES queries at most
        sent = block.sparkSession.sparkContext.broadcast(asked)

        def near(packets: DataFrame, known: np.ndarray | None) -> DataFrame:
            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                each = (x for b in batches for x in unpacked(b, "id", "known", "begin", "term", "hash", "code", "weight"))
                yield best_of(each, sent.value, k, known).rows(sent.value.ids)

            return best(packets.mapInArrow(work, SCORES), k)

        last = near(first, None).where(F.col("rank") == k).select("query_id", "score").toArrow()  # a row a query at most
        known = np.full(len(asked.ids), -np.inf)
        known[np.searchsorted(asked.ids, last.column("query_id").to_numpy())] = last.column("score").to_numpy()
        return near(found, known)

    return in_blocks(queries.select("query_id", "text"), leg)


def dense(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): the k nearest of vectors(id, embedding) by cosine. queries(query_id, embedding)."""

    def leg(block: DataFrame) -> DataFrame:
        table = block.select("query_id", "embedding").toArrow()  # QUERIES vectors at most
        ids = table.column("query_id").to_numpy()
        q = np.array(table.column("embedding").to_pylist(), dtype=np.float64).reshape(len(ids), -1)
        sent = vectors.sparkSession.sparkContext.broadcast((ids, q / np.linalg.norm(q, axis=1, keepdims=True)))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query, unit = sent.value
            top, rows = Best(len(query), k, -np.inf), at_a_time(len(query))
            for b in batches:
                for part in (b.slice(a, rows) for a in range(0, b.num_rows, rows) if len(query)):
                    x = part.column(1).flatten().to_numpy().astype(np.float64).reshape(part.num_rows, -1)
                    top.add(((x / np.linalg.norm(x, axis=1, keepdims=True)) @ unit.T).T, part.column(0).to_numpy())
            yield top.rows(query)

        return best(vectors.select("id", "embedding").where("id is not null and embedding is not null").mapInArrow(near, SCORES), k)

    return in_blocks(queries.select("query_id", "embedding"), leg)


def fused(legs: list[DataFrame], k: int, constant: int = RRF) -> DataFrame:
    """(query_id, id, score, rank): reciprocal-rank fusion, the sum over legs(query_id, id, rank) of 1 / (constant + rank)."""
    rows = legs[0].select("query_id", "id", "rank")
    for leg in legs[1:]:
        rows = rows.unionByName(leg.select("query_id", "id", "rank"))
    return best(rows.groupBy("query_id", "id").agg(F.round(F.sum(1 / (F.lit(constant) + F.col("rank"))), 2 * DIGITS).alias("score")), k)


def hybrid(texts: DataFrame, vectors: DataFrame, queries: DataFrame, k: int = 10, depth: int = 50, id_: str = "doc_id") -> DataFrame:
    """The k best of both legs, each taken `depth` deep. texts(id, text); vectors(id, embedding); queries(query_id, text, embedding)."""
    return fused([lexical(texts, queries, depth, id_), dense(vectors, queries, depth)], k)
