"""Language-model scoring with an Elias-Fano n-gram trie.

Training counts words, then pairs of successive words, over all training documents:

1. Level 1: words are 64-bit hashes, aggregated over the corpus and dealt by their top bits into segments of about SEGMENT
   words. A segment file has the sorted hashes as an Elias-Fano sequence (a word's id is its rank), counts, and the
   discounted probability quantised to 256 levels.
2. Level 2: pairs of ids are counted per task, cut at key boundaries of equal training mass (so a frequent context is cut
   as well), and merged per part into a segment file: monotone pointers from each context to its successors (Elias-Fano),
   the successors' ids as one monotone sequence (each context's ids on top of the last value before it, Elias-Fano), and
   the discounted probabilities quantised to 256 levels. Level 3 does the same with the index of a pair as its context;
   for it, level 2 also keeps the running sum of its counts (Elias-Fano).
3. Each level has an index file (its cuts, and the sizes and bounds of its segments). Cuts come from each segment's own running
   counts and the sums before it; the driver only sees sizes.
4. Scoring maps segment and index files into memory from the folder in spark.checkpoint.dir, which must be a mounted path that
   executors share. A word's successor is searched relative to its context: pointer, base value, then the successor of
   base + id in the monotone sequence. Each batch looks up its distinct words and pairs once.

The model interpolates absolute discounting: P(w|c) = max(n(c,w) - D, 0) / n(c) + D * types(c) / n(c) * P(w|c') with c'
a word shorter than c, P1(w) = (n(w) - D1) / N, and D1 * V / N for the one unknown word; D1 = n1 / (n1 + 2 n2). A text is scored from an end token
to its end token, so an empty text has the probability of the end after an end.

Defined cases: null text is empty; null doc_id counts as held out; repeated rows are learnt and scored each; very long
texts are read whole; with no training row every probability is 1 (score 0); an empty table gives no rows; further columns
are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common
from leafline.llm.eliasfano import EliasFano, mapped, write
from leafline.llm.words import word_hashes

FOLDS, FOLD = 7, 2
DISCOUNT = 0.75
ORDER = 3
SEGMENT = 1 << 20
PART = 1 << 22
FLUSH = 1 << 21
#: Bytes of text that share their look-ups of distinct words and pairs.
GATHER = 3 << 19
END = np.uint64(0x5EED0FE11D0C5EED)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(common.unsigned_crc32(doc_id) % FOLDS == FOLD, F.lit(True))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an end token after each text, and the len+1 offsets."""
    words, doc = word_hashes(texts)
    n = len(doc) - 1
    to = doc + np.arange(n + 1)
    out = np.empty(len(words) + n, dtype=np.uint64)
    at = np.ones(len(out), dtype=bool)
    at[to[1:] - 1] = False
    out[at], out[~at] = words, END
    return out, to


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codebook of 256 levels, codes): equal steps from the least to the greatest value; a level is the mean of its values."""
    low, high = values.min(), values.max()
    code = ((values - low) * (255 / (high - low) if high > low else 0) + 0.5).astype(np.uint8)
    n = np.bincount(code, minlength=256)
    book = np.divide(np.bincount(code, weights=values, minlength=256), n, out=np.zeros(256), where=n > 0)
    return book.astype(np.float32), code


LOW = np.uint64(0xFFFFFFFF)


def placed(cut_context: np.ndarray, cut_word: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """How many of the sorted cuts (context, word) lie at or before each of the given pairs: the part that a pair is in."""
    out = np.searchsorted(cut_context, context, side="left")
    at = np.flatnonzero(cut_context[np.minimum(out, len(cut_context) - 1)] == context) if len(cut_context) else out[:0]
    if len(at):  # bisect the words of a context that is cut
        lo, hi, w = out[at], np.searchsorted(cut_context, context[at], side="right"), word[at]
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) >> 1
            less = cut_word[mid] <= w[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
        out[at] = lo
    return out


@dataclass
class Level:
    """The segment files of one level from 2 on, and its index file: cuts, and by part the entries before it, its entries, its
    first and last context and their successors over all parts. Both are mapped, so a level costs its path."""

    path: str

    def index(self) -> dict[str, np.ndarray]:
        return mapped(self.path)

    def part(self, k: int) -> dict[str, np.ndarray]:
        return mapped(f"{self.path}-{k}")

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry or -1, discounted probability or 0) of pairs that are sorted by context and word."""
        index = self.index()
        entry, out = np.full(len(context), -1, np.int64), np.zeros(len(context))
        part = placed(index["cut_context"], index["cut_word"], context, word)
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            k = part[a]
            if not index["n"][k]:
                continue
            first = index["lo"][k]
            span = np.arange(a, b)
            span = span[(context[a:b] >= first) & (context[a:b] <= index["hi"][k])]
            if not len(span):
                continue
            held = self.part(k)
            pointer, after = EliasFano.of(held, "pointer"), EliasFano.of(held, "after")
            own = context[span] - first
            new = np.concatenate([[True], own[1:] != own[:-1]])
            c, inverse = own[new], np.cumsum(new) - 1
            lo, hi = pointer.access(c).astype(np.int64), pointer.access(c + 1).astype(np.int64)
            base = np.where(lo > 0, after.access(np.maximum(lo - 1, 0)), np.uint64(0))
            i = after.find(base[inverse] + word[span].astype(np.uint64) + np.uint64(1))
            ok = (i >= lo[inverse]) & (i < hi[inverse])
            entry[span[ok]] = index["before"][k] + i[ok]
            out[span[ok]] = 10.0 ** held["book"][held["code"][i[ok]]].astype(np.float64)
        return entry, out

    def successors(self, context: np.ndarray) -> np.ndarray:
        """The number of distinct successors of sorted distinct contexts."""
        index = self.index()
        out = np.zeros(len(context), np.int64)
        part, last = (placed(index["cut_context"], index["cut_word"], context, np.full(len(context), w)) for w in (0, np.iinfo(np.int64).max))
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            k = part[a]
            at = np.arange(a, b)
            at = at[(last[a:b] == k) & (context[a:b] >= index["lo"][k]) & (context[a:b] <= index["hi"][k])]
            if len(at) and index["n"][k]:
                pointer, own = EliasFano.of(self.part(k), "pointer"), context[at] - index["lo"][k]
                out[at] = (pointer.access(own + 1) - pointer.access(own)).astype(np.int64)
        for i in np.flatnonzero(part != last):  # contexts that are cut: the index has their sums
            for k in range(part[i], last[i] + 1):
                ends = [t for e, t in (("lo", "lo_total"), ("hi", "hi_total")) if index["n"][k] and index[e][k] == context[i]]
                if ends:
                    out[i] = index[ends[0]][k]
                    break
        return out

    def counts(self, entry: np.ndarray) -> np.ndarray:
        """Training counts of sorted entries."""
        index = self.index()
        out = np.zeros(len(entry), np.int64)
        part = np.searchsorted(index["before"], entry, side="right") - 1
        edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            i = entry[a:b] - index["before"][part[a]]
            mass = EliasFano.of(self.part(part[a]), "mass")
            out[a:b] = (mass.access(i) - np.where(i > 0, mass.access(np.maximum(i - 1, 0)), np.uint64(0))).astype(np.int64)
        return out


@dataclass
class Model:
    """What scoring needs besides the files: sizes, discounts, and the path that all files' names begin with."""

    root: str = ""
    tokens: int = 0
    types: int = 0
    d1: float = 0.5
    bits: int = 1
    levels: int = 1

    @property
    def unknown(self) -> float:
        return self.d1 * self.types / self.tokens

    def level(self, n: int) -> Level:
        return Level(f"{self.root}/level-{n}")

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, counts, P1) of sorted word hashes; id -1 where unknown."""
        index = mapped(f"{self.root}/level-1")
        ids, count, p = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), np.full(len(hashes), self.unknown)
        seg = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        edge = np.flatnonzero(np.diff(seg, prepend=-1, append=-1))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            if index["n"][seg[a]]:
                held = mapped(f"{self.root}/level-1-{seg[a]}")
                i = EliasFano.of(held, "hash").find(hashes[a:b])
                ok = i >= 0
                at = np.flatnonzero(ok) + a
                ids[at], count[at] = index["before"][seg[a]] + i[ok], held["count"][i[ok]]
                p[at] = 10.0 ** held["book"][held["code"][i[ok]]].astype(np.float64)
        return ids, count, p

    def word_counts(self, lo: int, hi: int) -> np.ndarray:
        """Training counts of the words with ids from lo to hi."""
        index = mapped(f"{self.root}/level-1")
        out = np.zeros(hi - lo + 1, np.int64)
        for k in range(int(np.searchsorted(index["before"], lo, side="right")) - 1, int(np.searchsorted(index["before"], hi, side="right"))):
            at = int(index["before"][k])
            a, b = max(lo, at), min(hi + 1, at + int(index["n"][k]))
            if a < b:
                out[a - lo : b - lo] = mapped(f"{self.root}/level-1-{k}")["count"][a - at : b - at]
        return out

    def walk(self, texts: pa.Array):
        """The tokens of texts as places among their distinct words: (offsets, place of each token, of the token before it,
        ids, counts and P1 of the distinct words). An end stands before each text."""
        t, to = tokens(texts)
        distinct, at = np.unique(np.append(t, END), return_inverse=True)
        end, at = at[-1], at[:-1]
        prev = np.empty_like(at)
        prev[1:] = at[:-1]
        prev[to[:-1]] = end
        return to, at, prev, *self.words(distinct)

    def entries(self, level: int, rank: np.ndarray, contexts: np.ndarray, at: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Level.find for contexts[rank] and words ids[at], -1 where there is none. contexts and ids are sorted but for -1, so
        that distinct pairs are looked up once, in order, by their places."""
        entry, seen = np.full(len(at), -1, np.int64), np.zeros(len(at))
        both = (rank >= 0) & (contexts[rank] >= 0) & (ids[at] >= 0) if len(contexts) else np.zeros(len(at), bool)
        key, inverse = np.unique((rank[both].astype(np.uint64) << np.uint64(32)) | at[both].astype(np.uint64), return_inverse=True)
        e, p = self.level(level).find(contexts[(key >> np.uint64(32)).astype(np.int64)], ids[(key & LOW).astype(np.int64)])
        entry[both], seen[both] = e[inverse], p[inverse]
        return entry, seen

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        if not self.tokens:
            n = np.diff(tokens(texts)[1])
            return {"n_tokens": n, "n_known": np.zeros(len(n), np.int64), "base_score": np.zeros(len(n)), "score": np.zeros(len(n))}
        to, at, prev, ids, count, p1 = self.walk(texts)
        base = np.log10((count + 1) / (self.tokens + self.types + 1))
        known = np.flatnonzero(ids >= 0)
        back = np.ones(len(ids))
        back[known] = DISCOUNT * self.level(2).successors(ids[known]) / np.maximum(count[known], 1) if self.levels > 1 else 1.0
        entry, seen = self.entries(2, prev, ids, at, ids) if self.levels > 1 else (np.full(len(at), -1), np.zeros(len(at)))
        p = seen + back[prev] * p1[at]
        for n in range(3, self.levels + 1):
            some, rank = ranked(shifted(entry, to))
            rest = DISCOUNT * self.level(n).successors(some) / np.maximum(self.level(n - 1).counts(some), 1)
            entry, seen = self.entries(n, rank, some, at, ids)
            has = rank >= 0
            p[has] = seen[has] + rest[rank[has]] * p[has]
        total = lambda x: np.add.reduceat(x, to[:-1]) if len(to) > 1 else np.zeros(0)
        return {"n_tokens": np.diff(to), "n_known": total((ids >= 0)[at].astype(np.int64)), "base_score": total(base[at]), "score": total(np.log10(np.minimum(p, 1.0)))}


def ranked(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct contexts in order, the place of each there); place -1 for -1."""
    has = context >= 0
    some, inverse = np.unique(context[has], return_inverse=True)
    rank = np.full(len(context), -1, np.int64)
    rank[has] = inverse
    return some, rank


def shifted(entry: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Each token's entry as the context of the next token of its text; -1 for first tokens."""
    out = np.empty_like(entry)
    out[1:] = entry[:-1]
    out[to[:-1]] = -1
    return out


def _counted(chunks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(chunks), return_counts=True) if chunks else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def word_counts(documents: DataFrame) -> DataFrame:
    """(h, n) of documents(text), summed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append(tokens(b.column(0))[0])
            size += len(held[-1])
            if size >= FLUSH:
                h, n = _counted(held)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])
                held, size = [], 0
        h, n = _counted(held)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    return documents.mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def packed(key: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts, compressed: differences by byte plane."""
    planes = lambda x: np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
    step = np.diff(key, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(key)]).tobytes() + planes(step) + planes(n.astype(np.uint32)))


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    planes = lambda x, t: np.ascontiguousarray(x.reshape(-1, n).T).view(t).ravel()
    return np.cumsum(planes(raw[8 : 8 + 8 * n], np.uint64), dtype=np.uint64), planes(raw[8 + 8 * n :], np.uint32).astype(np.int64)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches joined until their texts, the last column, have GATHER bytes: more share more look-ups."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(b.num_columns - 1).nbytes
        if size >= GATHER:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def train(documents: DataFrame, order: int = ORDER) -> Model:
    """A model of documents(text). The driver sees sizes only: segments, their index and the cuts are files."""
    spark = documents.sparkSession
    root = f"{common.local_path(common.shared_dir(spark))}/trie-{uuid.uuid4().hex}"
    counts = common.stored(word_counts(documents), "words")
    total, types, n1, n2 = counts.agg(F.sum("n"), F.count("*"), F.sum((F.col("n") == 1).cast("long")), F.sum((F.col("n") == 2).cast("long"))).first()
    if not total:
        return Model()
    model = Model(root, total, types, min(0.95, max(0.05, n1 / (n1 + 2 * n2) if n1 else 0.5)), max(1, (types // SEGMENT).bit_length()), order)
    d1 = model.d1

    def level1(key: tuple, table: pa.Table) -> pa.Table:
        h, n = table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy()
        by = np.argsort(h)
        h, n = h[by], n[by]
        book, code = quantised(np.log10((n - d1) / total))
        write(f"{root}/level-1-{key[0].as_py()}", EliasFano.build(h).arrays("hash") | {"count": n, "book": book, "code": code})
        return _made(key[0].as_py(), len(h), int(n.sum()))

    seg = F.shiftrightunsigned("h", 64 - model.bits)
    made = common.stored(counts.withColumn("part", seg).groupBy("part").applyInArrow(level1, MADE), "segments")
    _index(made, f"{root}/level-1", 1 << model.bits)
    for level in range(2, order + 1):
        parts = _cut(made, model, level)
        made = common.stored(_grow(documents, model, level, order), "segments")
        _index(made, f"{root}/level-{level}", parts)
    return model


MADE = "part long, n long, mass long, lo long, hi long, n_lo long, n_hi long"


def _made(*row: int) -> pa.Table:
    row = (*row, *[0] * (7 - len(row)))
    return pa.table({f.split(" ")[0]: pa.array([x], pa.int64()) for f, x in zip(MADE.split(", "), row, strict=True)})


def _index(made: DataFrame, path: str, parts: int) -> None:
    """The index file of a level's segments. One task writes it: eight numbers for each segment of about PART tokens."""
    ends = made.select(F.explode(F.array(F.struct(F.col("lo").alias("c"), F.col("n_lo").alias("s")), F.struct(F.col("hi").alias("c"), F.when(F.col("hi") != F.col("lo"), F.col("n_hi")).otherwise(0).alias("s")))).alias("x"))
    ends = ends.groupBy("x.c").agg(F.sum("x.s").alias("s"))
    rows = made.join(ends.select(F.col("c").alias("lo"), F.col("s").alias("lo_total")), "lo").join(ends.select(F.col("c").alias("hi"), F.col("s").alias("hi_total")), "hi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {c: np.zeros(parts, np.int64) for c in ("n", "mass", "lo", "hi", "lo_total", "hi_total")}
        for b in batches:
            for c, x in out.items():
                x[b.column("part").to_numpy()] = b.column(c).to_numpy()
        before = {f"{k}before": np.cumsum(out[c]) - out[c] for k, c in (("", "n"), ("mass_", "mass"))}
        cuts = dict(mapped(f"{path}-cuts")) if os.path.exists(f"{path}-cuts") else {}
        write(path, out | before | cuts)
        yield pa.RecordBatch.from_arrays([pa.array([parts])], ["parts"])

    rows.repartition(1).mapInArrow(work, "parts long").collect()  # one row


def _cut(made: DataFrame, model: Model, level: int) -> int:
    """Writes the cuts of a level and returns the number of its parts: pairs that cut the training tokens into parts of PART, by
    the counts of their contexts, the entries of the level before. A context larger than that is cut inside. Each segment gives
    the cuts that lie in it; one task writes them, two numbers for each part.

    A part's contexts, one token each at least, and its words must fit 64 bits together, so parts shrink where words need more.
    """
    below, total, types = model.level(level - 1), model.tokens, model.types
    parts = max(1, -(-total // min(PART, 1 << max(1, 62 - types.bit_length()))))

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = below.index()
        for b in batches:
            for k in b.column("part").to_pylist():
                held = below.part(k)
                m = np.cumsum(held["count"]) if level == 2 else (e := EliasFano.of(held, "mass")).access(np.arange(e.n)).astype(np.int64)
                before = int(index["mass_before"][k])
                first, last = (x * parts // total for x in (before, before + int(m[-1])))
                goal = np.array([g * total // parts for g in range(max(1, first), min(parts - 1, last + 1) + 1)], np.int64) - before
                goal = goal[(goal > 0) & (goal <= m[-1])]
                i = np.searchsorted(m, goal)
                start = np.where(i > 0, m[np.maximum(i - 1, 0)], 0)
                word = ((goal - start) / (m[i] - start) * types).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(index["before"][k] + i), pa.array(word)], ["context", "word"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        c, w = (np.concatenate(x)[1:] for x in zip(*held, strict=True))  # after the row before all
        write(f"{model.root}/level-{level}-cuts", {"cut_context": c, "cut_word": w})
        yield pa.RecordBatch.from_arrays([pa.array([len(c) + 1])], ["parts"])

    cuts = made.select("part").mapInArrow(inside, "context long, word long").distinct()
    cuts = cuts.union(cuts.sparkSession.range(1).select(F.lit(-1).cast("long"), F.lit(-1).cast("long")))
    return cuts.repartition(1).sortWithinPartitions("context", "word").mapInArrow(work, "parts long").first()["parts"]


def pairs_counted(context: np.ndarray, word: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, words, counts) of the distinct pairs in order; words have `shift` bits."""
    if int(context.max(initial=0)).bit_length() + shift <= 64:
        key, n = np.unique((context.astype(np.uint64) << np.uint64(shift)) | word.astype(np.uint64), return_counts=True)
        return (key >> np.uint64(shift)).astype(np.int64), (key & np.uint64((1 << shift) - 1)).astype(np.int64), n
    by = np.lexsort((word, context))
    context, word = context[by], word[by]
    new = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (word[1:] != word[:-1])]))
    return context[new], word[new], np.diff(np.append(new, len(context)))


def _grow(documents: DataFrame, model: Model, level: int, order: int) -> DataFrame:
    """Writes a level's segments, counts of (entry of the level before, word id) merged part by part, and returns MADE."""
    shift, cuts, root = model.types.bit_length(), f"{model.root}/level-{level}-cuts", f"{model.root}/level-{level}"

    def based(part: np.ndarray) -> np.ndarray:
        first = mapped(cuts)["cut_context"]
        return np.where(part > 0, first[np.maximum(part - 1, 0)], 0) if len(first) else np.zeros(len(part), np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            c, w, n = pairs_counted(*(np.concatenate(x) for x in zip(*held, strict=True)), shift)
            part = placed(mapped(cuts)["cut_context"], mapped(cuts)["cut_word"], c, w)
            key = ((c - based(part)).astype(np.uint64) << np.uint64(shift)) | w.astype(np.uint64)
            edge = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
            return pa.RecordBatch.from_arrays([pa.array(part[edge[:-1]]), pa.array([packed(key[a:b], n[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.binary())], ["part", "blob"])

        held, size = [], 0
        for b in gathered(batches):
            to, at, prev, ids, *_ = model.walk(b.column(0))
            context, some, rank = ids[prev], ids, prev
            for n in range(2, level):
                context = shifted(model.entries(n, rank, some, at, ids)[0], to)
                some, rank = ranked(context)
            has = context >= 0
            held.append((context[has], ids[at][has]))
            size += len(held[-1][0])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        each = [unpacked(x) for x in table.column("blob").to_pylist()]
        k = np.concatenate([x[0] for x in each])
        by = np.argsort(k, kind="stable")
        k, n = k[by], np.concatenate([x[1] for x in each])[by]
        new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        k, n = k[new], np.add.reduceat(n, new)
        context, word = (k >> np.uint64(shift)).astype(np.int64) + based(np.array([part]))[0], k & np.uint64((1 << shift) - 1)
        lo, hi = int(context[0]), int(context[-1])
        of = model.word_counts(lo, hi) if level == 2 else model.level(level - 1).counts(np.arange(lo, hi + 1))
        pointer = np.searchsorted(context, np.arange(lo, hi + 2))
        ends = np.flatnonzero(np.append(context[1:] != context[:-1], True))
        base = np.concatenate([[np.uint64(0)], np.cumsum(word[ends] + np.uint64(1), dtype=np.uint64)[:-1]])
        size = np.diff(np.concatenate([[0], ends + 1]))
        book, code = quantised(np.log10((n - DISCOUNT) / of[context - lo]))
        more = EliasFano.build(np.cumsum(n)).arrays("mass") if level < order else {}
        write(f"{root}-{part}", EliasFano.build(pointer).arrays("pointer") | EliasFano.build(np.repeat(base, size) + word + np.uint64(1)).arrays("after") | {"book": book, "code": code} | more)
        return _made(part, len(k), int(n.sum()), lo, hi, int(size[0]), int(size[-1]))

    return documents.mapInArrow(count, "part long, blob binary").groupBy("part").applyInArrow(merge, MADE)


def scores(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """Scores of documents by a model of those that aren't held out."""
    common.arrow_rows(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    model = train(rows.where("not held_out").select("text"), order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gathered(batches):
            s = model.score(b.column(2))
            own = (b.column(k).combine_chunks() for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*own, pa.array(s["n_tokens"]), pa.array(s["n_known"], pa.int64()), pa.array(np.full(b.num_rows, model.tokens)), pa.array(s["base_score"]), pa.array(s["score"])], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(work, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(common.read(spark, sf_dir, "documents"))
