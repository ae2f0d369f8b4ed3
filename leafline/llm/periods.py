"""Periodic runs of words: every maximal repetition of a text, found from Lyndon words, and texts with the repetitions cut.

1. A run of period q and length max(SHORTEST, REPEATS * q) or more repeats each of its five-word windows q words on. So a run lies within
   a stretch of words all covered by five-word windows that recur in the text; other words can hold none. Windows are compared
   by hashes, and a clash of hashes only lengthens a stretch.
2. Each stretch is scanned right to left with a stack of Lyndon words (the next smaller suffix of each position), once under
   an order of its words and once under the reverse. Each run has a root that is the longest Lyndon word at its place under one
   of the two, so these words give every period; there are fewer than two candidates a word.
3. Suffixes are compared, and candidates extended to both sides, by longest common extensions: a few words directly, then
   doubling and a binary search over rolling hashes modulo 2**61 - 1.
4. Each run is verified on its words: words a period apart are the same, and neither neighbour goes on. Should that fail, the
   stretch is done again with extensions that compare words instead of hashes.

A task works on one text after another; nothing is shuffled. Words are runs of bytes other than ASCII white space; case counts.

Defined cases: null and empty texts have no word, no run and an empty collapsed text; very long texts are scanned whole;
repeated rows and null ids are rows like others; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import common, words

SHORTEST = 6
REPEATS = 4
WINDOW = 5  # words of a window that recurs; (REPEATS - 1) * q and SHORTEST - 1 are no smaller for any q it has to serve
DIRECT = 12
MODULUS = (1 << 61) - 1
BASE = 0x1B2E5F3A9C8D7431 % MODULUS

Extend = Callable[[int, int], int]


def by_hash(w: list[int]) -> tuple[Extend, Extend]:
    """(ahead, behind): the common length of w[i:], w[j:], and of w[:i], w[:j], for i < j, by rolling hashes."""
    n, h, power, x, b = len(w), [0], [1], 0, 1
    for v in w:
        h.append(x := (x * BASE + v + 1) % MODULUS)
        power.append(b := b * BASE % MODULUS)

    def same(i: int, j: int, k: int) -> bool:
        return (h[i + k] - h[j + k] - (h[i] - h[j]) * power[k]) % MODULUS == 0

    def longest(most: int, equal: Callable[[int], bool]) -> int:
        """The greatest k <= most with equal(k), which holds for DIRECT: doubling, then bisection."""
        low, high = DIRECT, 2 * DIRECT
        while high <= most and equal(high):
            low, high = high, 2 * high
        high = min(high, most + 1)
        while high - low > 1:
            mid = (low + high) // 2
            if equal(mid):
                low = mid
            else:
                high = mid
        return low

    def ahead(i: int, j: int) -> int:
        most = n - j
        for k in range(min(DIRECT, most)):
            if w[i + k] != w[j + k]:
                return k
        return most if most <= DIRECT else longest(most, lambda k: same(i, j, k))

    def behind(i: int, j: int) -> int:
        for k in range(min(DIRECT, i)):
            if w[i - k - 1] != w[j - k - 1]:
                return k
        return i if i <= DIRECT else longest(i, lambda k: same(i - k, j - k, k))

    return ahead, behind


def by_words(w: list[int]) -> tuple[Extend, Extend]:
    """The same by comparing words."""
    n = len(w)
    ahead = lambda i, j: next((k for k in range(n - j) if w[i + k] != w[j + k]), n - j)
    behind = lambda i, j: next((k for k in range(i) if w[i - k - 1] != w[j - k - 1]), i)
    return ahead, behind


def lyndon_ends(w: list[int], ahead: Extend) -> list[int]:
    """The end of the longest Lyndon word at each position: the next position whose suffix is smaller. A suffix that goes on
    where another ends is the greater one."""
    n = len(w)
    end = [n] * n
    for i in range(n - 1, -1, -1):
        x, j = w[i], i + 1
        while j < n:
            y = w[j]
            if x == y:
                k = ahead(i, j)
                if j + k == n or w[i + k] > w[j + k]:
                    break
            elif x > y:
                break
            j = end[j]
        end[i] = j
    return end


def found(w: list[int], orders: list[list[int]], extend: tuple[Extend, Extend], shortest: int, repeats: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs whose roots are Lyndon words under one of the orders."""
    n, out = len(w), set()
    ahead, behind = extend
    for order in orders:
        last: dict[int, int] = {}  # the start of the leftmost run of a period so far; a position in it is no other's root
        for i, j in reversed(list(enumerate(lyndon_ends(order, ahead)))):
            if j == n or w[i] != w[j]:
                continue
            q = j - i
            if last.get(q, n) <= i:
                continue
            right = ahead(i, j)
            if right < q:
                continue
            start = i - behind(i, j)
            last[q] = start
            if (length := j + right - start) >= max(shortest, repeats * q):
                out.add((start, length, q))
    return out


def holds(w: list[int], start: int, length: int, q: int) -> bool:
    end = start + length
    return w[start : end - q] == w[start + q : end] and (start == 0 or w[start - 1] != w[start - 1 + q]) and (end == len(w) or w[end] != w[end - q])


def runs_of(w: list[int], shortest: int = SHORTEST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, by start, then period."""
    orders = [w, [-x for x in w]]
    out = found(w, orders, by_hash(w), shortest, repeats)
    if not all(holds(w, *r) for r in out):
        out = found(w, orders, by_words(w), shortest, repeats)
    return sorted(out)


def stretches(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of words that recurring windows of WINDOW words cover; h: the words' hashes."""
    gram, to = words.shingles(h, doc, WINDOW)
    own = np.repeat(np.arange(len(doc) - 1), np.diff(to))
    key = words.mix(gram + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, dtype=bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), dtype=bool)
    again[order] = same[1:] | same[:-1]
    at = np.flatnonzero(again)
    at = at + (doc[:-1] - to[:-1])[own[at]]  # the window's first word
    if not len(at):
        return at, at
    gap = np.flatnonzero((np.diff(at) > WINDOW) | (np.diff(np.searchsorted(doc, at, side="right")) > 0))
    return at[np.concatenate([[0], gap + 1])], at[np.concatenate([gap, [len(at) - 1]])] + WINDOW


def periodic_runs(documents: DataFrame, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each document: its runs by start and period, and its words, joined by one space,
    without those that a run holds after its first period. A run has `shortest` words and `repeats` periods at least."""
    if shortest < SHORTEST or repeats < REPEATS:
        raise ValueError(f"runs of under {SHORTEST} words or {REPEATS} periods may stand outside the stretches")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(1))
            starts, ends, doc = words.bounds(data, offsets)
            rows: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            kept = np.ones(len(starts), dtype=bool)
            for a, b in zip(*(x.tolist() for x in stretches(words.hashed(data, starts, ends, words.EXACT), doc)), strict=True):
                text, base, seen = data[starts[a] : ends[b - 1]].tobytes(), int(starts[a]), {}
                ids = [seen.setdefault(text[s - base : e - base], len(seen)) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                d = int(np.searchsorted(doc, a, side="right")) - 1
                for start, length, q in runs_of(ids, shortest, repeats):
                    rows[d].append((a - int(doc[d]) + start, length, q))
                    kept[a + start + q : a + start + length] = False
            flat = np.array([r for each in rows for r in each], dtype=np.int64).reshape(-1, 3)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(doc), pa.int64()), lists, joined(data, starts, ends, doc, kept)], ["doc_id", "n_words", "runs", "collapsed"])

    common.arrow_rows(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string")


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    count = np.concatenate([[0], np.cumsum(kept)])[doc]
    s, e = starts[kept], ends[kept]
    inner = np.ones(len(s), dtype=bool)
    inner[count[1:][np.diff(count) > 0] - 1] = False  # not the last word of its text: the byte after it becomes a space
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[s] = 1
    step[e + inner] -= 1
    out = data.copy()
    out[e[inner]] = 32
    size = np.concatenate([[0], np.cumsum(e - s + inner)])[count]
    out = out[np.cumsum(step[:-1], dtype=np.int8).view(bool)]
    return pa.LargeStringArray.from_buffers(len(doc) - 1, pa.py_buffer(size.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())).cast(pa.string())


def with_repeated_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text), where a document whose id's CRC ends in 0 repeats itself: from word a = g % n on, the words start again
    every 1 + floor((n - a) / (3 + g % 8)) words, g being a tenth of the CRC."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), common.unsigned_crc32(F.col("doc_id").cast("long")).alias("h"))
    chosen = rows.select("doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")).alias("w"))
    chosen = chosen.withColumn("n", F.when(F.size("w") > 0, F.size("w").cast("long"))).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    chosen = chosen.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence(F.lit(0), (F.col("n") - F.col("a") - 1).cast("int")), lambda i: F.get("w", F.col("a") + i % F.col("p")))
    text = F.when(F.col("n").isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.slice("w", 1, F.col("a")), tail), " "))
    return chosen.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs(with_repeated_tails(common.read(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    out = out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
    best = {"start": -F.col("r.start"), "length": F.col("r.length"), "period": -F.col("r.period"), "exponent_milli": F.floor(1000 * F.col("r.length") / -F.col("r.period"))}
    return out.select("doc_id", "n_runs", *(v.cast("long").alias(k) for k, v in best.items()), "runs_sha256", "collapsed_sha256", "n_words")


OP13_SQL = r"""
WITH ids AS (SELECT *, row_number() OVER () AS r, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes FROM documents),
hashed AS (SELECT *, xor(list_reduce(bytes, lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295), 4294967295) AS h FROM ids),
split AS (SELECT r, doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM hashed),
tails AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM split),
steps AS (SELECT *, 1 + (len(w) - a) // (3 + g % 8) AS p FROM tails),
w AS (SELECT r, doc_id, i, CASE WHEN i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS x FROM (SELECT *, unnest(range(len(w))) AS i FROM steps)),
pairs AS (SELECT u.r, u.i, v.i - u.i AS q FROM w AS u JOIN w AS v ON u.r = v.r AND u.x = v.x AND v.i > u.i),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs),
found AS (SELECT r, min(i) AS s, max(i) + 1 + q AS e, q FROM islands GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, s AS start, e - s AS length, min(q) AS period FROM found GROUP BY r, s, e),
listed AS (SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines, arg_min({'start': start, 'length': length, 'period': period}, [-length, start, period]) AS best FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) FILTER (WHERE dropped.r IS NULL) AS t FROM w LEFT JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256, CAST(len(w) AS BIGINT) AS n_words
FROM split LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
