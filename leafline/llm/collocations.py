"""Phrase collocation mining: Apriori passes over word n-grams by length, then a score of each phrase's best explanation.

1. Words are counted by language. A word counted `least` times or more is frequent and gets a number.
2. Pass k: the numbers of frequent (k-1)-grams stand at their places in the text. A k-gram is counted only where the (k-1)-gram
   of its first words and that of its last words are both frequent; their two numbers are its exact key. Each task counts a
   block of text at a time, Spark adds the blocks up, and the frequent ones get numbers for the next pass.
3. The frequent grams of a level are broadcast to number the text while there are at most BROADCAST_GRAMS of them; beyond that
   the places are joined with them, hot keys in place. Either way each level's numbered text is a table in the shared folder.
4. A level's table carries, for each gram, the counts of all its first and last words, put together from the level before; a
   phrase's score takes the cut that explains it best, in exact decimals.

Texts are cut to pieces at `.,;:!?` and line ends, pieces to words at blanks and tabs; A-Z are lower-cased. Frequent words are told
from others by 64-bit hashes of language and word; all else is exact.

Defined cases: null and empty texts have no word; a null language is `und`; documents without an id count like others; repeated
rows count each time; very long texts are counted whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common, words

LEAST = 100
LONGEST = 5
BEST = 2000
BROADCAST_GRAMS = 4_000_000
ROWS = 2048

CUT = np.zeros(256, dtype=bool)
CUT[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
SPACE = CUT.copy()
SPACE[[9, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def placed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch (lang, text): the lower-cased bytes; starts and ends of all words; a place for each, which follows the place
    of the word before where both are of a piece; and its language's position in the dictionary-encoded column."""
    data, offsets = words.buffers(batch.column(1))
    data = LOWER[data]
    starts, ends, doc = words.bounds(data, offsets, SPACE)
    cuts = np.concatenate([[0], np.cumsum(CUT[data])])[starts]
    apart = np.zeros(len(starts), dtype=np.int64)
    apart[1:] = cuts[1:] != cuts[:-1]
    first = doc[:-1][np.diff(doc) > 0]
    apart[first] = 1
    lang = np.repeat(batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(doc))
    return data, starts, ends, np.arange(len(starts)) + np.cumsum(apart), lang


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray, names: list[str]) -> np.ndarray:
    """64-bit hashes of (language, word)."""
    raw, offsets = words.buffers(pa.array(names, pa.string()))
    seeds = words.hashed(raw, offsets[:-1], offsets[1:], words.EXACT) if len(names) else np.zeros(0, np.uint64)
    return words.mix(words.hashed(data, starts, ends, words.EXACT) ^ words.mix(seeds + words._STEP[3])[lang]).view(np.int64)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words at these places."""
    size = ends - starts
    to = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - to[:-1], size) + np.arange(to[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(to.tobytes()), pa.py_buffer(data[at].tobytes())).cast(pa.string())


def counted_words(texts: DataFrame) -> DataFrame:
    """(lang, word, key, n) of all words; the row of a null word counts all of a language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, _, lang = placed(batch)
            names = batch.column(0).dictionary_encode().dictionary.to_pylist()
            key = word_keys(data, starts, ends, lang, names)
            _, at, n = np.unique(key, return_index=True, return_counts=True)
            name = pa.array(names, pa.string())
            yield pa.RecordBatch.from_arrays([name.take(pa.array(lang[at])), strings(data, starts[at], ends[at]), pa.array(key[at]), pa.array(n)], COUNTED)
            total = np.bincount(lang, minlength=len(names))
            yield pa.RecordBatch.from_arrays([name, pa.nulls(len(names), pa.string()), pa.nulls(len(names), pa.int64()), pa.array(total)], COUNTED)

    return texts.mapInArrow(work, "lang string, word string, key long, n long").groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


COUNTED = ["lang", "word", "key", "n"]


def pairs(ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places) of the neighbouring numbers in a row of numbered text."""
    x = np.frombuffer(ids, dtype=np.int32).astype(np.int64)
    at = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0))
    return (x[at] << 32) | x[at + 1], at


def row_of(ids: np.ndarray, at: np.ndarray) -> bytes:
    """Numbers at ascending places as a row of numbered text: -1 between those that aren't neighbours; a number without a
    neighbour is left out, as no longer gram holds it."""
    near = np.diff(at) == 1
    beside = np.zeros(len(at), dtype=bool)
    beside[:-1] |= near
    beside[1:] |= near
    ids, at = ids[beside], at[beside]
    gap = np.zeros(len(at), dtype=np.int64)
    gap[1:] = np.diff(at) > 1
    out = np.full(len(at) + int(gap.sum()), -1, dtype=np.int32)
    out[np.arange(len(at)) + np.cumsum(gap)] = ids
    return out.tobytes()


def keyed(source: DataFrame, level: int) -> DataFrame:
    """(row, at, key): the grams of a level at their places in the source's rows, which are texts for words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, at, key in places(batch, level):
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(row, pa.int64()), len(at)), pa.array(at), pa.array(key)], ["row", "at", "key"])

    return source.mapInArrow(work, "row long, at long, key long")


def places(batch: pa.RecordBatch, level: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, places, keys) of each row of the source; texts of a batch together are named by the first one's row."""
    if level > 1:
        for row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            key, at = pairs(ids)
            yield row, at, key
    elif batch.num_rows:
        data, starts, ends, at, lang = placed(batch.select([1, 2]))
        yield batch.column(0)[0].as_py(), at, word_keys(data, starts, ends, lang, batch.column(1).dictionary_encode().dictionary.to_pylist())


def numbered(source: DataFrame, frequent: DataFrame, level: int, most: int) -> DataFrame:
    """(row, ids): the source's rows with the numbers of the frequent grams of this level at their places, stored."""
    if (n := frequent.count()) > most:
        spots = common.stored(keyed(source, level), "places")
        found = common.joined(spots, frequent.select("key", "id", "n"), "key", spots.count())
        rows = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("x")).select("row", "x.at", "x.id")  # a row is a block of text

        def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = [batch.column(k) for k in (1, 2)]
                to, at, ids = lists[0].offsets.to_numpy(), *(x.values.to_numpy() for x in lists)
                out = [row_of(ids[a:b], at[a:b]) for a, b in zip(to[:-1], to[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["row", "ids"])

        return common.stored(rows.mapInArrow(gather, "row long, ids binary"), "numbered")

    table = frequent.select("key", "id").sort("key").toArrow() if n else pa.table({"key": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
    sent = source.sparkSession.sparkContext.broadcast((table.column("key").to_numpy(), table.column("id").to_numpy().astype(np.int32)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = sent.value
        for batch in batches:
            out = []
            for row, at, key in places(batch, level):
                k = np.minimum(np.searchsorted(own, key), max(0, len(own) - 1))
                hit = own[k] == key if len(own) else np.zeros(len(key), dtype=bool)
                out.append((row, row_of(number[k[hit]], at[hit])))
            out = [(row, ids) for row, ids in out if ids]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], ["row", "ids"])

    return common.stored(source.mapInArrow(look_up, "row long, ids binary"), "numbered")


def counted_pairs(source: DataFrame) -> DataFrame:
    """(key, n): how often each pair of neighbouring numbers stands in the numbered text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [pairs(ids)[0] for ids in batch.column(0).to_pylist()]
            if keys:
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])

    return source.select("ids").mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def in_place(counts: DataFrame) -> DataFrame:
    """counts, stored with each row's partition and place in it: what a later job reads them as doesn't depend on its splits."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return common.stored(counts.withColumns({"part": F.spark_partition_id(), "nth": at}), "counts")


def with_numbers(frequent: DataFrame) -> DataFrame:
    """Rows that are in_place() with numbers `id` from 0: a row's place, beyond those of the partitions before."""
    parts = sorted((r["part"], r["n"]) for r in frequent.groupBy("part").agg((F.max("nth") + 1).alias("n")).collect())  # a row a partition
    before = np.cumsum([0, *(n for _, n in parts)]).tolist()
    if before[-1] >= 1 << 31:
        raise ValueError("over 2**31 frequent grams of one length: raise `least`")
    first = frequent.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(parts, before, strict=False)], "part int, first long")
    return common.stored(frequent.join(F.broadcast(first), "part").withColumn("id", F.col("first") + F.col("nth")).drop("part", "nth", "first"), "frequent")


def scored(k: int) -> Column:
    """An array of (score, cut, l, r) over the cuts of k words."""
    exact = "cast({} as decimal(19,0))"
    product = lambda x, y: f"{exact.format(x)} * {exact.format(y)}"
    return F.expr(f"transform(sequence(1, {k - 1}), j -> struct((1000 * ({product('a', 'n')})) div ({product('heads[j - 1]', f'tails[{k} - j - 1]')}) as score, j as cut, heads[j - 1] as l, tails[{k} - j - 1] as r))")


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, broadcast: int = BROADCAST_GRAMS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, cut) of the phrases of 2 to `longest` words that occur `least` times or more (a), but for
    those of which a phrase of one word more holds every occurrence.

    score: the least of floor(1000 * a * n / (l * r)) over the cuts into first words (l occurrences) and last words (r), by the
    earliest such cut; n: all words of the language.
    """
    common.arrow_rows(documents.sparkSession, ROWS)
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counts = in_place(counted_words(texts).where((F.col("n") >= least) | F.col("word").isNull()))
    sizes = counts.where("word is null").select("lang", F.col("n").alias("all"))
    frequent = with_numbers(counts.where("word is not null"))
    level = frequent.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.col("n").alias("a"), F.array("n").alias("heads"), F.array("n").alias("tails"))
    source = texts.select(F.monotonically_increasing_id().alias("row"), "lang", "text")
    levels = []
    for k in range(2, longest + 1):
        source = numbered(source, frequent, k - 1, broadcast)
        frequent = with_numbers(in_place(counted_pairs(source).where(F.col("n") >= least)))
        head, tail = F.shiftright("key", 32).alias("head"), F.col("key").bitwiseAND(F.lit((1 << 32) - 1)).alias("tail")
        gram = frequent.select("id", F.col("n").alias("a"), head, tail)
        most = gram.select(F.explode(F.array("head", "tail")).alias("id"), "a").groupBy("id").agg(F.max("a").alias("longer"))
        if levels:
            levels[-1] = levels[-1].join(most, "id", "left").where("longer is null or longer < a").drop("longer")
        first = level.select(F.col("id").alias("head"), "lang", F.col("phrase").alias("p"), F.col("heads").alias("h"))
        last = level.select(F.col("id").alias("tail"), F.col("last").alias("w"), F.col("tails").alias("t"))
        joined = gram.join(first, "head").join(last, "tail")
        level = common.stored(joined.select("id", "lang", F.concat_ws(" ", "p", "w").alias("phrase"), F.col("w").alias("last"), "a", F.array_append("h", F.col("a")).alias("heads"), F.array_append("t", F.col("a")).alias("tails")), "level")
        levels.append(level)
    out = None
    for k, one in enumerate(levels, 2):
        one = one.join(sizes, "lang").withColumnRenamed("all", "n").withColumn("best", F.array_min(scored(k)))
        one = one.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", F.col("best.cut").alias("cut"))
        out = one if out is None else out.unionAll(one)
    return out


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(common.read(spark, sf_dir, "documents"))
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEST)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = rf"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), up, low), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents, letters),
sizes AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM places, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}),
kept AS (SELECT * FROM grams AS g WHERE k >= 2 AND NOT EXISTS (SELECT 1 FROM grams AS h WHERE h.lang = g.lang AND h.k > g.k AND 100 * h.a >= 100 * g.a AND contains(' ' || h.phrase || ' ', ' ' || g.phrase || ' '))),
cuts AS (SELECT kept.*, unnest(range(1, k)) AS cut FROM kept),
scores AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, cut, CAST((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cuts AS c JOIN sizes USING (lang)
  JOIN grams AS x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[:cut], ' ')
  JOIN grams AS y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ')),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= {BEST}
"""
