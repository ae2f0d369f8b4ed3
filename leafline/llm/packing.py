"""Packing by shortest-pack-first over the length histogram.

Every document becomes token ids plus one end id, cut into whole sequences and one rest. Pieces are counted by length;
the histogram (at most `max_length` rows) is packed on the driver, longest length first, each into the open pattern with
the most room. The resulting table of slots goes back to the pieces by rank within their length, so only lengths and
counts ever meet: no list of documents is collected, and a length that a third of all pieces share is ranked in salted
buckets whose bases come from a prefix sum over counts.

Defined cases: null text packs as empty (its end id alone); null doc_id packs with a null doc_id; repeated rows pack
once each; ties in length are ranked by (doc_id, start, crc, doc_tokens); an empty table gives no rows; further columns
of the input are ignored. Very long documents are cut into sequences of `max_length`.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafline.llm import common

MAX_LENGTH = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k"
_SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY):
    """Text to ids of public_tokenizers' {vocabulary}.json; tiktoken runs the same ranks several times faster.

    A text that spells the special token goes through `tokenizers` itself, which gives that token its own id.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if _SPECIAL in text:
            if not exact:
                exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(documents: DataFrame, max_length: int = MAX_LENGTH, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """The cut documents: one row of PIECE for each whole sequence and each rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.array(end_id, dtype="<u4"))
                for at in range(0, len(ids), max_length):
                    part = ids[at : at + max_length]
                    out.append((doc_id, at, len(part), crc32(part.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * 5, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    common.arrow_rows(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE)


def patterns(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of each packing pattern: lengths go longest first to the pattern that is shortest so far.

    Each step either ends a length or fills up a group of equal patterns, so there are some thousand patterns at most,
    whatever the counts are.
    """
    room: dict[int, list[list]] = defaultdict(list)
    most: list[int] = []  # rooms with open patterns, largest first
    done: list[tuple[int, tuple[int, ...]]] = []

    def open_(count: int, lengths: tuple[int, ...], left: int) -> None:
        if left == 0:
            done.append((count, lengths))
            return
        if not room[left]:
            heapq.heappush(most, -left)
        room[left].append([count, lengths])

    for length in sorted(histogram, reverse=True):
        todo = histogram[length]
        while todo:
            while most and not room[-most[0]]:
                heapq.heappop(most)
            if not most or -most[0] < length:
                open_(todo, (length,), max_length - length)
                break
            left = -most[0]
            group = room[left].pop()
            used = min(todo, group[0])
            if group[0] > used:
                group[0] -= used
                room[left].append(group)
            todo -= used
            open_(used, (*group[1], length), left - length)
    return done + [(c, p) for groups in room.values() for c, p in groups]


def slots(histogram: dict[int, int], max_length: int = MAX_LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): the pieces of a length with these ranks, in order, each go
    to the next sequence at that offset."""
    out, sequence, rank = [], 0, defaultdict(int)
    for count, lengths in patterns(histogram, max_length):
        offset = 0
        for length in lengths:
            out.append((length, rank[length], rank[length] + count, sequence, offset))
            rank[length] += count
            offset += length
        sequence += count
    return out


def pack(documents: DataFrame, max_length: int = MAX_LENGTH, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """PIECE with sequence_id and offset. Ids run without gaps from 0 within each sequence."""
    spark = documents.sparkSession
    salts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = common.stored(pieces(documents, max_length, vocabulary, end_id), "pieces")
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    cut = cut.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    counts = cut.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # max_length rows at most
    table = spark.createDataFrame(slots(histogram, max_length), "length long, first long, end long, sequence long, offset long")
    # (length, salt) counts are salts rows a length, so this window stays small however hot a length is
    base = counts.withColumn("base", F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)))
    base = base.select("length", "salt", F.coalesce("base", F.lit(0)).alias("base"))
    ranked = cut.withColumn("nth", F.row_number().over(W.partitionBy("length", "salt").orderBy(*order)) - 1)
    ranked = ranked.join(base, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("nth"))
    hit = F.broadcast(table.withColumnRenamed("length", "of"))  # some thousand slots, see patterns()
    placed = ranked.join(hit, (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.read(spark, sf_dir, "documents"))
