"""Index rows: dense and sparse vectors beside chunks, point ids, and an idempotent table partitioned by paper."""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafline.functions import ids, providers
from leafline.operators import scratch

# Public BM25 constants.
K1, B, AVERAGE_LENGTH = 1.2, 0.75, 256.0


@F.pandas_udf(T.ArrayType(T.FloatType()))
def half_precision(vectors: pd.Series) -> pd.Series:
    """Vectors rounded to 16-bit floats, held as 32-bit ones."""
    return vectors.map(lambda v: None if v is None else np.asarray(v, dtype=np.float16).astype(np.float32))


def checked(vectors: DataFrame, dim: int, col: str = "embedding") -> DataFrame:
    """vectors, failing on a length other than dim."""
    fine = F.assert_true(F.size(col) == dim, F.lit(f"vectors need {dim} components"))
    return vectors.where(fine.isNull())


def zipped(chunks: DataFrame, dense: DataFrame, sparse: DataFrame) -> DataFrame:
    """chunks, dense and sparse rows of the same (paper, position); fails where one side lacks a row."""
    j = chunks.withColumn("__c", F.lit(1)).join(dense.withColumn("__d", F.lit(1)), ["paper", "position"], "full_outer").join(sparse.withColumn("__s", F.lit(1)), ["paper", "position"], "full_outer")
    whole = F.col("__c").isNotNull() & F.col("__d").isNotNull() & F.col("__s").isNotNull()
    return j.where(F.assert_true(whole, F.lit("chunks, dense and sparse rows differ in number")).isNull()).drop("__c", "__d", "__s")


def terms(texts: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, term, n, length) of the lower-cased words of ASCII letters and digits."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z0-9]+"), F.lit(0))
    each = texts.select(id_, words.alias("w")).select(id_, F.size("w").alias("length"), F.explode("w").alias("term"))
    return each.groupBy(id_, "term").agg(F.count("*").alias("n"), F.first("length").alias("length"))


def saturated(n, length, k1: float = K1, b: float = B, average: float = AVERAGE_LENGTH):
    """The weight of a term that stands n times in a text of so many words, of columns or arrays."""
    return n * (k1 + 1) / (n + k1 * (1 - b + b * length / average))


def inverse_frequency(df: Column, total: Column) -> Column:
    return F.log(1 + (total - df + 0.5) / (df + 0.5))


def term_weights(counted: DataFrame, k1: float = K1, b: float = B, average: float = AVERAGE_LENGTH) -> DataFrame:
    """counted with weight: the saturated term frequency; inverse document frequency belongs to the query."""
    return counted.withColumn("weight", saturated(F.col("n"), F.col("length"), k1, b, average))


def sparse_vectors(counted: DataFrame, id_: str = "doc_id") -> DataFrame:
    """(id, sparse): term hashes in order and their weights."""
    w = term_weights(counted).withColumn("i", F.crc32(F.col("term").cast("binary")))
    g = w.groupBy(id_).agg(F.array_sort(F.collect_list(F.struct("i", F.col("weight").cast("float").alias("v")))).alias("x"))
    return g.select(id_, F.struct(F.transform("x", lambda r: r["i"]).alias("indices"), F.transform("x", lambda r: r["v"]).alias("values")).alias("sparse"))


def document_frequency(counted: DataFrame, id_: str = "doc_id") -> DataFrame:
    """(term, df, idf) over all documents that hold a term."""
    n = counted.agg(F.countDistinct(id_).alias("total"))
    d = counted.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n))  # the one row of the total
    return d.select("term", "df", inverse_frequency(F.col("df"), F.col("total")).alias("idf"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def payload(chunks: DataFrame) -> DataFrame:
    """chunks as JSON without nulls and vectors, the breadcrumb also as one string."""
    kept = [c for c in chunks.columns if c not in ("embedding", "sparse")]
    crumb = F.array_join("breadcrumb", " > ").alias("breadcrumb_text")
    return chunks.select("doc_id", F.to_json(F.struct(*kept, crumb), {"ignoreNullFields": "true"}).alias("payload"))


def points(zipped_rows: DataFrame) -> DataFrame:
    return zipped_rows.withColumn("point_id", ids.uuid5(F.col("doc_id")))


def embedded(chunks: DataFrame, model, dim: int, batch: int = 64) -> DataFrame:
    """chunks with embedding: model(list of texts) gives a row of dim numbers for each, `batch` texts a call; another shape fails."""

    def work(batches):
        for b in batches:
            made = [np.asarray(model(b["text"].iloc[i : i + batch].tolist()), dtype=np.float16).reshape(-1, dim) if len(b) else None for i in range(0, len(b), batch)]
            if sum(map(len, made)) != len(b):
                raise ValueError(f"the model gave {sum(map(len, made))} vectors for {len(b)} texts")
            yield b.assign(embedding=[v.astype(np.float32).tolist() for m in made for v in m])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema.fields)
    return chunks.mapInPandas(work, f"{kept}, embedding array<float>")


OUTCOME = "paper string, ok boolean, n_points long, attempts int, error string"


def tail(rows: DataFrame, write: Callable[[str, pd.DataFrame], None], kind: str = "cpu", sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """OUTCOME of write(paper, its rows) for each paper of rows(paper, ...): a paper that fails is tried again after the waits of its kind
    of call and then leaves an error, while the others are written. Outcomes are stored, so that a paper is not written
    again when they are read; write must replace what it wrote, as a task may run twice."""

    def one(paper: pd.DataFrame) -> pd.DataFrame:
        name, error = paper["paper"].iloc[0], None
        waits = providers.delays(kind)
        for n in range(len(waits) + 1):
            try:
                write(name, paper)
                return pd.DataFrame([(name, True, len(paper), n + 1, None)], columns=columns)
            except Exception as e:  # noqa: BLE001 - the error becomes data
                error = f"{type(e).__name__}: {e}"
                if n < len(waits):
                    sleep(waits[n])
        return pd.DataFrame([(name, False, 0, len(waits) + 1, error)], columns=columns)

    columns = [c.split(" ")[0] for c in OUTCOME.split(", ")]
    return scratch.stored(rows.groupBy("paper").applyInPandas(one, OUTCOME), "outcomes")


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """(total_items, success_count, failure_count); zeros without any."""
    return outcomes.agg(F.count("*").alias("total_items"), F.count_if("ok").alias("success_count"), F.count_if(~F.col("ok")).alias("failure_count"))
