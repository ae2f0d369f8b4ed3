"""From raw documents to packed sequences: the training-data operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last have the columns of documents. run() writes
every stage's result to the shared folder and reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafline.llm import common, jaccard, lines, mixing, packing, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labelled ones, doesn't reject."""
    return quality.filtered(docs, quality.fit(quality.sample(docs, common.read(spark, sf_dir, "labels"))))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources repeat; n_chars follows the text."""
    return lines.cleaned(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the least doc_id."""
    return jaccard.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that sources, languages and topics meet their target shares of tokens."""
    return mixing.sampled(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold run() against the stages' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
