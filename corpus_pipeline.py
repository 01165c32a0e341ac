"""The corpus pipeline: quality rules, line dedup, near copies, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; the stage's result is
written as Parquet and read again as the next one's docs. No SQL can express the stages
that measure tokens, so ORACLE_SQL is None; the tests hold run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import decontaminate, fertility, line_dedup, near_copies, packing
from matchlake.session import new_scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    import public_tokenizers

    return fertility.keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    return line_dedup.drop_shared_lines(docs).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("quality rules", quality_rules), ("line dedup", shared_lines), ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
