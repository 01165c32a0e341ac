"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key, and the key goes to the shard with the best one. A shard
that is added can only win keys for itself; one that goes gives away only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake.llm.columns import isolate, restore

SHARDS = 24
# slots are numbered inside this many buckets of each shard
SLOT_BUCKETS = 1024


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard number that `key` belongs to, for shards of these relative weights.

    A shard's draw is -ln(u) / weight with u uniform in (0, 1) from the hash of key and shard; the
    least wins, so a shard's share is its weight's share. u has 52 bits and is never 0 or 1. Ties go to
    the smaller shard number. A weight of 0 gives an empty shard.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12) + F.lit(0.5)) / F.lit(float(2**52))
            draws.append(F.struct((-F.ln(u) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*draws))["shard"] if len(draws) > 1 else draws[0]["shard"]


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """`docs` with shard, slot and grown_shard added.

    slot numbers a shard's rows from 0 without gaps. grown_shard is the shard under the weights
    `grown` (null without them), to see what moves.

    - Only the key decides; a null key is a key like any other. Null and empty texts count as text.
    - Rows that share a key share a shard; ties and repeated rows get different slots.
    - Extra columns are carried; columns named shard, slot or grown_shard are replaced.

    Slots need no shard in one task: rows are numbered in buckets of a shard by the hash of key and
    text, and a bucket's first slot comes from the sums over (shard, bucket), a table of bounded size.
    """
    work = isolate(docs, doc=doc_id, text=text)
    work = work.withColumn("_shard", rendezvous(F.col("_doc"), weights)).withColumn(
        "_version", F.xxhash64("_doc", "_text")
    ).withColumn("_bucket", F.pmod("_version", F.lit(SLOT_BUCKETS)).cast("int"))
    sizes = work.groupBy("_shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        F.col("_shard").alias("_of_shard"), F.col("_bucket").alias("_of_bucket"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"),
    )
    inside = Window.partitionBy("_shard", "_bucket").orderBy("_doc", "_version")
    numbered = work.withColumn("_number", F.row_number().over(inside) - 1)
    # at most shards x SLOT_BUCKETS rows of three numbers
    placed = numbered.join(
        F.broadcast(firsts),
        (F.col("_shard") == F.col("_of_shard")) & (F.col("_bucket") == F.col("_of_bucket")),
    )
    more = rendezvous(F.col("_doc"), grown) if grown else F.lit(None)
    return restore(
        placed, docs.columns, {"doc": doc_id, "text": text}, shard=F.col("_shard").cast("int"),
        slot=(F.col("_first") + F.col("_number")).cast("long"), grown_shard=more.cast("int"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    measured = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"), F.lit("key").alias("law"),
    )
    placed = assign_shards(measured, [1.0] * SHARDS, [1.0] * (SHARDS + 1), text="text_hash")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
