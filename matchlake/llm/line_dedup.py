"""Line dedup: lines that many documents share stay in one of them only.

Lines are exploded with their position and normalised, the keys are hashed, documents are counted
for each hash, and every document is put together again from the positions that stay. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.columns import LOWER, UPPER, WHITE, hash128, isolate, restore


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with shared lines dropped from the text, and n_lines and n_dropped added.

    A key of at least `min_chars` code points that at least `min_docs` documents hold loses all
    its lines except those in the largest doc_id that holds it.

    - Null or empty text: one empty line, which is never dropped; the text comes back as ''.
    - Null doc_id: all such rows count as one document, smaller than any other.
    - Rows that share a doc_id are one document for the count; each keeps its own text. Repeated
      rows come back as often as they came in.
    - Extra columns are carried; columns named n_lines or n_dropped are replaced.

    A key that a third of all rows hold adds one row per task and document to the count, which is
    split by document first, and AQE splits its partition in the join that follows. What a
    document loses is gathered by document, so no group is larger than one text.
    """
    work = isolate(docs, doc=doc_id, text=text).withColumn("_text", F.coalesce("_text", F.lit("")))
    work = work.withColumn("_version", F.xxhash64("_text"))
    lines = work.select("_doc", "_version", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    keyed = lines.select("_doc", "_version", "_pos", line_key(F.col("_line")).alias("_key"))
    first, second = hash128(F.col("_key"))
    keyed = keyed.where(F.char_length("_key") >= min_chars).select(
        "_doc", "_version", "_pos", first.alias("_h1"), second.alias("_h2")
    )
    holders = keyed.select("_h1", "_h2", "_doc").distinct()
    shared = holders.groupBy("_h1", "_h2").agg(
        F.count(F.lit(1)).alias("_docs"), F.max("_doc").alias("_keeper")
    ).where(F.col("_docs") >= min_docs).drop("_docs")
    dropped = keyed.join(shared, ["_h1", "_h2"]).where(~F.col("_doc").eqNullSafe(F.col("_keeper")))
    gone = dropped.groupBy(F.col("_doc").alias("_of"), F.col("_version").alias("_of_version")).agg(
        F.collect_set("_pos").alias("_gone")
    )
    joined = work.join(
        gone, F.col("_doc").eqNullSafe(F.col("_of")) & (F.col("_version") == F.col("_of_version")), "left"
    )
    parts = F.split("_text", "\n", -1)
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    kept = F.transform(F.array_except(every, F.col("_gone")), lambda i: F.get(parts, i))
    return restore(
        joined, docs.columns, {"doc": doc_id},
        **{text: F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))},
        n_lines=F.size(parts).cast("long"),
        n_dropped=F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_shared_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SHARED_LINES_SQL = r"""
lines AS (
    SELECT doc_id, line, pos,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {source}))
),
shared AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
kept_lines AS (
    SELECT l.doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE s.key IS NOT NULL AND l.doc_id <> s.keeper) AS n_dropped,
           coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
                    FILTER (WHERE s.key IS NULL OR l.doc_id = s.keeper), '') AS text
    FROM lines l LEFT JOIN shared s ON l.key = s.key
    GROUP BY l.doc_id
)
"""

ORACLE = (
    "WITH " + SHARED_LINES_SQL.format(source="documents")
    + "SELECT doc_id, n_lines, n_dropped, sha256(text) AS kept_sha256 FROM kept_lines"
)
