"""Filter interaction audit over failing-id relations.

Each filter's verdict is stored once as a relation of the ids of the rows it fails. The survivors of
a set of filters are the rows left after a left-anti join with each of those relations; every prefix
of every order of the filters is such a set, so the 32 sets give all 120 orders. Per part, a set's
survivors are counted with their quality and toxic labels; removals, redundancies (rows of the
filter that an earlier one took, its left-semi join with them) and label losses of a step are
differences of two survivor counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.columns import hash128, settle
from matchlake.llm.spread import spread_lookup

# fixed values of the five filters
LETTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SYMBOLS = "[#$%&*|]"
WORD = "[^\\x20\\x09-\\x0D]+"
ALL = (1 << len(LETTERS)) - 1


def failures(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """One row per input row: `_key` (stable row key), `_part`, `_good`, `_toxic` and a boolean per filter.

    - Null text counts as empty: it has no words, so A fails it and B, C, D do not.
    - Words are maximal runs of characters outside ASCII white space, case-sensitive.
    - E fails a row whose text (null as empty) equals that of a row with a smaller doc_id. A null
      doc_id is smaller than none and larger than none: such a row never fails E and makes no other
      row fail it. Repeated rows (same doc_id and text) are separate documents and do not fail E by
      each other.
    - `_part` is the lang value, null as ''. Labels count by doc_id: good when any label row of
      the doc_id has quality 1, toxic when any has toxic 1; rows without a label are neither.
    - Other input columns are not looked at, whatever their names.

    The result is written to the shared folder, so that keys stay the same whatever task is run again.
    """
    work = docs.select(
        F.col(doc_id).cast("long").alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("_part"),
    ).withColumn("_key", F.monotonically_increasing_id())
    words = F.regexp_extract_all("_text", F.lit(WORD), F.lit(0))
    upper = F.char_length("_text") - F.char_length(F.regexp_replace("_text", "[A-Z]", ""))
    first, second = hash128(F.col("_text"))
    base = settle(work.select(
        "_key", "_doc", "_part",
        F.size(words).alias("_words"), F.size(F.array_distinct(words)).alias("_distinct"),
        upper.alias("_upper"), F.char_length("_text").alias("_chars"),
        F.col("_text").rlike(SYMBOLS).alias("D"),
        first.alias("_h1"), second.alias("_h2"), F.char_length("_text").alias("_len"),
    ))
    least = base.groupBy("_h1", "_h2", "_len").agg(F.min("_doc").alias("_least"))
    base = spread_lookup(base, least, ["_h1", "_h2", "_len"], "_key")
    if labels is not None:
        marks = labels.groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"),
        )
        base = spread_lookup(base, marks, ["_doc"], "_key")
    else:
        base = base.withColumn("_good", F.lit(None).cast("boolean")).withColumn("_toxic", F.lit(None).cast("boolean"))
    return base.select(
        "_key", "_part",
        F.coalesce("_good", F.lit(False)).alias("_good"), F.coalesce("_toxic", F.lit(False)).alias("_toxic"),
        (F.col("_words") < MIN_WORDS).alias("A"),
        (100 * F.col("_distinct") < MIN_DISTINCT_PERCENT * F.col("_words")).alias("B"),
        (100 * F.col("_upper") > MAX_UPPER_PERCENT * F.col("_chars")).alias("C"),
        "D",
        F.coalesce(F.col("_doc") > F.col("_least"), F.lit(False)).alias("E"),
    )


def survivors(rows: DataFrame) -> DataFrame:
    """(_part, _set, _n, _good_n, _toxic_n): rows left after the filters of each bit set, by anti joins.

    Every part has all 32 sets; a set whose survivors hold none of a part's rows counts zeros there.
    """
    rows = settle(rows)
    failing = {f: rows.where(F.col(f)).select("_key") for f in LETTERS}
    kept = rows.select("_key", "_part", "_good", "_toxic")
    counted = []
    for mask in range(ALL + 1):
        left = kept
        for bit, f in enumerate(LETTERS):
            if mask >> bit & 1:
                left = left.join(failing[f], "_key", "left_anti")
        counted.append(left.groupBy("_part").agg(
            F.count(F.lit(1)).alias("_n"), F.count_if("_good").alias("_good_n"), F.count_if("_toxic").alias("_toxic_n"),
        ).withColumn("_set", F.lit(mask)))
    counts = counted[0]
    for more in counted[1:]:
        counts = counts.unionByName(more)
    grid = kept.select("_part").distinct().select("_part", F.explode(F.sequence(F.lit(0), F.lit(ALL))).alias("_set"))
    return grid.join(counts, ["_part", "_set"], "left").select(
        "_part", "_set", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("_n", "_good_n", "_toxic_n")]
    )


def steps(spark: SparkSession) -> DataFrame:
    """The 600 steps: filter_order, step, letter, and the bit sets before and after it."""
    rows = []
    for order in map("".join, permutations(LETTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            rows.append((order, step, letter, before, before | bit, bit))
            before |= bit
    return spark.createDataFrame(rows, "filter_order string, step int, _letter string, _before int, _after int, _bit int")


def audit(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> DataFrame:
    """One row per part, filter order and step, zeros included; see the module and `failures`.

    Columns: part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley (the step's filter's removals summed over all 120 orders). An empty table
    has no parts and gives no rows.
    """
    counts = settle(survivors(failures(docs, labels, doc_id, text, lang)))
    table = steps(docs.sparkSession)

    def at(column: str, name: str) -> DataFrame:
        return counts.select("_part", F.col("_set").alias(column), *[F.col(c).alias(f"{name}{c}") for c in ("_n", "_good_n", "_toxic_n")])

    joined = (
        table.join(at("_before", "_b"), "_before")
        .join(at("_after", "_a"), ["_part", "_after"])
        .join(at("_bit", "_f"), ["_part", "_bit"])
        .join(counts.where(F.col("_set") == 0).select("_part", F.col("_n").alias("_all")), "_part")
        .withColumn("_others", F.lit(ALL) - F.col("_bit"))
        .join(at("_others", "_o"), ["_part", "_others"])
        .join(counts.where(F.col("_set") == ALL).select("_part", F.col("_n").alias("_none")), "_part")
    )
    removed = F.col("_b_n") - F.col("_a_n")
    result = joined.select(
        F.col("_part").alias("part"), "filter_order", "step", F.col("_letter").alias("filter"),
        F.col("_a_n").alias("kept"), removed.alias("removed"),
        (F.col("_all") - F.col("_f_n") - removed).alias("redundant"),
        (F.col("_o_n") - F.col("_none")).alias("unique_fails"),
        (F.col("_b_good_n") - F.col("_a_good_n")).alias("good_lost"),
        (F.col("_b_toxic_n") - F.col("_a_toxic_n")).alias("toxic_lost"),
    )
    shapley = result.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return result.join(shapley, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        F.col("shapley").cast("long").alias("shapley"), "filter",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(docs, labels).drop("filter")


ORACLE = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT doc_id, part, t,
           len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n_words,
           len(list_distinct(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))) AS n_distinct,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
           length(t) AS n_chars
    FROM d
), lowest AS (
    SELECT t, min(doc_id) AS lowest_id FROM d GROUP BY t
), lab AS (
    SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS tox
    FROM labels GROUP BY doc_id
), masked AS (
    SELECT w.part,
           (CASE WHEN n_words < 200 THEN 1 ELSE 0 END)
           + (CASE WHEN 100 * n_distinct < 50 * n_words THEN 2 ELSE 0 END)
           + (CASE WHEN 100 * n_upper > 3 * n_chars THEN 4 ELSE 0 END)
           + (CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END)
           + (CASE WHEN coalesce(w.doc_id > lowest.lowest_id, false) THEN 16 ELSE 0 END) AS mask,
           coalesce(lab.good, false) AS good, coalesce(lab.tox, false) AS tox
    FROM w JOIN lowest ON w.t = lowest.t LEFT JOIN lab ON w.doc_id = lab.doc_id
), hist AS (
    SELECT part, mask, good, tox, count(*) AS n FROM masked GROUP BY ALL
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, bit)
), orders AS (
    SELECT l1.letter || l2.letter || l3.letter || l4.letter || l5.letter AS filter_order,
           l1.bit AS b1, l2.bit AS b2, l3.bit AS b3, l4.bit AS b4, l5.bit AS b5,
           l1.letter AS c1, l2.letter AS c2, l3.letter AS c3, l4.letter AS c4, l5.letter AS c5
    FROM letters l1, letters l2, letters l3, letters l4, letters l5
    WHERE l1.bit + l2.bit + l3.bit + l4.bit + l5.bit = 31
      AND l1.bit <> l2.bit AND l1.bit <> l3.bit AND l1.bit <> l4.bit AND l1.bit <> l5.bit
      AND l2.bit <> l3.bit AND l2.bit <> l4.bit AND l2.bit <> l5.bit
      AND l3.bit <> l4.bit AND l3.bit <> l5.bit AND l4.bit <> l5.bit
), steps AS (
    SELECT filter_order, 1 AS step, c1 AS letter, b1 AS bit, 0 AS before FROM orders
    UNION ALL SELECT filter_order, 2, c2, b2, b1 FROM orders
    UNION ALL SELECT filter_order, 3, c3, b3, b1 + b2 FROM orders
    UNION ALL SELECT filter_order, 4, c4, b4, b1 + b2 + b3 FROM orders
    UNION ALL SELECT filter_order, 5, c5, b5, b1 + b2 + b3 + b4 FROM orders
), parts AS (
    SELECT DISTINCT part FROM d
), rows AS (
    SELECT p.part, s.filter_order, s.step, s.letter,
           coalesce(sum(h.n) FILTER (WHERE (h.mask & (s.before | s.bit)) = 0), 0) AS kept,
           coalesce(sum(h.n) FILTER (WHERE (h.mask & s.bit) <> 0 AND (h.mask & s.before) = 0), 0) AS removed,
           coalesce(sum(h.n) FILTER (WHERE (h.mask & s.bit) <> 0 AND (h.mask & s.before) <> 0), 0) AS redundant,
           coalesce(sum(h.n) FILTER (WHERE h.mask = s.bit), 0) AS unique_fails,
           coalesce(sum(h.n) FILTER (WHERE (h.mask & s.bit) <> 0 AND (h.mask & s.before) = 0 AND h.good), 0) AS good_lost,
           coalesce(sum(h.n) FILTER (WHERE (h.mask & s.bit) <> 0 AND (h.mask & s.before) = 0 AND h.tox), 0) AS toxic_lost
    FROM parts p CROSS JOIN steps s LEFT JOIN hist h ON h.part = p.part
    GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM rows
"""
