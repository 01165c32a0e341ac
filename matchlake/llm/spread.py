"""A lookup join whose hot keys are spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# tasks a key of the left side may be spread over
SALTS = 64


def spread_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], salt_of: str, salts: int = SALTS) -> DataFrame:
    """`left` with the columns of `right` (at most one row per key), joined on `keys`, left outer.

    `salt_of` is a column of `left` that tells its rows apart in a stable way (a stored row key); a
    row's salt is its hash modulo `salts`. The (key, salt) pairs of the left side are found first,
    partially aggregated in every map task; only those pairs get the right side's row, so a key that
    a third of all rows hold meets its row in up to `salts` tasks, and a rare key costs one row. Right
    rows are copied once per salt that their key meets, never more. Null keys find nothing.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)))
    pairs = salted.select(*keys, "_salt").distinct()
    wide = pairs.join(right, list(keys))
    return salted.join(wide, [*keys, "_salt"], "left").drop("_salt")
