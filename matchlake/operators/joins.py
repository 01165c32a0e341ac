"""Joins against dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup(facts: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join many rows to a dimension on `key` (left, left_semi or left_anti).

    The join is the same at every size, and no plan is run to find the size: Spark broadcasts a dimension
    that is below spark.sql.autoBroadcastJoinThreshold by its file sizes, or turns out to be at run time;
    else AQE splits the partition of a hot key.
    """
    return facts.join(dim, key, how)


def orphans(facts: DataFrame, teams: DataFrame) -> DataFrame:
    """Fact rows whose home team is not in the team dimension."""
    return lookup(facts, teams.select(F.col("team_id").alias("home_team_id")), "home_team_id", "left_anti").select(
        *facts.columns
    )


def orphan_count(facts: DataFrame, teams: DataFrame) -> DataFrame:
    """One row: number of orphans.

    Facts are counted per home team first, so the join sees one row per team instead of
    one per match and no fact row is shuffled.
    """
    per_team = facts.groupBy(F.col("home_team_id").alias("team_id")).agg(F.count(F.lit(1)).alias("n"))
    missing = per_team.join(teams.select("team_id"), "team_id", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans"))
