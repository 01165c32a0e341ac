"""Silver models: typed, renamed and deduplicated bronze rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from matchlake import domain
from matchlake.functions import scalars


def stg_matches(bronze: DataFrame) -> DataFrame:
    """One row per match in a staged status, in contract names and types."""
    home, away = F.col("score_fullTime_home").cast("bigint"), F.col("score_fullTime_away").cast("bigint")
    kept = bronze.where(F.col("status").isin(*domain.STAGED_STATUSES))
    return kept.select(
        F.col("id").cast("bigint").alias("match_id"),
        scalars.iso_timestamp(F.col("utcDate")).alias("match_datetime"),
        "status",
        F.col("competition_code").alias("league_code"),
        F.col("homeTeam_id").cast("bigint").alias("home_team_id"),
        F.col("homeTeam_name").alias("home_team_name"),
        F.col("awayTeam_id").cast("bigint").alias("away_team_id"),
        F.col("awayTeam_name").alias("away_team_name"),
        home.alias("full_time_home_score"),
        away.alias("full_time_away_score"),
        F.col("score_halfTime_home").cast("bigint").alias("half_time_home_score"),
        F.col("score_halfTime_away").cast("bigint").alias("half_time_away_score"),
        F.col("score_winner").alias("winner"),
        scalars.match_result(home, away).alias("match_result"),
    )


def newest_matches(bronze: DataFrame) -> DataFrame:
    """One row per match id: the copy extracted last; of copies extracted together the later kick-off, then
    the row that comes last by its text, so that repeats of a drop give one result.

    Each task keeps one row per id before the shuffle. Rows without an id are no copies and all stay.
    """
    whole = F.to_json(F.struct(*[c for c in bronze.columns if c != "extracted_at"]))
    stamp = F.col("extracted_at") if "extracted_at" in bronze.columns else F.lit(None)
    latest = Window.partitionBy("id").orderBy(stamp.desc_nulls_last(), F.col("utcDate").desc_nulls_last(), whole.desc())
    ranked = bronze.where(F.col("id").isNotNull()).withColumn("_nth", F.row_number().over(latest))
    once = ranked.where(F.col("_nth") == 1).drop("_nth")
    return once.unionByName(bronze.where(F.col("id").isNull()))


def stg_competitions(bronze: DataFrame) -> DataFrame:
    """One row per competition code: of repeated documents the one with the largest id, then name."""
    typed = bronze.select(
        F.col("id").cast("bigint").alias("competition_id"),
        F.col("code").alias("competition_code"),
        F.col("name").alias("competition_name"),
    )
    newest = typed.groupBy("competition_code").agg(F.max(F.struct("competition_id", "competition_name")).alias("_newest"))
    return newest.select("_newest.competition_id", "competition_code", "_newest.competition_name")


def _micros(when: str) -> Column:
    """Microseconds of the wall clock since 1970. A cast to an instant would go through the session's
    zone, where a clock change can swap two times."""
    day, second = f"unix_date(CAST({when} AS DATE)) * 86400L", f"hour({when}) * 3600L + minute({when}) * 60L"
    return F.expr(f"({day} + {second}) * 1000000L + CAST(extract(SECOND FROM {when}) * 1000000 AS BIGINT)")


def recency(when: str, match_id: str) -> Column:
    """The columns (time, id) as one decimal that sorts the same way.

    A struct would sort the same, but a struct or string in an aggregation buffer makes Spark
    sort every row; a decimal keeps the hash aggregate. Microseconds are below 10^18 in size and
    an id shifted by 2^63 is below 2^64, so 38 digits hold both.
    """
    micros = F.coalesce(_micros(when), F.lit(-(10**17)))
    shifted = F.col(match_id).cast("decimal(20,0)") + F.lit(Decimal(2**63)).cast("decimal(20,0)")
    scaled = micros.cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19))
    return (scaled + shifted).cast("decimal(38,0)")


def team_names(matches: DataFrame, when: str = "match_datetime") -> DataFrame:
    """`(team_id, team_name, recency)` for both sides of each match, from one scan."""
    seen = matches.withColumn("_recency", recency(when, "match_id"))

    def side(which: str) -> Column:
        return F.struct(
            F.col(f"{which}_team_id").alias("team_id"),
            F.col(f"{which}_team_name").alias("team_name"),
            F.col("_recency").alias("recency"),
        )

    return seen.select(F.inline(F.array(side("home"), side("away"))))


def stg_teams(matches: DataFrame, when: str = "match_datetime") -> DataFrame:
    """One row per team id, under the name its latest match used.

    Matches shrink to one row per id and name before the shuffle; only those few
    are compared for the latest name.
    """
    named = team_names(matches, when).where(F.col("team_id").isNotNull())
    spellings = named.groupBy("team_id", "team_name").agg(F.max("recency").alias("recency"))
    return spellings.groupBy("team_id").agg(F.max_by("team_name", "recency").alias("team_name"))
