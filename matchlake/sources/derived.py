"""Match data derived from the `orders` table, for tests and benchmarks at any scale.

Only integer arithmetic on order columns is used, so any engine gives the same matches:
three leagues of twenty teams, one match per order, seasons by calendar year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import scalars
from matchlake.plans import marts

# league number -> competition code and name; order status -> match status
_LEAGUES = (("PL", "Premier League"), ("FL1", "Ligue 1"), ("PD", "La Liga"))
_STATUS = {"F": "FINISHED", "O": "SCHEDULED", "P": "IN_PLAY"}

# match ids per payload document, which bounds the document
PAGE_IDS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(key: str, choices: dict) -> Column:
    branches = " ".join(f"WHEN {value!r} THEN {outcome!r}" for value, outcome in choices.items())
    return F.expr(f"CASE {key} {branches} END")


def _team_name(team: str) -> Column:
    """Every tenth club takes another name in July 1997."""
    return F.expr(f"IF({team} % 10 = 3 AND o_orderdate >= DATE'1997-07-01', 'Club ', 'Team ') || {team}")


def staged(orders: DataFrame, finished_only: bool = False) -> DataFrame:
    """Staged matches with their competition name.

    `finished_only` filters the raw status: a predicate on the derived status would not
    reach the parquet scan.
    """
    if finished_only:
        orders = orders.where("o_orderstatus = 'F'")
    ids = orders.selectExpr(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_custkey % 3 AS league",
        "o_custkey % 3 * 20 + o_custkey % 20 AS home_id",
        "o_custkey % 3 * 20 + (o_custkey % 20 + 1 + o_orderkey % 19) % 20 AS away_id",
        "IF(o_orderstatus = 'F', floor(o_totalprice) % 5, NULL) AS home",
        "IF(o_orderstatus = 'F', floor(o_totalprice) % 7 % 4, NULL) AS away",
    )
    home, away = F.col("home"), F.col("away")
    return ids.select(
        F.expr("o_orderkey AS match_id"),
        F.expr("o_orderdate AS match_datetime"),
        _case("o_orderstatus", _STATUS).alias("status"),
        _case("league", {i: code for i, (code, _) in enumerate(_LEAGUES)}).alias("league_code"),
        _case("league", {i: name for i, (_, name) in enumerate(_LEAGUES)}).alias("competition_name"),
        F.expr("home_id AS home_team_id"),
        _team_name("home_id").alias("home_team_name"),
        F.expr("away_id AS away_team_id"),
        _team_name("away_id").alias("away_team_name"),
        F.expr("home AS full_time_home_score"),
        F.expr("away AS full_time_away_score"),
        F.expr("floor(home / 2) AS half_time_home_score"),
        F.expr("floor(away / 2) AS half_time_away_score"),
        scalars.winner_code(home, away).alias("winner"),
        scalars.match_result(home, away).alias("match_result"),
    )


def fact(orders: DataFrame, loaded_at: Column | None = None, finished_only: bool = False) -> DataFrame:
    stamp = F.lit(None).cast("timestamp_ntz") if loaded_at is None else loaded_at
    return marts.fact_columns(staged(orders, finished_only), stamp)


def nested_matches(orders: DataFrame) -> DataFrame:
    """Matches in the nested form of a payload, with a list field and a nested competition."""
    s = staged(orders)
    referee = F.struct(
        (F.col("match_id") % 7).alias("id"),
        F.when(F.col("match_id") % 3 != 0, F.concat(F.lit("Ref "), F.col("match_id") % 7)).alias("name"),
    )
    pair = lambda half: F.struct(
        F.col(f"{half}_time_home_score").alias("home"), F.col(f"{half}_time_away_score").alias("away")
    )
    return s.select(
        F.col("match_id").alias("id"),
        F.concat(scalars.iso_text(F.col("match_datetime")), F.lit("Z")).alias("utcDate"),
        "status",
        F.struct(F.col("league_code").alias("code"), F.col("competition_name").alias("name")).alias("competition"),
        F.struct(scalars.calendar_year(F.col("match_datetime")).alias("startYear")).alias("season"),
        F.struct(F.col("home_team_id").alias("id"), F.col("home_team_name").alias("name")).alias("homeTeam"),
        F.struct(F.col("away_team_id").alias("id"), F.col("away_team_name").alias("name")).alias("awayTeam"),
        F.struct(F.col("winner"), pair("full").alias("fullTime"), pair("half").alias("halfTime")).alias("score"),
        # every fifth match has an empty list, the rest one referee, some without a name
        F.when(F.col("match_id") % 5 == 0, F.slice(F.array(referee), 1, 0)).otherwise(F.array(referee)).alias("referees"),
    )


def bronze(orders: DataFrame) -> DataFrame:
    """Matches as the bronze table holds them: flat, tagged, in payload names."""
    s = staged(orders)
    return s.select(
        F.col("match_id").alias("id"),
        F.concat(scalars.iso_text(F.col("match_datetime")), F.lit("Z")).alias("utcDate"),
        "status",
        F.col("home_team_id").alias("homeTeam_id"), F.col("home_team_name").alias("homeTeam_name"),
        F.col("away_team_id").alias("awayTeam_id"), F.col("away_team_name").alias("awayTeam_name"),
        F.col("winner").alias("score_winner"),
        F.col("full_time_home_score").alias("score_fullTime_home"),
        F.col("full_time_away_score").alias("score_fullTime_away"),
        F.col("half_time_home_score").alias("score_halfTime_home"),
        F.col("half_time_away_score").alias("score_halfTime_away"),
        F.col("league_code").alias("competition_code"),
        F.year("match_datetime").alias("season_year"),
    )


def match_payloads(orders: DataFrame) -> DataFrame:
    """Payload documents `(competition_code, season_year, page, payload)`.

    A league and season is cut into pages by match id. Ids are unique, so a document holds
    at most PAGE_IDS matches however large the league is.
    """
    paged = nested_matches(orders).select(
        F.col("competition.code").alias("competition_code"),
        F.col("season.startYear").cast("int").alias("season_year"),
        F.floor(F.col("id") / PAGE_IDS).alias("page"),
        F.struct("*").alias("m"),
    )
    pages = paged.groupBy("competition_code", "season_year", "page").agg(F.collect_list("m").alias("matches"))
    return pages.select(
        "competition_code", "season_year", "page", F.struct(F.sort_array("matches").alias("matches")).alias("payload")
    )


def competitions(orders: DataFrame) -> DataFrame:
    """The leagues that occur, `(id, code, name)`, in bronze names."""
    league = (F.col("o_custkey") % 3).alias("league")
    found = orders.select(league).distinct()
    return found.select(
        (F.col("league") + 2000).alias("id"),
        _case("league", {i: code for i, (code, _) in enumerate(_LEAGUES)}).alias("code"),
        _case("league", {i: name for i, (_, name) in enumerate(_LEAGUES)}).alias("name"),
    )


def competition_payloads(orders: DataFrame) -> DataFrame:
    """One payload document per competition, each with a list of one."""
    return competitions(orders).select(
        F.struct(F.array(F.struct("id", "code", "name")).alias("competitions")).alias("payload")
    )
