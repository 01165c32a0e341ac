"""Gold models: the match fact, the team dimension, aggregates, standings and form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake import domain
from matchlake.functions import scalars
from matchlake.operators import filters, joins
from matchlake.plans import staging


def fact_columns(named: DataFrame, loaded_at: Column) -> DataFrame:
    """Fact columns of staged matches that carry their competition name."""
    home, away = F.col("full_time_home_score"), F.col("full_time_away_score")
    return named.select(
        "match_id",
        F.col("match_datetime").alias("match_date"),
        F.col("league_code").alias("competition_code"),
        "competition_name",
        "status",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        home.alias("fulltime_home_score"),
        away.alias("fulltime_away_score"),
        F.col("half_time_home_score").alias("halftime_home_score"),
        F.col("half_time_away_score").alias("halftime_away_score"),
        "winner",
        F.col("match_result").alias("match_outcome"),
        (home + away).alias("total_goals"),
        scalars.calendar_year(F.col("match_datetime")).alias("match_year"),
        loaded_at.alias("loaded_at"),
    )


def fact_matches(matches: DataFrame, competitions: DataFrame, loaded_at: Column) -> DataFrame:
    names = competitions.select(F.col("competition_code").alias("league_code"), "competition_name")
    return fact_columns(joins.lookup(matches, names, "league_code"), loaded_at)


def dim_teams(teams: DataFrame) -> DataFrame:
    return teams.select("team_id", "team_name")


def team_sides(fact: DataFrame, *carried: str) -> DataFrame:
    """Two rows per finished match, one from each team's view, from a single scan.

    `carried` names more columns of the match to keep on both.
    """
    goals_home, goals_away = F.col("fulltime_home_score"), F.col("fulltime_away_score")
    played = filters.finished(fact)

    def side(team: str, scored: Column, conceded: Column, at_home: bool) -> Column:
        return F.struct(
            F.col(f"{team}_team_id").alias("team_id"),
            F.col(f"{team}_team_name").alias("team_name"),
            scored.alias("scored"),
            conceded.alias("conceded"),
            F.lit(at_home).alias("at_home"),
        )

    return played.select(
        "match_id", "match_date", "competition_code", *carried,
        F.inline(F.array(side("home", goals_home, goals_away, True), side("away", goals_away, goals_home, False))),
    )


def _won() -> Column:
    return F.col("scored") > F.col("conceded")


def _drew() -> Column:
    return F.col("scored") == F.col("conceded")


def _lost() -> Column:
    return F.col("scored") < F.col("conceded")


def _tallies() -> dict[str, Column]:
    """Counts and sums only: every buffer is a long, so both aggregation steps hash."""
    return {
        "total_matches": F.count(F.lit(1)),
        "total_wins": F.count_if(_won()),
        "total_draws": F.count_if(_drew()),
        "total_losses": F.count_if(_lost()),
        "total_goals_scored": F.coalesce(F.sum("scored"), F.lit(0)),
        "total_goals_conceded": F.coalesce(F.sum("conceded"), F.lit(0)),
        "home_wins": F.count_if(_won() & F.col("at_home")),
        "away_wins": F.count_if(_won() & ~F.col("at_home")),
        "home_matches": F.count_if(F.col("at_home")),
        "away_matches": F.count_if(~F.col("at_home")),
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in columns.items()]


def _points() -> Column:
    return F.col("total_wins") * domain.POINTS_WIN + F.col("total_draws") * domain.POINTS_DRAW


def team_tallies(fact: DataFrame) -> DataFrame:
    """One row per competition, team id and spelling of its name, with the time it was last used.

    Both team tables fold these rows, so a job that builds both scans the fact once. The
    name is a grouping key, which keeps strings out of the large aggregate's buffers.
    """
    dated = fact.withColumn("_recency", staging.recency("match_date", "match_id"))
    sides = team_sides(dated, "_recency")
    keys = ("competition_code", "team_id", "team_name")
    return sides.groupBy(*keys).agg(*_named(_tallies()), F.max("_recency").alias("recency"))


def _performance(tallies: DataFrame) -> DataFrame:
    scored = tallies.withColumns({
        "goal_difference": F.col("total_goals_scored") - F.col("total_goals_conceded"),
        "total_points": _points(),
    })
    return scored.select(
        "competition_code", *domain.STANDINGS_COLUMNS[:-2],
        scalars.percentage(F.col("total_wins"), F.col("total_matches")).alias("win_percentage"),
        scalars.ratio(F.col("total_points"), F.col("total_matches")).alias("points_per_match"),
        "home_wins", "away_wins", "home_matches", "away_matches",
    )


def agg_team_performance(fact: DataFrame) -> DataFrame:
    """One row per competition and team id over all seasons, under the team's latest name there."""
    return performance_from_tallies(team_tallies(fact))


def performance_from_tallies(tallies: DataFrame) -> DataFrame:
    """agg_team_performance from team_tallies: a renamed team's spellings fold into one row."""
    sums = [F.sum(c).alias(c) for c in _tallies()]
    teams = tallies.groupBy("competition_code", "team_id").agg(F.max_by("team_name", "recency").alias("team_name"), *sums)
    return _performance(teams)


def _outcome_share(outcome: str) -> Column:
    return scalars.percentage(F.count_if(F.col("match_outcome") == outcome), F.count(F.lit(1)))


def agg_competition_stats(fact: DataFrame) -> DataFrame:
    """One row per calendar year and competition, over finished matches."""
    matches = F.count(F.lit(1))
    goals = F.coalesce(F.sum("total_goals"), F.lit(0))
    return filters.finished(fact).groupBy("match_year", "competition_code", "competition_name").agg(
        matches.alias("total_matches"),
        goals.alias("total_goals"),
        scalars.ratio(goals, matches).alias("avg_goals_per_match"),
        _outcome_share(domain.HOME_WIN).alias("home_win_percentage"),
        _outcome_share(domain.AWAY_WIN).alias("away_win_percentage"),
        _outcome_share(domain.DRAW).alias("draw_percentage"),
        scalars.percentage(F.count_if(F.col("total_goals") > domain.HIGH_SCORING_OVER), matches).alias(
            "high_scoring_percentage"
        ),
    )


def mart_team_stats(tallies: DataFrame) -> DataFrame:
    """One row per team and league from team_tallies, under the team's latest name there."""
    sums = [F.sum(c).alias(c) for c in ("total_matches", "total_wins", "total_draws", "total_losses")]
    teams = tallies.groupBy("team_id", F.col("competition_code").alias("league_code")).agg(
        F.max_by("team_name", "recency").alias("team_name"), *sums
    )
    return teams.select(
        "team_id", "team_name", "league_code", "total_matches", "total_wins", "total_draws", "total_losses",
        _points().alias("total_points"),
        scalars.percentage(F.col("total_wins"), F.col("total_matches")).alias("win_rate"),
    )


def mart_league_standings(performance: DataFrame) -> DataFrame:
    """Teams ranked in their league by points, goal difference and goals; equal teams share a rank.

    The input is agg_team_performance, so the window sorts one row per club of a league, never matches.
    """
    order = [F.col(c).desc() for c in ("total_points", "goal_difference", "total_goals_scored")]
    return performance.select(
        F.col("competition_code").alias("league_code"),
        F.rank().over(Window.partitionBy("competition_code").orderBy(*order)).cast("bigint").alias("team_rank"),
        "team_name", "total_points", "goal_difference", "total_goals_scored",
    )


def mart_match_overview(stats: DataFrame) -> DataFrame:
    """One row per league, folded from agg_competition_stats rather than from the matches."""
    matches, goals = F.sum("total_matches"), F.sum("total_goals")
    return stats.groupBy(F.col("competition_code").alias("league_code")).agg(
        matches.alias("total_matches"), scalars.ratio(goals, matches).alias("avg_goals_per_match")
    )


def mart_team_form(fact: DataFrame, last: int = 5) -> DataFrame:
    """Points and W/D/L string (newest first) of each team's last finished matches.

    The rank filter sits right on the window, so each task drops all but its own latest few
    rows per team before the shuffle; a team with very many matches sends few.
    """
    latest = Window.partitionBy("team_id").orderBy(F.col("match_date").desc(), F.col("match_id").desc())
    recent = team_sides(fact).withColumn("rn", F.row_number().over(latest)).where(F.col("rn") <= last)
    points = F.when(_won(), domain.POINTS_WIN).when(_drew(), domain.POINTS_DRAW).otherwise(domain.POINTS_LOSS)
    letter = F.when(_won(), "W").when(_drew(), "D").when(_lost(), "L").otherwise("")
    games = F.array_sort(F.collect_list(F.struct("rn", letter.alias("letter"))))
    return recent.groupBy("team_id").agg(
        F.max_by("team_name", -F.col("rn")).alias("team_name"),
        F.sum(points).alias("last_5_points"),
        F.array_join(F.transform(games, lambda g: g["letter"]), "").alias("current_form"),
    )
