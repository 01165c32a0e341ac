"""The tables behind the report pages: ordered lists, top-k, key figures and reshaped series.

Filters are applied before anything is aggregated or collected; top-k orders always end in a
unique column, so results repeat. NULL places are spelled out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake import domain
from matchlake.functions import scalars
from matchlake.operators import filters
from matchlake.operators.sets import concat


def _table_order() -> list[Column]:
    """The order team tables are shown in."""
    best = [F.col(c).desc_nulls_first() for c in ("total_points", "goal_difference")]
    return best + [F.col(c).asc_nulls_last() for c in ("team_name", "competition_code")]


def _newest() -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in ("match_date", "match_id")]


# -- ordered tables and top-k ---------------------------------------------------------------

def competition_table(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.col("match_year").desc_nulls_first(), F.col("competition_code").asc_nulls_last())


def performance_table(performance: DataFrame) -> DataFrame:
    return performance.orderBy(*_table_order())


def recent_matches(fact: DataFrame, n: int = 20) -> DataFrame:
    return fact.orderBy(*_newest()).limit(n).select(*domain.RECENT_COLUMNS)


def first_and_last(bronze: DataFrame, n: int = 3) -> DataFrame:
    """The earliest and latest matches by their time text, tagged `first` or `last`."""
    columns = ["utcDate", "homeTeam_name", "awayTeam_name"]

    def end(which: str, *order: Column) -> DataFrame:
        return bronze.orderBy(*order).limit(n).select(F.lit(which).alias("which"), *columns)

    time, key = F.col("utcDate"), F.col("id")
    return end("first", time.asc_nulls_last(), key.asc_nulls_last()).unionAll(
        end("last", time.desc_nulls_first(), key.desc_nulls_first())
    )


def top_teams(team_stats: DataFrame, n: int = 5) -> DataFrame:
    order = (F.col("total_points").desc_nulls_first(), F.col("team_name"), F.col("team_id"), F.col("league_code"))
    return team_stats.orderBy(*order).limit(n).select(
        "team_name", "league_code", "total_matches", "total_wins", "total_draws", "total_losses", "total_points"
    )


def _leaders(performance: DataFrame, code: str, measure: str, order: Column, n: int) -> DataFrame:
    rows = filters.exact(performance, "competition_code", code)
    return rows.orderBy(order, *_table_order()).limit(n).select("team_name", measure)


def most_points(performance: DataFrame, code: str, n: int = 5) -> DataFrame:
    return _leaders(performance, code, "total_points", F.col("total_points").desc(), n)


def most_goals(performance: DataFrame, code: str, n: int = 5) -> DataFrame:
    return _leaders(performance, code, "total_goals_scored", F.col("total_goals_scored").desc(), n)


def best_defense(performance: DataFrame, code: str, n: int = 5) -> DataFrame:
    return _leaders(performance, code, "total_goals_conceded", F.col("total_goals_conceded").asc(), n)


def standings_chart(performance: DataFrame, code: str, n: int = 20) -> DataFrame:
    rows = filters.exact(performance, "competition_code", code)
    return rows.orderBy(*_table_order()).limit(n).select("team_name", "total_points", "goal_difference")


def league_table(performance: DataFrame, code: str) -> DataFrame:
    rows = filters.exact(performance, "competition_code", code)
    return rows.select("team_name", "total_points", "goal_difference").orderBy(
        F.col("total_points").desc_nulls_first(), F.col("team_name")
    )


def sample_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """A few rows to look at; ordered by a key so that they are the same each time."""
    return df.orderBy(key).limit(n)


# -- one team -------------------------------------------------------------------------------

def team_row(performance: DataFrame, team: str) -> DataFrame:
    """The first row of a team in table order."""
    return filters.exact(performance, "team_name", team).orderBy(*_table_order()).limit(1)


def team_overview(performance: DataFrame, team: str) -> DataFrame:
    return team_row(performance, team).select(
        "total_matches", "total_points", F.round("win_percentage", 1).alias("win_rate"),
        "total_goals_scored", "goal_difference",
    )


def team_matches(fact: DataFrame, team: str) -> DataFrame:
    """All matches of a team with its own result, newest first."""
    rows = filters.team_either_side(fact, team)
    return rows.orderBy(*_newest()).select(*domain.RECENT_COLUMNS, scalars.team_result(team).alias("result"))


def team_recent(fact: DataFrame, team: str, n: int = 20) -> DataFrame:
    rows = filters.team_either_side(fact, team).orderBy(*_newest()).limit(n)
    score = scalars.score_label(F.col("fulltime_home_score"), F.col("fulltime_away_score"))
    return rows.select(
        "match_date", "competition_name", "home_team_name", "away_team_name",
        score.alias("score"), scalars.team_result(team).alias("result"),
    )


def form_counts(fact: DataFrame, team: str, n: int = 10) -> DataFrame:
    """How often each result occurs in a team's latest matches."""
    latest = filters.team_either_side(fact, team).orderBy(*_newest()).limit(n)
    counted = latest.groupBy(scalars.team_result(team).alias("result")).agg(F.count(F.lit(1)).alias("matches"))
    return counted.orderBy(F.col("matches").desc(), "result")


def results_of_team(performance: DataFrame, team: str) -> DataFrame:
    """Wins, draws and losses of a team as rows."""
    counts = team_row(performance, team).select(
        F.col("total_wins").alias("Wins"), F.col("total_draws").alias("Draws"), F.col("total_losses").alias("Losses")
    )
    return counts.unpivot([], ["Wins", "Draws", "Losses"], "result", "matches")


def venues_of_team(performance: DataFrame, team: str) -> DataFrame:
    """Wins and matches of a team at home and away as rows."""

    def venue(name: str) -> Column:
        wins, matches = F.col(f"{name.lower()}_wins"), F.col(f"{name.lower()}_matches")
        return F.struct(F.lit(name).alias("venue"), wins.alias("wins"), matches.alias("matches"))

    return team_row(performance, team).select(F.inline(F.array(venue("Home"), venue("Away"))))


# -- competitions ---------------------------------------------------------------------------

def recent_display(fact: DataFrame, n: int = 10) -> DataFrame:
    label = scalars.match_label(
        F.col("home_team_name"), F.col("fulltime_home_score"), F.col("fulltime_away_score"), F.col("away_team_name")
    )
    return recent_matches(fact, n).select("match_date", "competition_name", label.alias("match"), "match_outcome")


def standings_display(performance: DataFrame, code: str) -> DataFrame:
    rows = filters.exact(performance, "competition_code", code)
    return rows.orderBy(*_table_order()).select(*domain.STANDINGS_COLUMNS)


def key_figures(
    stats: DataFrame, performance: DataFrame, year: int | None = None, label: str | None = None
) -> DataFrame:
    """One row of key figures. The goal average is the plain mean of the group averages, and the
    team count follows the competition filter only, as the report page does."""
    chosen = filters.competition(filters.year(stats, year), label)
    figures = chosen.agg(
        F.coalesce(F.sum("total_matches"), F.lit(0)).alias("total_matches"),
        F.coalesce(F.sum("total_goals"), F.lit(0)).alias("total_goals"),
        F.round(F.avg("avg_goals_per_match"), 2).alias("avg_goals"),
    )
    teams = filters.competition(performance, label).agg(F.count(F.lit(1)).alias("total_teams"))
    return side_by_side(figures, teams)


def competition_figures(stats: DataFrame, name: str, year: int | None = None) -> DataFrame:
    """Key figures of one competition."""
    chosen = filters.exact(filters.year(stats, year), "competition_name", name)
    return chosen.agg(
        F.coalesce(F.sum("total_matches"), F.lit(0)).alias("total_matches"),
        F.coalesce(F.sum("total_goals"), F.lit(0)).alias("total_goals"),
        F.round(F.avg("avg_goals_per_match"), 2).alias("avg_goals"),
    )


def matches_by_competition(stats: DataFrame) -> DataFrame:
    return stats.groupBy("competition_name").agg(F.sum("total_matches").alias("total_matches"))


def goals_trend(stats: DataFrame, name: str) -> DataFrame:
    chosen = filters.exact(stats, "competition_name", name)
    return chosen.select("match_year", "avg_goals_per_match").orderBy("match_year")


def high_scoring(stats: DataFrame, year: int | None = None, label: str | None = None) -> DataFrame:
    chosen = filters.competition(filters.year(stats, year), label)
    return chosen.select("competition_name", "match_year", "high_scoring_percentage")


def outcome_series(stats: DataFrame, name: str) -> DataFrame:
    """Home, away and draw percentages of a competition as three series."""
    chosen = filters.exact(stats, "competition_name", name).select(
        "match_year",
        F.col("home_win_percentage").alias("Home Wins"),
        F.col("away_win_percentage").alias("Away Wins"),
        F.col("draw_percentage").alias("Draws"),
    )
    return chosen.unpivot(["match_year"], ["Home Wins", "Away Wins", "Draws"], "outcome", "percentage")


def outcome_means(stats: DataFrame) -> DataFrame:
    shares = ("home_win_percentage", "away_win_percentage", "draw_percentage")
    return stats.groupBy("competition_name").agg(*[F.round(F.avg(c), 2).alias(c) for c in shares])


def goal_distribution(stats: DataFrame) -> DataFrame:
    """Five-number summary of the yearly goal averages of each competition."""
    cuts = F.percentile("avg_goals_per_match", F.array(*[F.lit(q) for q in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    summary = stats.groupBy("competition_name").agg(cuts.alias("cuts"))
    names = ("lowest", "lower_quartile", "median", "upper_quartile", "highest")
    return summary.select("competition_name", *[F.round(F.col("cuts")[i], 4).alias(n) for i, n in enumerate(names)])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


# -- whole-table facts ----------------------------------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def date_range(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.min("utcDate").alias("first_match"), F.max("utcDate").alias("last_match"))


def matches_by_year(bronze: DataFrame) -> DataFrame:
    year = scalars.calendar_year(scalars.iso_timestamp(F.col("utcDate")))
    return bronze.groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("matches")).orderBy("year")


def key_profile(df: DataFrame, *key: str, **folded: tuple[Callable[[str], Column], str]) -> DataFrame:
    """One row about a table and its key, from one shuffle of the key.

    Gives row_count, unique_keys (no part NULL), repeated_values (unique_keys that occur more
    than once) and repeated_keys (NULL keys too). `folded` adds columns: an aggregate that can be
    applied twice, such as sum or max, and the column it folds.
    """
    extra = [fold(column).alias(name) for name, (fold, column) in folded.items()]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), *extra)
    whole = F.lit(True)
    for part in key:
        whole = whole & F.col(part).isNotNull()
    repeats = F.col("_rows") > 1
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.count_if(whole).alias("unique_keys"),
        F.count_if(whole & repeats).alias("repeated_values"),
        F.count_if(repeats).alias("repeated_keys"),
        *[fold(name).alias(name) for name, (fold, _) in folded.items()],
    )


def table_stats(df: DataFrame, *key: str) -> DataFrame:
    """Rows and distinct non-null keys of a table."""
    return key_profile(df, *key).select("row_count", "unique_keys")


def key_metrics(fact: DataFrame) -> DataFrame:
    """Distinct matches, distinct home teams and goals.

    Two distinct counts in one aggregate make Spark write every row once per count. Here the
    goals and matches share one pass over the match ids, and the home teams are a second
    scan of one column that shrinks to a row per team.
    """
    profile = key_profile(fact, "match_id", total_goals=(F.sum, "total_goals"))
    matches = profile.select(F.col("unique_keys").alias("total_matches"), "total_goals")
    return side_by_side(matches, home_teams(fact)).select("total_matches", "unique_teams", "total_goals")


def home_teams(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_distinct("home_team_id").alias("unique_teams"))


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row."""
    stacked = concat(one_row_frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def freshness(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("loaded_at").alias("last_load"))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, NULL among them, with their row counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
