"""Column expressions shared by staging, marts and reports. All stay inside codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchlake import domain


def iso_timestamp(text: Column) -> Column:
    """ISO text to a zone-less timestamp; the wall clock is kept, bad text gives NULL."""
    return text.try_cast("timestamp_ntz")


def wall_clock(ts: dt.datetime) -> Column:
    """A naive Python time as a zone-less constant; a datetime literal would pass through two zones."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def calendar_year(ts: Column) -> Column:
    return F.year(ts).cast("bigint")


def match_result(home: Column, away: Column) -> Column:
    return (
        F.when(home > away, domain.HOME_WIN)
        .when(home < away, domain.AWAY_WIN)
        .when(home == away, domain.DRAW)
        .otherwise(domain.UNKNOWN)
    )


def winner_code(home: Column, away: Column) -> Column:
    return (
        F.when(home > away, domain.WINNER_HOME)
        .when(home < away, domain.WINNER_AWAY)
        .when(home == away, domain.WINNER_DRAW)
    )


def team_result(team: str) -> Column:
    """Result as `team` saw it. A match without a winner counts as a loss, as the reports expect."""
    name = F.lit(team)
    won_at_home = (F.col("home_team_name") == name) & (F.col("winner") == domain.WINNER_HOME)
    won_away = (F.col("away_team_name") == name) & (F.col("winner") == domain.WINNER_AWAY)
    return (
        F.when(won_at_home | won_away, "Win")
        .when(F.col("winner") == domain.WINNER_DRAW, "Draw")
        .otherwise("Loss")
    )


def _score_text(score: Column) -> Column:
    return F.coalesce(score.cast("string"), F.lit("nan"))


def score_label(home: Column, away: Column) -> Column:
    """`2 - 1`; a missing score shows as `nan`."""
    return F.concat(_score_text(home), F.lit(" - "), _score_text(away))


def match_label(home_name: Column, home: Column, away: Column, away_name: Column) -> Column:
    """`Home 2 - 1 Away`."""
    return F.concat(home_name, F.lit(" "), score_label(home, away), F.lit(" "), away_name)


def code_of_label(label: Column) -> Column:
    """The competition code in front of `PL - Premier League`."""
    return F.split_part(label, F.lit(" - "), F.lit(1))


def ratio(part: Column, whole: Column) -> Column:
    """Two-place quotient, NULL for an empty whole (ANSI division would raise)."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), 2)


def percentage(part: Column, whole: Column) -> Column:
    """0-100 scale, two places."""
    return F.round(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), 2)
