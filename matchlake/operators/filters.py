"""Row filters. Each names plain columns, so the predicate reaches the parquet scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake import domain
from matchlake.functions import scalars


def season(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("season_year") == year)


def year(df: DataFrame, wanted: int | None = None) -> DataFrame:
    """Rows of one match year; None keeps all."""
    return df if wanted is None else df.where(F.col("match_year") == wanted)


def competition(df: DataFrame, label: str | None = None) -> DataFrame:
    """Rows of the competition shown as `PL - Premier League`; None keeps all."""
    if label is None:
        return df
    return df.where(F.col("competition_code") == scalars.code_of_label(F.lit(label)))


def exact(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def team_either_side(df: DataFrame, team: str) -> DataFrame:
    return df.where((F.col("home_team_name") == team) | (F.col("away_team_name") == team))


def finished(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == domain.FINISHED)


def status_in(df: DataFrame, statuses: Sequence[str]) -> DataFrame:
    return df.where(F.col("status").isin(*statuses))


def scope(
    df: DataFrame,
    leagues: Sequence[str] = domain.DEFAULT_LEAGUES,
    seasons: Sequence[int] = domain.DEFAULT_SEASONS,
) -> DataFrame:
    return df.where(F.col("competition_code").isin(*leagues) & F.col("season_year").isin(*seasons))


def nonempty(frames: Mapping[object, DataFrame]) -> dict[object, DataFrame]:
    """The frames that hold a row; each test reads until the first one."""
    return {name: df for name, df in frames.items() if not df.isEmpty()}
