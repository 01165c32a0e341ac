"""Data-quality checks as Spark jobs that all yield `(check, table_name, column_name, failed_rows, severity)`.

Row rules of a table are one aggregate in one scan. Uniqueness needs a shuffle of the key alone,
and referential integrity joins counts per team rather than matches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchlake import domain
from matchlake.functions.shape import quoted
from matchlake.operators import joins, reports
from matchlake.sinks.layers import together

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    """A check that counts the rows for which the SQL condition `fails` is true."""

    check: str
    column: str
    fails: str
    severity: str = ERROR


# -- row rules ------------------------------------------------------------------------------

def _text(value: object) -> str:
    """SQL literal of a string."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c, f"{quoted(c)} IS NULL") for c in columns]


def accepted_values(column: str, values: Sequence[str]) -> Rule:
    """NULL passes, as `NOT IN` on NULL is not true."""
    return Rule("accepted_values", column, f"{quoted(column)} NOT IN ({', '.join(map(_text, values))})")


def valid_scores() -> Rule:
    return Rule("valid_scores", "fulltime_score", "fulltime_home_score < 0 OR fulltime_away_score < 0")


def halftime_within_fulltime() -> Rule:
    home, away = "halftime_home_score > fulltime_home_score", "halftime_away_score > fulltime_away_score"
    return Rule("halftime_within_fulltime", "halftime_score", f"{home} OR {away}")


def reasonable_dates(
    as_of: dt.date | None = None, min_date: str = domain.MIN_MATCH_DATE, max_days_ahead: int = domain.MAX_DAYS_AHEAD
) -> Rule:
    """Matches more than `max_days_ahead` days after `as_of` (today if None), or before `min_date`."""
    today = "current_date()" if as_of is None else f"DATE '{as_of.isoformat()}'"
    late = f"match_date > CAST({today} + INTERVAL {int(max_days_ahead)} DAYS AS TIMESTAMP_NTZ)"
    return Rule("reasonable_dates", "match_date", f"{late} OR match_date < TIMESTAMP_NTZ '{min_date}'")


def all_null_rows(df: DataFrame) -> Rule:
    return Rule("all_null_row", "*", " AND ".join(f"{quoted(c)} IS NULL" for c in df.columns), WARN)


def row_checks(df: DataFrame, table: str, rules: Iterable[Rule], nonempty: bool = False) -> DataFrame:
    """All row rules of one table in one aggregate; `nonempty` adds a check that it has rows."""
    counted = [(r.check, r.column, r.severity, f"count_if({r.fails})") for r in rules]
    if nonempty:
        counted.append(("nonempty", "*", WARN, "CAST(count(1) = 0 AS bigint)"))
    counts = df.agg(*[F.expr(f"{count} AS f{i}") for i, (*_, count) in enumerate(counted)])
    rows = ", ".join(
        f"named_struct('check', {_text(check)}, 'table_name', {_text(table)}, 'column_name', {_text(column)}, "
        f"'failed_rows', f{i}, 'severity', {_text(severity)})"
        for i, (check, column, severity, _) in enumerate(counted)
    )
    return counts.selectExpr(f"inline(array({rows}))")


# -- key rules ------------------------------------------------------------------------------

def _result(count: DataFrame, check: str, table: str, column: str, severity: str = ERROR) -> DataFrame:
    """Report row for a one-row frame of one count."""
    return count.selectExpr(
        f"{_text(check)} AS check", f"{_text(table)} AS table_name", f"{_text(column)} AS column_name",
        f"CAST({quoted(count.columns[0])} AS bigint) AS failed_rows", f"{_text(severity)} AS severity",
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    return _result(reports.key_profile(df, column).select("repeated_values"), "unique", table, column)


def no_duplicates(df: DataFrame, table: str, column: str) -> DataFrame:
    """As unique, but repeated NULLs count too."""
    return _result(reports.key_profile(df, column).select("repeated_keys"), "no_duplicates", table, column)


def referential_integrity(facts: DataFrame, teams: DataFrame, table: str = "fact_matches") -> DataFrame:
    return _result(joins.orphan_count(facts, teams), "referential_integrity", table, "home_team_id")


def missing_loads(loaded: DataFrame, leagues: Sequence[str], seasons: Sequence[int]) -> DataFrame:
    """League and season pairs asked for but without a loaded row."""
    spark = loaded.sparkSession
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in leagues])).alias("competition_code"))
    asked = asked.select("competition_code", F.explode(F.array(*[F.lit(int(s)) for s in seasons])).alias("season_year"))
    found = loaded.select("competition_code", F.col("season_year").cast("int").alias("season_year")).distinct()
    return asked.join(found, ["competition_code", "season_year"], "left_anti")


# -- tables and files -----------------------------------------------------------------------

def table_health(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """`(table_name, row_count, unique_keys, status)`, each table counted by its own key."""
    parts = [
        reports.table_stats(df, *keys[name]).select(
            F.lit(name).alias("table_name"), "row_count", "unique_keys",
            F.when(F.col("row_count") == 0, "EMPTY").otherwise("OK").alias("status"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def _dataset_status(spark: SparkSession, path: str, footers_only: bool) -> tuple[str, int]:
    try:
        df = spark.read.parquet(path)
    except AnalysisException as failure:
        # no such path, or a folder without any file whose schema can be read
        missing = failure.getCondition() == "PATH_NOT_FOUND"
        return ("MISSING" if missing else "CORRUPTED"), 0
    except (PySparkException, Py4JJavaError):
        return "CORRUPTED", 0
    try:
        if footers_only:
            rows = df.count()
        else:
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
            rows = seen.get["n"]
    except (PySparkException, Py4JJavaError):
        return "CORRUPTED", 0
    return ("OK" if rows else "EMPTY"), rows


def landing_status(
    spark: SparkSession, root: str, datasets: Sequence[str], footers_only: bool = False
) -> DataFrame:
    """`(dataset, status, row_count)` with status OK, EMPTY, MISSING or CORRUPTED for each required dataset.

    By default every page is decoded, so damage inside a file shows too. `footers_only` trusts
    the row counts in the footers and reads nothing else. Datasets are read side by side.
    """
    checks = [partial(_dataset_status, spark, f"{root}/{name}", footers_only) for name in datasets]
    found = [(name, *status) for name, status in zip(datasets, together(*checks))]
    return spark.createDataFrame(found, "dataset string, status string, row_count bigint")


def require_landing(status: DataFrame) -> None:
    """Raise if a required dataset is missing or corrupted; an empty one passes."""
    bad = status.where(F.col("status").isin("MISSING", "CORRUPTED")).collect()
    if bad:
        raise ValueError("landing check failed: " + ", ".join(f"{r.dataset} {r.status}" for r in bad))


# -- contracts and the report ---------------------------------------------------------------

def bronze_rules() -> list[Rule]:
    return [
        *not_null("id", "status", "homeTeam_id", "awayTeam_id"),
        accepted_values("status", domain.SOURCE_STATUSES),
    ]


def silver_rules(leagues: Sequence[str] = domain.DEFAULT_LEAGUES) -> list[Rule]:
    return [
        *not_null("match_id", "match_datetime", "status", "league_code"),
        accepted_values("status", domain.STAGED_STATUSES),
        accepted_values("league_code", leagues),
        accepted_values("match_result", domain.MATCH_RESULTS),
    ]


def fact_rules(as_of: dt.date | None = None, min_date: str = domain.MIN_MATCH_DATE) -> list[Rule]:
    return [valid_scores(), halftime_within_fulltime(), reasonable_dates(as_of, min_date)]


def contract_report(
    tables: Mapping[str, DataFrame],
    leagues: Sequence[str] = domain.DEFAULT_LEAGUES,
    as_of: dt.date | None = None,
    min_date: str = domain.MIN_MATCH_DATE,
) -> DataFrame:
    """Every contract test but the fact's key as one union, so Spark runs the branches together.

    `tables` maps matches, competitions, stg_matches, stg_competitions, fact_matches, dim_teams,
    mart_team_stats and mart_league_standings to their DataFrames.
    """
    t = tables
    dropped = accepted_values("status", domain.STAGED_STATUSES).fails
    parts = [
        row_checks(t["matches"], "matches", [*bronze_rules(), Rule("status_not_staged", "status", dropped, WARN)], True),
        unique(t["matches"], "matches", "id"),
        row_checks(t["stg_matches"], "stg_matches", silver_rules(leagues), True),
        unique(t["stg_matches"], "stg_matches", "match_id"),
        row_checks(
            t["stg_competitions"], "stg_competitions",
            not_null("competition_id", "competition_code", "competition_name"), True,
        ),
        unique(t["stg_competitions"], "stg_competitions", "competition_id"),
        unique(t["stg_competitions"], "stg_competitions", "competition_code"),
        row_checks(t["fact_matches"], "fact_matches", fact_rules(as_of, min_date), True),
        referential_integrity(t["fact_matches"], t["dim_teams"]),
        row_checks(
            t["mart_team_stats"], "mart_team_stats",
            [
                *not_null("team_id", "team_name", "league_code", "total_matches", "total_points"),
                accepted_values("league_code", leagues),
            ],
            True,
        ),
        row_checks(
            t["mart_league_standings"], "mart_league_standings", not_null("league_code", "team_rank", "team_name"), True
        ),
    ]
    return reduce(DataFrame.unionAll, parts)


def _entries(df: DataFrame, *rows: tuple[str, str, str, str]) -> DataFrame:
    """`(section, item, measure, value)` rows for each row of `df`; all but the section are SQL."""
    structs = ", ".join(
        f"named_struct('section', {_text(section)}, 'item', {item}, 'measure', {measure}, "
        f"'value', CAST({value} AS string))"
        for section, item, measure, value in rows
    )
    return df.selectExpr(f"inline(array({structs}))")


def fact_report(fact: DataFrame) -> DataFrame:
    """Statistics, key metrics, freshness and the duplicate test of the fact.

    All but the home teams come from one shuffle of the match id, which each of them would
    need on its own.
    """
    profile = reports.key_profile(
        fact, "match_id", total_goals=(F.sum, "total_goals"), last_load=(F.max, "loaded_at")
    )
    figures = reports.side_by_side(profile, reports.home_teams(fact))
    name = _text("fact_matches")
    return _entries(
        figures,
        ("table", name, "'row_count'", "row_count"),
        ("table", name, "'unique_keys'", "unique_keys"),
        ("table", name, "'status'", "IF(row_count = 0, 'EMPTY', 'OK')"),
        ("metric", name, "'total_matches'", "unique_keys"),
        ("metric", name, "'unique_teams'", "unique_teams"),
        ("metric", name, "'total_goals'", "total_goals"),
        ("freshness", name, "'last_load'", "date_format(last_load, \"yyyy-MM-dd'T'HH:mm:ss\")"),
        ("test", "'fact_matches.match_id'", f"'{ERROR}:no_duplicates'", "repeated_keys"),
    )


PAYLOAD_COUNTS = ("documents", "corrupt", "without_records", "miscounted")


def run_report(
    landing: DataFrame, health: DataFrame, fact: DataFrame, contracts: DataFrame, payloads: DataFrame, loads: DataFrame
) -> DataFrame:
    """One `(section, item, measure, value)` table of everything a run reports, values as text.

    `health` covers the gold tables other than the fact, `payloads` counts documents and their
    defects, `loads` has the rows or the failure of each season.
    """
    parts = [
        _entries(payloads, *[("payload", "'matches'", _text(c), c) for c in PAYLOAD_COUNTS]),
        _entries(loads, ("load", "CAST(season_year AS string)", "IF(error IS NULL, 'rows_loaded', 'failed')", "coalesce(error, CAST(rows_loaded AS string))")),
        _entries(landing, ("landing", "dataset", "status", "row_count")),
        _entries(health, *[("table", "table_name", f"'{m}'", m) for m in ("row_count", "unique_keys", "status")]),
        fact_report(fact),
        _entries(contracts, (
            "test", "concat_ws('.', table_name, column_name)", "concat_ws(':', severity, check)", "failed_rows",
        )),
    ]
    return reduce(DataFrame.unionAll, parts)
