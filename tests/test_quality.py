"""Each check must be seen to fail on a fault made for it, and to pass without."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlake.plans import marts, quality
from tests.samples import A, B, C, STAGED, staged

AS_OF = dt.date(2023, 9, 30)


@pytest.fixture
def fact(spark):
    games = [staged(1, 1, A, B, (2, 1)), staged(2, 2, B, C, (0, 0)), staged(3, 3, C, A, (None, None), "SCHEDULED")]
    return marts.fact_columns(spark.createDataFrame(games, STAGED), F.lit(dt.datetime(2024, 1, 1)))


def failures(df, *rules):
    return {(r.check, r.column_name): r.failed_rows for r in quality.row_checks(df, "t", rules).collect()}


def broken(fact, column, value, match_id=1):
    return fact.withColumn(column, F.when(F.col("match_id") == match_id, F.lit(value)).otherwise(F.col(column)))


def test_clean_rows_pass(fact):
    rules = [
        *quality.not_null("match_id", "home_team_id"), quality.accepted_values("status", ("FINISHED", "SCHEDULED")),
        *quality.fact_rules(AS_OF),
    ]
    assert set(failures(fact, *rules).values()) == {0}


def test_not_null(fact):
    bad = broken(fact, "home_team_id", None)
    assert failures(bad, *quality.not_null("home_team_id")) == {("not_null", "home_team_id"): 1}


def test_accepted_values_pass_null(fact):
    rule = quality.accepted_values("status", ("FINISHED", "SCHEDULED"))
    assert failures(broken(fact, "status", "UNKNOWN"), rule) == {("accepted_values", "status"): 1}
    assert failures(broken(fact, "status", None), rule) == {("accepted_values", "status"): 0}


@pytest.mark.parametrize("column", ["fulltime_home_score", "fulltime_away_score"])
def test_negative_score(fact, column):
    # NULL scores of match 3 do not count
    assert list(failures(broken(fact, column, -1), quality.valid_scores()).values()) == [1]


def test_halftime_above_fulltime(fact):
    bad = broken(broken(fact, "halftime_away_score", 2), "fulltime_away_score", 1)
    assert list(failures(bad, quality.halftime_within_fulltime()).values()) == [1]


@pytest.mark.parametrize("when, wrong", [
    (dt.datetime(2019, 12, 31, 23), 1), (dt.datetime(2020, 1, 1), 0),
    (dt.datetime(2023, 10, 30), 0), (dt.datetime(2023, 10, 30, 0, 0, 1), 1), (dt.datetime(2023, 10, 31), 1),
])
def test_dates(fact, when, wrong):
    bad = broken(fact, "match_date", when)
    assert list(failures(bad, quality.reasonable_dates(AS_OF)).values()) == [wrong]


def test_unique_and_duplicates(spark, fact):
    failed = lambda df: df.first()["failed_rows"]
    twice = fact.unionAll(fact.where("match_id = 1"))
    assert failed(quality.unique(fact, "t", "match_id")) == 0
    assert failed(quality.unique(twice, "t", "match_id")) == 1
    assert failed(quality.no_duplicates(twice, "t", "match_id")) == 1
    # repeated NULLs are duplicates, but do not break uniqueness
    nulls = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    assert failed(quality.unique(nulls, "t", "k")) == 0
    assert failed(quality.no_duplicates(nulls, "t", "k")) == 1


def test_referential_integrity(spark, fact):
    teams = spark.createDataFrame([(1, "Alpha"), (2, "Beta")], "team_id bigint, team_name string")
    assert quality.referential_integrity(fact, teams).first()["failed_rows"] == 1


def test_all_null_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, "x")], "a int, b string")
    got = quality.row_checks(df, "t", [quality.all_null_rows(df)], nonempty=True).collect()
    assert [(r.check, r.failed_rows, r.severity) for r in got] == [("all_null_row", 1, "warn"), ("nonempty", 0, "warn")]
    empty = df.limit(0)
    got = quality.row_checks(empty, "t", [quality.all_null_rows(empty)], nonempty=True).collect()
    assert [(r.check, r.failed_rows) for r in got] == [("all_null_row", 0), ("nonempty", 1)]


def test_table_health(spark, rows):
    tables = {"x": spark.createDataFrame([(1, 1), (1, 1), (None, 2)], "a int, b int"), "y": spark.range(0)}
    got = quality.table_health(tables, {"x": ("a", "b"), "y": ("id",)})
    assert rows(got) == [("x", 3, 1, "OK"), ("y", 0, 0, "EMPTY")]


def test_fact_report_of_an_empty_fact(fact):
    got = {(r.section, r.measure): r.value for r in quality.fact_report(fact.limit(0)).collect()}
    assert got["table", "row_count"] == "0" and got["table", "status"] == "EMPTY" and got["metric", "total_goals"] is None
