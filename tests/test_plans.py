"""The physical plans keep the properties the design relies on."""

import pytest

from parity.registry import QUERIES
from tests.conftest import SF_DIR


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["agg_team_performance", "agg_competition_stats", "mart_team_form", "mart_league_standings"])
def test_finished_filter_reaches_the_scan(spark, name):
    assert "EqualTo(o_orderstatus,F)" in plan(spark, name)


def test_team_performance_shuffles_tallies_only(spark):
    """One shuffle for tallies by spelling, one that folds the few spellings of a team."""
    text = plan(spark, "agg_team_performance")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 2
    assert "SortAggregate" not in text.rsplit("Exchange", 1)[1]


def test_standings_add_one_shuffle_of_team_rows(spark):
    text = plan(spark, "mart_league_standings")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 3


def test_form_keeps_five_rows_per_team_before_the_shuffle(spark):
    text = plan(spark, "mart_team_form")
    before = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before and "Partial" in before
    assert text.count("Exchange") == 1


def test_team_names_hash_aggregate_before_the_sort(spark):
    text = plan(spark, "stg_teams")
    large = text.split("Exchange")[-1]
    assert "HashAggregate" in large and "SortAggregate" not in large


@pytest.mark.parametrize("name", ["top_recent_matches", "top_team_matches20", "lim_sample", "top_team_points5"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def test_season_filter_prunes_folders(spark):
    text = plan(spark, "flt_season")
    assert "PartitionFilters: [isnotnull(season_year" in text


def test_facts_are_not_shuffled_for_a_checked_dimension(spark):
    text = plan(spark, "join_competition")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
