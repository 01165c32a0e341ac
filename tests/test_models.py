import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlake.operators import joins, reports
from matchlake.plans import marts, staging
from tests.samples import A, B, C, SEASON, STAGED, staged


@pytest.fixture(scope="module")
def fact(spark):
    return marts.fact_columns(spark.createDataFrame(SEASON, STAGED), F.lit(dt.datetime(2024, 1, 1))).cache()


def by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def test_team_performance(fact):
    teams = by(marts.agg_team_performance(fact), "team_name")
    # Alpha: 2-1, 4-1, 3-3, 0-5
    alpha = teams["Alpha"]
    assert (alpha["total_matches"], alpha["total_wins"], alpha["total_draws"], alpha["total_losses"]) == (4, 2, 1, 1)
    assert (alpha["total_goals_scored"], alpha["total_goals_conceded"], alpha["goal_difference"]) == (9, 10, -1)
    assert (alpha["total_points"], alpha["win_percentage"], alpha["points_per_match"]) == (7, 50.0, 1.75)
    assert (alpha["home_wins"], alpha["away_wins"], alpha["home_matches"], alpha["away_matches"]) == (1, 1, 2, 2)


def test_tallies_give_the_same_table(fact, rows):
    folded = marts.performance_from_tallies(marts.team_tallies(fact))
    assert rows(folded) == rows(marts.agg_team_performance(fact))


def test_invariants(fact):
    t = marts.agg_team_performance(fact).agg(
        F.sum("total_wins").alias("w"), F.sum("total_losses").alias("l"), F.sum("goal_difference").alias("gd"),
        F.sum("total_matches").alias("m"), F.sum(F.col("total_points") - 3 * F.col("total_wins") - F.col("total_draws")).alias("p"),
    ).first()
    assert t.w == t.l and t.gd == 0 and t.m == 2 * 6 and t.p == 0


def test_competition_stats(fact):
    (row,) = marts.agg_competition_stats(fact).collect()
    # six finished matches, 21 goals, home 2, away 2, draws 2; above 3 goals: 1-4, 3-3, 5-0
    assert (row.match_year, row.total_matches, row.total_goals, row.avg_goals_per_match) == (2023, 6, 21, 3.5)
    assert (row.home_win_percentage, row.away_win_percentage, row.draw_percentage) == (33.33, 33.33, 33.33)
    assert row.high_scoring_percentage == 50.0
    (overview,) = marts.mart_match_overview(marts.agg_competition_stats(fact)).collect()
    assert tuple(overview) == ("PL", 6, 3.5)


def test_standings_ties_share_a_rank(spark, rows):
    draw = [staged(1, 1, A, B, (1, 1)), staged(2, 2, A, C, (0, 0), "IN_PLAY"), staged(3, 3, C, (4, "Delta"), (0, 2))]
    fact = marts.fact_columns(spark.createDataFrame(draw, STAGED), F.lit(None).cast("timestamp_ntz"))
    table = marts.mart_league_standings(marts.agg_team_performance(fact)).select("team_rank", "team_name")
    assert rows(table) == [(1, "Delta"), (2, "Alpha"), (2, "Beta"), (4, "Gamma")]


def test_form_is_newest_first_and_five_long(spark):
    games = [staged(i, i, A, B, s) for i, s in enumerate([(1, 0), (0, 0), (0, 1), (2, 0), (0, 0), (3, 0)], start=1)]
    fact = marts.fact_columns(spark.createDataFrame(games, STAGED), F.lit(None).cast("timestamp_ntz"))
    form = by(marts.mart_team_form(fact), "team_id")
    assert (form[1]["current_form"], form[1]["last_5_points"]) == ("WDWLD", 8)
    assert (form[2]["current_form"], form[2]["last_5_points"]) == ("LDLWD", 5)


def test_form_ties_in_time_go_to_the_larger_id(spark):
    games = [staged(1, 1, A, B, (1, 0)), staged(2, 1, A, B, (0, 1))]
    fact = marts.fact_columns(spark.createDataFrame(games, STAGED), F.lit(None).cast("timestamp_ntz"))
    assert by(marts.mart_team_form(fact), "team_id")[1]["current_form"] == "LW"


def test_latest_team_name_wins(spark, rows):
    games = [
        staged(5, 1, (1, "Old"), B, (1, 0)), staged(1, 9, B, (1, "New"), (1, 0)),
        staged(8, 4, (1, "Middle"), B, (1, 0)), staged(2, 9, (2, "Beta II"), C, (0, 0)),
    ]
    matches = spark.createDataFrame(games, STAGED)
    assert rows(staging.stg_teams(matches)) == [(1, "New"), (2, "Beta II"), (3, "Gamma")]
    fact = marts.fact_columns(matches, F.lit(None).cast("timestamp_ntz"))
    stats = by(marts.mart_team_stats(marts.team_tallies(fact)), "team_id")
    assert stats[1]["team_name"] == "New" and stats[1]["total_matches"] == 3 and stats[1]["total_points"] == 6
    assert stats[1]["win_rate"] == 66.67


def test_recency_orders_like_time_then_id(spark):
    times = [dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23), dt.datetime(1970, 1, 1), dt.datetime(9999, 12, 31)]
    ids = [-(2**63), -1, 0, 7, 2**63 - 1]
    data = [(t, i, n) for n, (t, i) in enumerate((t, i) for t in times for i in ids)]
    df = spark.createDataFrame(data, "t timestamp_ntz, i bigint, n int")
    got = df.orderBy(staging.recency("t", "i")).collect()
    assert [r.n for r in got] == list(range(len(data)))
    unknown = spark.sql("SELECT CAST(NULL AS timestamp_ntz) AS t, 1L AS i")
    first = unknown.unionAll(df.where("n = 0").select("t", "i")).select(staging.recency("t", "i")).collect()
    assert first[0][0] < first[1][0]


def test_a_clock_change_does_not_swap_matches(spark, rows):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that day in that zone, and would become 03:30
        times = [("Old", "2024-03-10 02:30:00"), ("New", "2024-03-10 03:10:00")]
        matches = spark.createDataFrame(
            [(n, 1, name, 2, "B", when) for n, (name, when) in enumerate(times)],
            "match_id bigint, home_team_id bigint, home_team_name string, away_team_id bigint, away_team_name string, w string",
        ).withColumn("match_datetime", F.col("w").cast("timestamp_ntz"))
        assert rows(staging.stg_teams(matches)) == [(1, "New"), (2, "B")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unplayed_matches_count_as_loss_in_team_results(fact, rows):
    results = by(reports.team_matches(fact, "Alpha"), "match_date")
    assert [r["result"] for r in results.values()] == ["Loss", "Loss", "Loss", "Draw", "Win", "Win"]
    assert rows(reports.form_counts(fact, "Alpha")) == [("Draw", 1), ("Loss", 3), ("Win", 2)]
    top = reports.team_recent(fact, "Alpha", 1).first()
    assert (top.score, top.result) == ("nan - nan", "Loss")


def test_key_figures_use_the_plain_mean(spark):
    stats = spark.createDataFrame(
        [(2022, "PL", 100, 200, 2.0), (2023, "PL", 1, 4, 4.0), (2023, "PD", 5, 5, 1.0)],
        "match_year bigint, competition_code string, total_matches bigint, total_goals bigint, avg_goals_per_match double",
    )
    teams = spark.createDataFrame([("PL", "x"), ("PL", "y"), ("PD", "z")], "competition_code string, team_name string")
    assert tuple(reports.key_figures(stats, teams, label="PL - Premier League").first()) == (101, 204, 3.0, 2)
    # the year does not narrow the team count
    assert tuple(reports.key_figures(stats, teams, 2022, "PL - Premier League").first()) == (100, 200, 2.0, 2)
    assert tuple(reports.key_figures(stats, teams).first()) == (106, 209, 2.33, 3)
    assert tuple(reports.key_figures(stats, teams, 1900).first()) == (0, 0, None, 3)


def test_staging_filters_status_and_labels(spark, rows):
    bronze = spark.createDataFrame(
        [
            (1, "2023-08-01T19:00:00Z", "FINISHED", 2, 1), (2, "2023-08-02T19:00:00Z", "FINISHED", 1, 1),
            (3, "2023-08-03T19:00:00Z", "SCHEDULED", None, None), (4, "bad", "PAUSED", 0, 1),
            (5, "2023-08-05T19:00:00Z", "POSTPONED", None, None),
        ],
        "id bigint, utcDate string, status string, score_fulltime_home bigint, score_fulltime_away bigint",
    )
    for name in ("competition_code", "homeTeam_name", "awayTeam_name", "score_winner"):
        bronze = bronze.withColumn(name, F.lit("x"))
    for name in ("homeTeam_id", "awayTeam_id", "score_halfTime_home", "score_halfTime_away"):
        bronze = bronze.withColumn(name, F.lit(0))
    got = staging.stg_matches(bronze).select("match_id", "match_datetime", "match_result")
    assert rows(got) == [
        (1, dt.datetime(2023, 8, 1, 19), "Home Win"), (2, dt.datetime(2023, 8, 2, 19), "Draw"),
        (3, dt.datetime(2023, 8, 3, 19), "Unknown"), (4, None, "Away Win"),
    ]


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_lookup_is_the_same_with_and_without_broadcast(spark, rows, how):
    # one hot key, copies of one row, a key the dimension lacks, NULL, and columns that do not hash
    facts = spark.createDataFrame(
        [("hot", 1)] * 50 + [("hot", i) for i in range(50)] + [("b", 1), ("none", 2), (None, 3)], "k string, v int"
    ).withColumns({"m": F.create_map(F.lit("a"), "v"), "j": F.expr("parse_json('{}')")})
    dim = spark.createDataFrame([("hot", "H"), ("b", "B"), ("c", "C")], "k string, name string")
    small = joins.lookup(facts, dim, "k", how)
    got = rows(small.drop("m", "j"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.lookup(facts, dim, "k", how)
        assert small.columns == large.columns
        assert got == rows(large.drop("m", "j"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_orphans(spark, fact, rows):
    teams = spark.createDataFrame([(1, "Alpha"), (3, "Gamma")], "team_id bigint, team_name string")
    assert rows(joins.orphans(fact, teams).select("match_id")) == [(2,), (5,)]
    assert joins.orphan_count(fact, teams).first()[0] == 2
    assert joins.orphan_count(fact, teams.unionAll(teams.selectExpr("2L", "'Beta'"))).first()[0] == 0
