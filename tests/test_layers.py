import datetime as dt

import pytest

from matchlake.functions import shape
from matchlake.plans import quality, weekly
from matchlake.sinks.layers import Layers, load_seasons
from matchlake.sources import catalog
from tests.samples import envelope, payload_match

COLS = "id bigint, status string"


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "lake"), f"t{abs(hash(str(tmp_path))) % 10**8}_")


def test_replace_and_append(spark, layers, rows):
    layers.replace(spark.createDataFrame([(1, "a")], COLS), "bronze", "m")
    assert rows(layers.replace(spark.createDataFrame([(2, "b")], COLS), "bronze", "m")) == [(2, "b")]
    # appended by name, a missing column is NULL and a new one is added
    more = spark.createDataFrame([("x", 3)], "extra string, id bigint")
    assert rows(layers.append(more, "bronze", "m")) == [(2, "b", None), (3, None, "x")]


def test_typed_json_is_stored(spark, layers, rows):
    texts = spark.createDataFrame([(1, '{"k": 2}'), (2, None)], "id int, props string").coalesce(1)
    for _ in range(2):
        table = layers.append(shape.promote_json(texts, ["props"]), "bronze", "m")
    assert dict(table.dtypes)["props"] == "variant"
    got = table.selectExpr("id", "try_variant_get(props, '$.k', 'int') AS k")
    assert rows(got) == [(1, 2), (1, 2), (2, None), (2, None)]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_season_swap_is_idempotent_in_any_overwrite_mode(spark, layers, rows, mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        first = spark.createDataFrame([(1, "a"), (2, "b")], COLS)
        for _ in range(2):
            assert layers.replace_season(first, "bronze", "m", 2023) == 2
            assert layers.replace_season(spark.createDataFrame([(9, "z")], COLS), "bronze", "m", 2024) == 1
        assert rows(layers.table("bronze", "m")) == [(1, "a", 2023), (2, "b", 2023), (9, "z", 2024)]
        layers.replace_season(spark.createDataFrame([(5, "n")], COLS), "bronze", "m", 2023)
        assert rows(layers.table("bronze", "m")) == [(5, "n", 2023), (9, "z", 2024)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_season_with_new_and_missing_columns(spark, layers):
    layers.replace_season(spark.createDataFrame([(1, "a")], COLS), "bronze", "m", 2023)
    layers.replace_season(spark.createDataFrame([(2, 7)], "id bigint, gate int"), "bronze", "m", 2024)
    got = {r["id"]: r.asDict() for r in layers.table("bronze", "m").collect()}
    assert got[1] == {"id": 1, "status": "a", "gate": None, "season_year": 2023}
    assert got[2] == {"id": 2, "status": None, "gate": 7, "season_year": 2024}


def test_failed_and_empty_seasons_leave_the_rest(spark, layers, rows):
    stored = {2022: [(1, "old")], 2023: [(2, "b"), (3, "c")], 2024: []}

    def read(season):
        if season == 2025:
            return spark.read.parquet("/no/such/place")
        return spark.createDataFrame(stored[season], COLS)

    layers.replace_season(spark.createDataFrame([(8, "kept")], COLS), "bronze", "matches", 2024)
    outcome = load_seasons(layers, read, [2022, 2023, 2024, 2025])
    assert [(r.season_year, r.rows_loaded, r.error is None) for r in outcome.collect()] == [
        (2022, 1, True), (2023, 2, True), (2024, 0, True), (2025, 0, False)
    ]
    assert rows(layers.table("bronze", "matches").select("id")) == [(1,), (2,), (3,), (8,)]


def test_a_read_that_fails_half_way_leaves_the_old_season(spark, layers, rows, tmp_path):
    layers.replace_season(spark.createDataFrame([(1, "old")], COLS), "bronze", "matches", 2023)
    good = spark.range(5000).selectExpr("id", "CAST(id AS string) AS status")
    good.coalesce(1).write.parquet(f"{tmp_path}/s")
    file = next((tmp_path / "s").glob("part-*.parquet"))
    data = bytearray(file.read_bytes())
    middle = len(data) // 2
    data[middle:middle + 4000] = b"\xff" * 4000
    file.write_bytes(bytes(data))
    file.with_name(f".{file.name}.crc").write_bytes(b"")
    outcome = load_seasons(layers, lambda season: spark.read.parquet(f"{tmp_path}/s"), [2023]).first()
    assert outcome.error is not None and outcome.rows_loaded == 0
    assert rows(layers.table("bronze", "matches")) == [(1, "old", 2023)]


def test_inventory(spark, layers, rows):
    layers.ensure("bronze", "gold")
    assert catalog.inventory(spark, layers.databases()).count() == 0
    layers.replace(spark.range(3), "gold", "x")
    assert rows(catalog.inventory(spark, layers.databases())) == [("gold", "x", 3)]


def _land(put_json, tmp_path):
    for code, team in (("PL", 10), ("FL1", 20), ("PD", 30)):
        for season in (2023, 2024):
            first = (team + season) % 25 + 1
            matches = [
                payload_match(i, home=(team, f"T{team}"), away=(team + 1, f"T{team + 1}"), score=(i % 3, 1), half=(0, 0))
                for i in (first, first + 1)
            ]
            for n, m in enumerate(matches):
                m["id"] = team * 100000 + season * 10 + n
                m["utcDate"] = m["utcDate"].replace("2023", str(season))
            put_json(f"raw/competition_code={code}/season_year={season}/m.json", envelope(*matches), indent=2)
    competitions = [
        {"id": i, "code": c, "name": n}
        for i, c, n in ((1, "PL", "Premier League"), (2, "FL1", "Ligue 1"), (3, "PD", "La Liga"))
    ]
    put_json("comp/c.json", {"data": {"competitions": competitions}}, indent=2)
    return str(tmp_path / "raw"), str(tmp_path / "comp")


def test_weekly_run_end_to_end(spark, layers, put_json, tmp_path, rows):
    raw, comp = _land(put_json, tmp_path)
    run = lambda: weekly.run(
        layers, raw, comp, str(tmp_path / "landing"), run_ts=dt.datetime(2025, 1, 1), as_of=dt.date(2025, 1, 1), multi_line=True
    )
    result = run()
    assert rows(result.seasons) == [(2023, 6, None), (2024, 6, None)]
    assert rows(result.missing) == []
    report = {(r.section, r.item, r.measure): r.value for r in result.report.collect()}
    failed = {k: v for k, v in report.items() if k[0] == "test" and v != "0"}
    assert failed == {}
    assert report["table", "fact_matches", "row_count"] == "12"
    assert report["metric", "fact_matches", "unique_teams"] == "3"
    assert report["freshness", "fact_matches", "last_load"] == "2025-01-01T00:00:00"
    assert report["landing", "all_matches/season_year=2023", "OK"] == "6"
    gold = {r.table_name: r.row_count for r in catalog.inventory(spark, {"gold": layers.database("gold")}).collect()}
    assert set(gold) == {
        "fact_matches", "dim_teams", "agg_team_performance", "agg_competition_stats", "mart_team_stats",
        "mart_league_standings", "mart_match_overview", "mart_team_form",
    }
    before = rows(layers.table("gold", "fact_matches"))
    run()
    assert rows(layers.table("gold", "fact_matches")) == before


def test_weekly_run_stops_when_a_season_did_not_land(layers, put_json, tmp_path):
    raw, comp = _land(put_json, tmp_path)
    with pytest.raises(ValueError, match="season_year=2022 MISSING"):
        weekly.run(layers, raw, comp, str(tmp_path / "landing"), seasons=(2022, 2023), multi_line=True)


def test_missing_loads(spark, rows):
    loaded = spark.createDataFrame([("PL", 2023), ("PL", 2023), ("PD", 2024)], "competition_code string, season_year int")
    assert rows(quality.missing_loads(loaded, ("PL", "PD"), (2023, 2024))) == [("PD", 2023), ("PL", 2024)]


def test_a_rebuild_that_fails_leaves_the_old_table(spark, layers, rows):
    from pyspark.sql import functions as F

    layers.replace(spark.createDataFrame([(1, "a"), (2, "b")], COLS), "gold", "m")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    for partitions in ((), ("id",)):
        with pytest.raises(Exception, match="no"):
            layers.replace(bad, "gold", "m", partitions)
        assert rows(layers.table("gold", "m")) == [(1, "a"), (2, "b")]
    assert {t.name for t in spark.catalog.listTables(layers.database("gold"))} == {"m"}


def test_one_row_per_match_and_competition(spark, rows):
    from matchlake.plans import staging

    bronze = spark.createDataFrame(
        [(1, "2024", "t", 1), (1, "2023", "t", 9), (1, None, "t", 9), (2, "2023", "t", 2), (2, "2023", "u", 3), (2, "2023", "u", 3), (None, "x", "t", 0)],
        "id bigint, extracted_at string, utcDate string, goals int",
    )
    assert rows(staging.newest_matches(bronze).select("id", "goals")) == [(1, 1), (2, 3), (None, 0)]
    codes = spark.createDataFrame([(1, "PL", "a"), (1, "PL", "a"), (2, "PD", "b")], "id bigint, code string, name string")
    assert rows(staging.stg_competitions(codes)) == [(1, "PL", "a"), (2, "PD", "b")]


def test_a_season_that_did_not_arrive_again_is_told(spark, layers, put_json, tmp_path, rows):
    raw, comp = _land(put_json, tmp_path)
    run = lambda: weekly.run(
        layers, raw, comp, str(tmp_path / "landing"), run_ts=dt.datetime(2025, 1, 1), as_of=dt.date(2025, 1, 1), multi_line=True
    )
    run()
    for league in ("PL", "FL1", "PD"):
        put_json(f"raw/competition_code={league}/season_year=2024/m.json", raw="{\"data\": {\"matches\": [")
    result = run()
    assert rows(result.seasons) == [(2023, 6, None), (2024, 0, "not delivered")]
    assert rows(result.missing) == [("FL1", 2024), ("PD", 2024), ("PL", 2024)]
    report = {(r.section, r.item, r.measure): r.value for r in result.report.collect()}
    assert report["payload", "matches", "corrupt"] == "3" and report["payload", "matches", "documents"] == "6"
    assert report["load", "2024", "failed"] == "not delivered"


def test_seasons_load_in_one_job_or_one_by_one(spark, layers, rows):
    from pyspark.sql import functions as F

    data = {2021: [(1, 2021)], 2022: [(2, 2022), (3, 2022)], 2023: []}
    frame = lambda wanted: spark.createDataFrame([r for s in wanted for r in data[s]], "id bigint, season_year int")
    one = lambda s: frame([s])
    want = [(2021, 1, None), (2022, 2, None), (2023, 0, None)]
    assert rows(load_seasons(layers, one, data, read_all=frame)) == want
    broken = lambda wanted: frame(wanted).withColumn("id", F.raise_error(F.lit("no")).cast("bigint"))
    assert rows(load_seasons(layers, one, data, read_all=broken)) == want
    assert rows(layers.table("bronze", "matches")) == [(1, 2021), (2, 2022), (3, 2022)]
