import pytest

from matchlake.functions import shape
from matchlake.operators import filters
from matchlake.plans import quality
from matchlake.sinks import landing as sink
from matchlake.sources import landing
from tests.samples import envelope, payload_match
from pyspark.sql import functions as F


def test_pretty_printed_file_with_constant_tags(spark, put_json):
    path = put_json("matches_PL_2023.json", envelope(payload_match(1), payload_match(2, score=(1, 1))), indent=2)
    schema = landing.discover_schema(spark, path, multi_line=True)
    df = landing.raw_matches(spark, path, schema, multi_line=True, competition_code="PL", season_year=2023)
    got = {r["id"]: r for r in df.collect()}
    assert got[1]["homeTeam_name"] == "A" and got[1]["score_fullTime_home"] == 2
    assert got[2]["score_winner"] == "DRAW"
    # the tag wins over the nested competition code
    assert {r["competition_code"] for r in got.values()} == {"PL"}
    assert got[1]["season_year"] == 2023
    # lists are left alone
    assert got[1]["referees"][0]["id"] == 9


def test_folder_tags_and_known_schema(spark, put_json, tmp_path):
    put_json("raw/competition_code=PL/season_year=2023/a.json", envelope(payload_match(1)), envelope(payload_match(2)))
    put_json("raw/competition_code=PD/season_year=2024/a.json", envelope(payload_match(3)))
    df = landing.raw_matches(spark, str(tmp_path / "raw"))
    got = sorted((r["id"], r["competition_code"], r["season_year"]) for r in df.collect())
    assert got == [(1, "PL", 2023), (2, "PL", 2023), (3, "PD", 2024)]


def test_all_null_scores_keep_their_type(spark, put_json):
    path = put_json("x.json", envelope(payload_match(1, "SCHEDULED", score=(None, None), half=(None, None))))
    schema = landing.discover_schema(spark, path)
    df = landing.raw_matches(spark, path, schema)
    types = dict(df.dtypes)
    assert types["score_fullTime_home"] == "bigint" and types["score_winner"] == "string"


def test_unknown_fields_are_kept(spark, put_json):
    path = put_json("x.json", envelope(payload_match(1)), envelope(payload_match(2, venue={"city": "Lens"})))
    df = landing.raw_matches(spark, path, landing.discover_schema(spark, path))
    assert {r["id"]: r["venue_city"] for r in df.collect()} == {1: None, 2: "Lens"}


def test_documents_without_matches_and_defects(spark, put_json, tmp_path):
    put_json("d/a.json", envelope(), {"extracted_at": "x", "data": {"message": "none"}}, envelope(payload_match(5)))
    put_json("d/b.json", raw="{not json\n")
    path = str(tmp_path / "d")
    assert [r["id"] for r in landing.raw_matches(spark, path).collect()] == [5]
    defects = landing.envelope_defects(landing.read_envelopes(spark, path)).first()
    assert (defects.documents, defects.corrupt, defects.without_records) == (4, 1, 1)


def test_older_envelope_without_count(spark, put_json):
    document = envelope(payload_match(1))
    del document["record_count"]
    assert landing.raw_matches(spark, put_json("x.json", document)).count() == 1


def test_competitions(spark, put_json, rows):
    document = {"data": {"competitions": [{"id": 2021, "code": "PL", "name": "Premier League", "area": {"id": 1}}]}}
    path = put_json("c.json", document, indent=2)
    schema = landing.discover_schema(spark, path, landing.COMPETITION_ENVELOPE, multi_line=True)
    df = landing.raw_competitions(spark, path, schema, multi_line=True)
    assert set(df.columns) == {"id", "code", "name", "area.id"}
    assert rows(landing.competition_ids(df)) == [(2021,)]


def test_envelope_counts(spark, rows, tmp_path):
    both = spark.sql("SELECT named_struct('matches', array(1, 2), 'competitions', array(1)) AS payload")
    only = spark.sql("SELECT named_struct('competitions', array(1, 2, 3)) AS payload")
    neither = spark.sql("SELECT named_struct('other', 1) AS payload")
    counts = [sink.envelope(df).first()["record_count"] for df in (both, only, neither)]
    assert counts == [2, 3, 0]
    sink.write_envelopes(only, str(tmp_path / "out"), extracted_at=F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    text = spark.read.text(str(tmp_path / "out")).first()[0]
    assert text == '{"extracted_at":"2024-01-02T03:04:05.000000","data":{"competitions":[1,2,3]},"record_count":3}'


def test_season_folders_are_replaced_one_by_one(spark, rows, tmp_path):
    path = str(tmp_path / "by")
    sink.write_by_season(spark.createDataFrame([(1, 2023), (2, 2024)], "id int, season_year int"), path)
    sink.write_by_season(spark.createDataFrame([(3, 2024)], "id int, season_year int"), path, clustered=True)
    assert rows(spark.read.parquet(path)) == [(1, 2023), (3, 2024)]


def test_directory_scan(spark, rows, tmp_path):
    sink.write_by_season(spark.createDataFrame([(1, 2023), (2, 2024)], "id int, season_year int"), f"{tmp_path}/all_matches")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/competitions.parquet")
    spark.range(1).write.json(f"{tmp_path}/ignored")
    found = landing.scan_directory(spark, str(tmp_path))
    assert {name: df.count() for name, df in found.items()} == {"all_matches": 2, "competitions": 3}


def test_landing_status(spark, rows, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/good")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/empty")
    (tmp_path / "junk").mkdir()
    (tmp_path / "junk" / "x.parquet").write_bytes(b"not parquet at all")
    datasets = ["good", "empty", "junk", "absent"]
    want = [("absent", "MISSING", 0), ("empty", "EMPTY", 0), ("good", "OK", 4), ("junk", "CORRUPTED", 0)]
    for footers_only in (False, True):
        status = quality.landing_status(spark, str(tmp_path), datasets, footers_only)
        assert rows(status) == want
    with pytest.raises(ValueError, match="absent MISSING"):
        quality.require_landing(status)
    quality.require_landing(status.where("status = 'EMPTY'"))


def test_damage_inside_a_page_is_found(spark, tmp_path):
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/d")
    file = next((tmp_path / "d").glob("part-*.parquet"))
    data = bytearray(file.read_bytes())
    data[40:2000] = b"\xff" * 1960
    file.write_bytes(bytes(data))
    crc = file.with_name(f".{file.name}.crc")
    if crc.exists():
        crc.write_bytes(b"")  # an empty checksum file is ignored
    assert quality.landing_status(spark, str(tmp_path), ["d"]).first()["status"] == "CORRUPTED"


def test_json_text_columns(spark, put_json):
    path = put_json("x.json", envelope(payload_match(1)))
    df = landing.raw_matches(spark, path, landing.discover_schema(spark, path))
    assert shape.encode_complex(df).first()["referees"] == '[{"id":9,"name":null}]'


def test_flat_folder_takes_tags_from_file_names(spark, put_json, tmp_path):
    put_json("f/matches_PL_2023.json", envelope(payload_match(1)), indent=2)
    put_json("f/matches_FL1_2024.json", envelope(payload_match(2), payload_match(3)), indent=2)
    put_json("f/competitions.json", {"data": {"competitions": []}})
    got = landing.raw_matches_by_file_name(spark, str(tmp_path / "f")).collect()
    assert sorted((r["id"], r["competition_code"], r["season_year"]) for r in got) == [
        (1, "PL", 2023), (2, "FL1", 2024), (3, "FL1", 2024)
    ]


def test_scope_prunes_landing_folders(spark, put_json, tmp_path):
    for code in ("PL", "PD"):
        put_json(f"raw/competition_code={code}/season_year=2023/a.json", envelope(payload_match(1)))
    df = filters.scope(landing.raw_matches(spark, str(tmp_path / "raw")), ("PL",), (2023,))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [competition_code" in plan or "PartitionFilters: [isnotnull(competition_code" in plan
    assert df.count() == 1
