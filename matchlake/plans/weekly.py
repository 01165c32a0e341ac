"""The recurring job: landed payloads to bronze, silver, gold and the quality report.

Steps read the tables the step before wrote, so a lost executor repeats tasks of one step
only, and every later scan gets pruned parquet columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake import domain
from matchlake.functions import scalars, shape
from matchlake.operators import filters, joins
from matchlake.plans import marts, quality, staging
from matchlake.sinks import landing as landing_sink
from matchlake.sinks.layers import Layers, load_seasons, together
from matchlake.sources import catalog, landing


MATCHES, COMPETITIONS = "all_matches", "competitions"


@dataclass(frozen=True)
class LoadResult:
    seasons: DataFrame
    missing: DataFrame
    report: DataFrame


def land(
    layers: Layers, raw_matches: str, raw_competitions: str, landing_path: str,
    leagues: Sequence[str], seasons: Sequence[int], schema: T.StructType, multi_line: bool = False,
) -> None:
    """Payload documents to landing parquet. The scope filter prunes league and season folders."""
    spark = layers.spark
    rows = landing.raw_matches(spark, raw_matches, schema, multi_line, carried=("extracted_at",))
    wanted = shape.encode_complex(filters.scope(rows, leagues, seasons))
    # documents are read folder by folder, so a task meets few seasons and needs no shuffle
    landing_sink.write_by_season(wanted, f"{landing_path}/{MATCHES}", clustered=True)
    found = landing.discover_schema(spark, raw_competitions, landing.COMPETITION_ENVELOPE, multi_line)
    competitions = shape.encode_complex(landing.raw_competitions(spark, raw_competitions, found, multi_line))
    competitions.write.mode("overwrite").parquet(f"{landing_path}/{COMPETITIONS}")


def load_unflattened(
    layers: Layers, raw_matches: str, raw_competitions: str, seasons: Sequence[int],
    schema: T.StructType | None = None, multi_line: bool = False,
) -> DataFrame:
    """Payload records with all their fields, nested fields as JSON text, straight into raw bronze tables.

    Matches are bounded by the competitions that landed and carry that competition's id; the
    season asked for replaces the record's own season.
    """
    spark = layers.spark
    found = landing.discover_schema(spark, raw_competitions, landing.COMPETITION_ENVELOPE, multi_line)
    competitions = landing.raw_competitions(spark, raw_competitions, found, multi_line, sep=None)
    schema = schema or landing.discover_schema(spark, raw_matches, multi_line=multi_line)
    stored = layers.replace(shape.encode_complex(competitions), "bronze", "raw_competitions")
    rows = landing.raw_matches(spark, raw_matches, schema, multi_line, sep=None)
    wanted = rows.where(F.col("season_year").isin(*seasons))
    ids = stored.select(F.col("code").alias("competition_code"), F.col("id").alias("competition_id")).distinct()
    bounded = joins.lookup(wanted, ids, "competition_code").where(F.col("competition_id").isNotNull())
    tagged = shape.tag(bounded, season=F.col("season_year")).drop("season_year", "competition_code")
    return layers.replace(shape.encode_complex(tagged), "bronze", "raw_matches")


def load_directory(layers: Layers, root: str) -> DataFrame:
    """Every parquet dataset of a folder as a bronze table of its name, replaced; returns the inventory."""
    for name, df in landing.scan_directory(layers.spark, root).items():
        layers.replace(shape.encode_strict(df), "bronze", name)
    return catalog.inventory(layers.spark, {"bronze": layers.database("bronze")})


def append_tables(layers: Layers, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Add frames to bronze tables, lists and other JSON text typed as VARIANT. A second run adds the rows again.

    A column that the table has keeps the table's type; only new columns are looked at.
    """
    def typed(name: str, df: DataFrame) -> DataFrame:
        text = shape.encode_complex(df)
        if not layers.exists("bronze", name):
            return shape.promote_json(text)
        stored = {f.name: f.dataType for f in layers.table("bronze", name).schema.fields}
        new = shape.json_columns(text.select(*[F.col(shape.quoted(c)) for c in text.columns if c not in stored]))
        strings = {f.name for f in text.schema.fields if isinstance(f.dataType, T.StringType)}
        kept = [c for c in text.columns if c in strings and isinstance(stored.get(c), T.VariantType)]
        return shape.promote_json(text, [*kept, *new])

    return {name: layers.append(typed(name, df), "bronze", name) for name, df in frames.items()}


def season_folder(season: int) -> str:
    return f"{MATCHES}/season_year={season}"


def build_silver(layers: Layers) -> None:
    matches, competitions = layers.table("bronze", "matches"), layers.table("bronze", "competitions")
    together(
        lambda: layers.replace(staging.stg_matches(staging.newest_matches(matches)), "silver", "stg_matches"),
        lambda: layers.replace(staging.stg_competitions(competitions), "silver", "stg_competitions"),
    )
    layers.replace(staging.stg_teams(layers.table("silver", "stg_matches")), "silver", "stg_teams")


def build_gold(layers: Layers, run_ts: dt.datetime) -> None:
    """The fact first, then the tables on top of it side by side.

    Team tables share one aggregate of the fact, and the league overview folds the yearly
    statistics, so the fact is scanned three times for seven tables.
    """
    stamp = scalars.wall_clock(run_ts)
    matches, names = layers.table("silver", "stg_matches"), layers.table("silver", "stg_competitions")
    # staging keeps the season order of bronze, so a task meets one or two years
    fact = layers.replace(
        marts.fact_matches(matches, names, stamp), "gold", "fact_matches", ("match_year",), clustered=True
    )
    tallies = marts.team_tallies(fact).persist()

    def team_tables() -> None:
        performance = layers.replace(marts.performance_from_tallies(tallies), "gold", "agg_team_performance")
        layers.replace(marts.mart_league_standings(performance), "gold", "mart_league_standings")
        layers.replace(marts.mart_team_stats(tallies), "gold", "mart_team_stats")

    def competition_tables() -> None:
        stats = layers.replace(marts.agg_competition_stats(fact), "gold", "agg_competition_stats")
        layers.replace(marts.mart_match_overview(stats), "gold", "mart_match_overview")

    try:
        together(
            team_tables,
            competition_tables,
            lambda: layers.replace(marts.mart_team_form(fact), "gold", "mart_team_form"),
            lambda: layers.replace(marts.dim_teams(layers.table("silver", "stg_teams")), "gold", "dim_teams"),
        )
    finally:
        tallies.unpersist()


def deliveries(
    layers: Layers, raw_matches: str, leagues: Sequence[str], seasons: Sequence[int], multi_line: bool = False
) -> DataFrame:
    """Document counts of this drop by league and season, as landing.envelope_defects names them, and records held.

    One pass over the scoped folders; at most a row per league and season asked for comes to the driver.
    """
    documents = filters.scope(landing.read_envelopes(layers.spark, raw_matches, multi_line=multi_line), leagues, seasons)
    counted = landing.envelope_defects(documents, by=("competition_code", "season_year"))
    return layers.spark.createDataFrame(counted.collect(), counted.schema)


def contract_tables(layers: Layers) -> dict[str, DataFrame]:
    places = {
        "bronze": ("matches", "competitions"),
        "silver": ("stg_matches", "stg_competitions", "stg_teams"),
        "gold": ("fact_matches", "dim_teams", "mart_team_stats", "mart_league_standings"),
    }
    return {name: layers.table(layer, name) for layer, names in places.items() for name in names}


def gold_health(layers: Layers, *leave_out: str) -> DataFrame:
    names = [n for n in domain.GOLD_TABLE_KEYS if n not in leave_out]
    return quality.table_health({n: layers.table("gold", n) for n in names}, domain.GOLD_TABLE_KEYS)


def run(
    layers: Layers,
    raw_matches: str,
    raw_competitions: str,
    landing_path: str,
    leagues: Sequence[str] = domain.DEFAULT_LEAGUES,
    seasons: Sequence[int] = domain.DEFAULT_SEASONS,
    run_ts: dt.datetime | None = None,
    as_of: dt.date | None = None,
    min_date: str = domain.MIN_MATCH_DATE,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> LoadResult:
    """Run all steps in order. `schema` saves the extra read that finds new payload fields.

    Raises if a season asked for, or the competitions, did not land in a readable form.
    """
    spark = layers.spark
    layers.ensure()
    schema = schema or landing.discover_schema(spark, raw_matches, multi_line=multi_line)
    land(layers, raw_matches, raw_competitions, landing_path, leagues, seasons, schema, multi_line)

    # footers are enough here: the load below decodes every page and reports a season that fails
    required = [*map(season_folder, seasons), COMPETITIONS]
    landed = quality.landing_status(spark, landing_path, required, footers_only=True)
    quality.require_landing(landed)
    # folders of earlier drops are still there; what counts as delivered is what this drop holds
    delivered = deliveries(layers, raw_matches, leagues, seasons, multi_line)
    held = delivered.where(F.col("held") > 0)
    arrived = {r.season_year for r in held.select("season_year").distinct().collect()}

    def read_season(season: int) -> DataFrame:
        return landing.read_parquet(spark, f"{landing_path}/{season_folder(season)}", merge_schema=True)

    def read_all(wanted: Sequence[int]) -> DataFrame:
        rows = landing.read_parquet(spark, f"{landing_path}/{MATCHES}", merge_schema=True)
        return rows.where(F.col("season_year").isin(*wanted))

    loaded = load_seasons(layers, read_season, [s for s in seasons if s in arrived], read_all=read_all)
    absent = [(int(s), 0, "not delivered") for s in seasons if s not in arrived]
    loaded = loaded.unionAll(spark.createDataFrame(absent, loaded.schema))
    competitions = landing.read_parquet(spark, f"{landing_path}/{COMPETITIONS}")
    layers.replace(competitions, "bronze", "competitions")
    build_silver(layers)
    build_gold(layers, run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    contracts = quality.contract_report(contract_tables(layers), leagues, as_of, min_date)
    report = quality.run_report(
        landed, gold_health(layers, "fact_matches"), layers.table("gold", "fact_matches"), contracts,
        delivered.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in quality.PAYLOAD_COUNTS]), loaded,
    )
    missing = quality.missing_loads(held, leagues, seasons)
    return LoadResult(loaded, missing, report)
