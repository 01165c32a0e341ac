"""The registered queries: one per operator, each over match data derived from the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions import scalars, shape
from matchlake.operators import filters, joins, reports, sets
from matchlake.plans import marts, quality, staging, weekly
from matchlake.session import new_scratch
from matchlake.sinks import landing as landing_sink
from matchlake.sinks.layers import Layers, load_seasons
from matchlake.sources import catalog, derived, landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# arguments of the report queries
TEAM, CODE, NAME, LABEL, YEAR = "Team 7", "PL", "La Liga", "FL1 - Ligue 1", 1997
RUN_TS = dt.datetime(2025, 1, 6, 4, 30)
AS_OF, MIN_DATE = dt.date(2000, 12, 1), "1996-01-01"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def register(**named: Query) -> None:
    QUERIES.update(named)


# -- inputs ---------------------------------------------------------------------------------

def orders(spark: SparkSession, sf: str) -> DataFrame:
    return derived.table(spark, sf, "orders")


def seasons(spark: SparkSession, sf: str, margin: int = 0) -> range:
    """The years of the derived matches, and `margin` years without any on both sides."""
    first, last = orders(spark, sf).agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return range(first - margin, last + margin + 1)


def fact(spark: SparkSession, sf: str, finished_only: bool = False) -> DataFrame:
    return derived.fact(orders(spark, sf), finished_only=finished_only)


def played(spark: SparkSession, sf: str) -> DataFrame:
    """The fact for models over finished matches, with the filter on the raw status."""
    return fact(spark, sf, finished_only=True)


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_competition_stats(played(spark, sf))


def performance(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_team_performance(played(spark, sf))


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return derived.bronze(orders(spark, sf))


def nested(spark: SparkSession, sf: str) -> DataFrame:
    return derived.nested_matches(orders(spark, sf))


def stamped_fact(spark: SparkSession, sf: str) -> DataFrame:
    return derived.fact(orders(spark, sf), scalars.wall_clock(RUN_TS))


def competitions(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_competitions(derived.competitions(orders(spark, sf)))


def teams(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_teams(staging.stg_teams(derived.staged(orders(spark, sf))))


def partial_teams(spark: SparkSession, sf: str) -> DataFrame:
    """The team dimension of a load that asked for two of the three leagues."""
    in_scope = derived.staged(orders(spark, sf)).where(F.col("league_code").isin("PL", "FL1"))
    return marts.dim_teams(staging.stg_teams(in_scope))


def fresh_layers(spark: SparkSession, label: str) -> Layers:
    """Layer databases of their own, in a new folder under the shared scratch root."""
    return Layers(spark, new_scratch(spark, label), f"ml_{uuid.uuid4().hex[:12]}_")


_written: dict[tuple[str, str, str], str] = {}


def written_once(spark: SparkSession, sf: str, label: str, write: Callable[[str], None]) -> str:
    """Path of a derived landing folder, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _written:
        path = new_scratch(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def raw_match_folder(spark: SparkSession, sf: str) -> str:
    payloads = derived.match_payloads(orders(spark, sf)).drop("page")
    return written_once(spark, sf, "raw-matches", lambda path: landing_sink.write_envelopes(
        payloads, path, ("competition_code", "season_year"), scalars.wall_clock(RUN_TS)
    ))


def raw_competition_folder(spark: SparkSession, sf: str) -> str:
    payloads = derived.competition_payloads(orders(spark, sf))
    return written_once(spark, sf, "raw-competitions", lambda path: landing_sink.write_envelopes(
        payloads, path, (), scalars.wall_clock(RUN_TS)
    ))


def landing_folder(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        landing_sink.write_by_season(bronze(spark, sf), f"{path}/{weekly.MATCHES}")
        derived.competitions(orders(spark, sf)).write.parquet(f"{path}/{weekly.COMPETITIONS}")

    return written_once(spark, sf, "landing", write)


# -- sources --------------------------------------------------------------------------------

@query
def src_raw_matches(spark: SparkSession, sf: str) -> DataFrame:
    path = raw_match_folder(spark, sf)
    schema = landing.discover_schema(spark, path)
    return shape.encode_complex(landing.raw_matches(spark, path, schema))


@query
def src_raw_competitions(spark: SparkSession, sf: str) -> DataFrame:
    return landing.raw_competitions(spark, raw_competition_folder(spark, sf))


@query
def src_parquet(spark: SparkSession, sf: str) -> DataFrame:
    return landing.read_parquet(spark, f"{landing_folder(spark, sf)}/{weekly.MATCHES}")


@query
def src_competition_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = landing.competition_ids(landing.raw_competitions(spark, raw_competition_folder(spark, sf)))
    matches = orders(spark, sf).select(
        F.col("o_orderkey").alias("match_id"), (F.col("o_custkey") % 3 + 2000).alias("competition_id")
    )
    return joins.lookup(matches, ids, "competition_id", "left_semi").select("match_id", "competition_id")


@query
def src_dir_scan(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.row_counts(landing.scan_directory(spark, landing_folder(spark, sf)))


@query
def src_table_query(spark: SparkSession, sf: str) -> DataFrame:
    text = """
        SELECT home_team_name, COUNT(*) AS matches, SUM(total_goals) AS goals
        FROM {fact} WHERE competition_code = :code AND match_year >= :year
        GROUP BY home_team_name
    """
    return catalog.table_query(spark, text, {"code": CODE, "year": YEAR}, fact=played(spark, sf))


@query
def src_inventory(spark: SparkSession, sf: str) -> DataFrame:
    layers = fresh_layers(spark, "inventory")
    layers.replace(bronze(spark, sf), "bronze", "matches")
    layers.replace(derived.competitions(orders(spark, sf)), "bronze", "competitions")
    layers.replace(staging.stg_matches(bronze(spark, sf)), "silver", "stg_matches")
    layers.replace(performance(spark, sf), "gold", "agg_team_performance")
    return catalog.inventory(spark, layers.databases())


# -- sinks ----------------------------------------------------------------------------------

@query
def snk_raw_envelope(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "envelope")
    payloads = derived.match_payloads(orders(spark, sf)).drop("page")
    landing_sink.write_envelopes(payloads, path, ("competition_code", "season_year"), scalars.wall_clock(RUN_TS))
    # writing one league and season again must leave the others
    again = payloads.where((F.col("competition_code") == CODE) & (F.col("season_year") == YEAR))
    landing_sink.write_envelopes(again, path, ("competition_code", "season_year"), scalars.wall_clock(RUN_TS))
    documents = landing.read_envelopes(spark, path)
    return documents.select(
        "competition_code", "season_year", "extracted_at", "record_count",
        F.size("data.matches").cast("bigint").alias("matches"),
        F.array_min("data.matches.id").alias("first_id"), F.array_max("data.matches.id").alias("last_id"),
    )


@query
def snk_parquet_by_season(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "by-season")
    landing_sink.write_by_season(bronze(spark, sf), path)
    # landing one season again must leave the others
    landing_sink.write_by_season(filters.season(bronze(spark, sf), 1996), path)
    return spark.read.parquet(path).select("id", "utcDate", "status", "competition_code", "season_year")


@query
def snk_replace(spark: SparkSession, sf: str) -> DataFrame:
    layers = fresh_layers(spark, "replace")
    layers.replace(filters.season(bronze(spark, sf), 1995), "bronze", "matches")
    return layers.replace(bronze(spark, sf).select("id", "status", "season_year"), "bronze", "matches")


@query
def snk_append(spark: SparkSession, sf: str) -> DataFrame:
    layers = fresh_layers(spark, "append")
    rows = bronze(spark, sf).select("id", "status", "season_year")
    layers.append(rows, "bronze", "all_matches")
    return layers.append(rows.drop("status"), "bronze", "all_matches")


@query
def snk_load_seasons(spark: SparkSession, sf: str) -> DataFrame:
    layers, root = fresh_layers(spark, "seasons"), landing_folder(spark, sf)

    def read_season(season: int) -> DataFrame:
        return landing.read_parquet(spark, f"{root}/{weekly.season_folder(season)}")

    def read_all(wanted: Sequence[int]) -> DataFrame:
        return landing.read_parquet(spark, f"{root}/{weekly.MATCHES}").where(F.col("season_year").isin(*wanted))

    outcome = load_seasons(layers, read_season, seasons(spark, sf, 1), read_all=read_all)
    stored = layers.table("bronze", "matches").groupBy("season_year").agg(F.count(F.lit(1)).alias("rows_stored"))
    return outcome.join(stored, "season_year", "left").select(
        "season_year", "rows_loaded", F.coalesce("rows_stored", F.lit(0)).alias("rows_stored"),
        F.col("error").isNotNull().alias("failed"),
    )


@query
def snk_layer_schema(spark: SparkSession, sf: str) -> DataFrame:
    layers = fresh_layers(spark, "schemas")
    layers.ensure()
    layers.ensure()
    for layer in layers.databases():
        layers.replace(bronze(spark, sf).select("id"), layer, "matches")
    return catalog.inventory(spark, layers.databases())


@query
def snk_model_table(spark: SparkSession, sf: str) -> DataFrame:
    layers = fresh_layers(spark, "models")
    matches = layers.replace(staging.stg_matches(bronze(spark, sf)), "silver", "stg_matches")
    names = layers.replace(competitions(spark, sf), "silver", "stg_competitions")
    stamp = scalars.wall_clock(RUN_TS)
    return layers.replace(marts.fact_matches(matches, names, stamp), "gold", "fact_matches", ("match_year",))


@query
def load_unflattened(spark: SparkSession, sf: str) -> DataFrame:
    """The unflattened load over the leagues of a narrower competition list."""
    path = new_scratch(spark, "two-competitions")
    found = derived.competitions(orders(spark, sf)).where(F.col("code") != "PD")
    payloads = found.select(F.struct(F.array(F.struct("id", "code", "name")).alias("competitions")).alias("payload"))
    landing_sink.write_envelopes(payloads, path, (), scalars.wall_clock(RUN_TS))
    layers = fresh_layers(spark, "unflattened")
    return weekly.load_unflattened(layers, raw_match_folder(spark, sf), path, seasons(spark, sf))


@query
def load_directory(spark: SparkSession, sf: str) -> DataFrame:
    return weekly.load_directory(fresh_layers(spark, "directory"), landing_folder(spark, sf))


@query
def append_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Matches with a typed list column, appended by two runs."""
    layers, rows = fresh_layers(spark, "appended"), shape.flatten(nested(spark, sf).select("id", "status", "referees"))
    for _ in range(2):
        weekly.append_tables(layers, {"all_matches": rows})
    # plain text and JSON in any order: the table's type holds
    key = F.col("id").cast("string")
    text = F.when(F.col("id") % 3 == 0, F.concat(F.lit('[{"id":'), key, F.lit("}]"))).otherwise(F.concat(F.lit("plain "), key))
    table = weekly.append_tables(layers, {"all_matches": rows.withColumn("referees", text)})["all_matches"]
    return table.select(
        "id", "status", F.to_json("referees").alias("referees"),
        F.try_variant_get("referees", "$[0].id", "bigint").alias("first_referee"),
    )


# -- projections ----------------------------------------------------------------------------

def _listed(df: DataFrame) -> DataFrame:
    """The list column shown by its length; flattening leaves it as it was."""
    return df.withColumn("referees", F.size("referees").cast("bigint"))


register(
    prj_flatten=lambda spark, sf: _listed(shape.flatten(nested(spark, sf))),
    prj_flatten_dot=lambda spark, sf: _listed(shape.flatten(nested(spark, sf), ".")),
    prj_tag=lambda spark, sf: shape.tag(
        shape.flatten(nested(spark, sf).select("id", "competition")), competition_code="PL", season_year=2023
    ),
    prj_tag_raw=lambda spark, sf: shape.tag(
        nested(spark, sf).select("id", "season"), season=2023, competition_id=2021
    ),
    prj_json_encode=lambda spark, sf: shape.encode_complex(nested(spark, sf)),
    prj_json_encode_strict=lambda spark, sf: shape.encode_strict(
        nested(spark, sf).select(
            "id", "score", "referees",
            F.array(F.col("score.fullTime.home"), F.col("score.fullTime.away")).alias("goals"),
        )
    ),
    prj_rename_cast=lambda spark, sf: staging.stg_matches(bronze(spark, sf)),
    prj_null_handling=lambda spark, sf: staging.stg_matches(bronze(spark, sf)).groupBy("status", "match_result").agg(
        F.count(F.lit(1)).alias("matches"), F.count("full_time_home_score").alias("scored")
    ),
    prj_match_result=lambda spark, sf: fact(spark, sf).select("match_id", "match_outcome"),
    prj_total_goals=lambda spark, sf: fact(spark, sf).select("match_id", "total_goals"),
    prj_loaded_at=lambda spark, sf: stamped_fact(spark, sf).select("match_id", "loaded_at"),
    prj_team_result=lambda spark, sf: filters.team_either_side(fact(spark, sf), TEAM).select(
        "match_id", scalars.team_result(TEAM).alias("result")
    ),
    prj_score_label=lambda spark, sf: fact(spark, sf).select(
        "match_id",
        scalars.score_label(F.col("fulltime_home_score"), F.col("fulltime_away_score")).alias("score"),
        scalars.match_label(
            F.col("home_team_name"), F.col("fulltime_home_score"), F.col("fulltime_away_score"), F.col("away_team_name")
        ).alias("match"),
    ),
    prj_report_cols=lambda spark, sf: reports.standings_display(performance(spark, sf), CODE),
    prj_recent_cols=lambda spark, sf: reports.recent_display(fact(spark, sf), 10),
    prj_team_overview=lambda spark, sf: reports.team_overview(performance(spark, sf), TEAM),
    prj_goals_trend=lambda spark, sf: reports.goals_trend(stats(spark, sf), NAME),
    prj_high_scoring=lambda spark, sf: reports.high_scoring(stats(spark, sf), label=LABEL),
    prj_unpivot_outcomes=lambda spark, sf: reports.outcome_series(stats(spark, sf), NAME),
    prj_unpivot_wdl=lambda spark, sf: reports.results_of_team(performance(spark, sf), TEAM),
    prj_unpivot_venue=lambda spark, sf: reports.venues_of_team(performance(spark, sf), TEAM),
)


@query
def prj_json_type(spark: SparkSession, sf: str) -> DataFrame:
    typed = shape.promote_json(derived.table(spark, sf, "events").select("event_id", "event_type", "props"))
    return typed.select(
        "event_id", "event_type", F.schema_of_variant("props").alias("shape"),
        F.try_variant_get("props", "$.k", "bigint").alias("k"),
    )


@query
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    """The remaining scalar functions, over every match."""
    rows = bronze(spark, sf)
    ts = scalars.iso_timestamp(F.col("utcDate"))
    label = F.concat(F.col("competition_code"), F.lit(" - any name"))
    return rows.select(
        "id",
        ts.alias("ts"),
        scalars.calendar_year(ts).alias("year"),
        scalars.iso_text(ts).alias("iso"),
        scalars.code_of_label(label).alias("code"),
        scalars.percentage(F.col("score_fullTime_home"), F.col("score_fullTime_home") + F.col("score_fullTime_away")).alias(
            "home_share"
        ),
        scalars.ratio(F.col("score_fullTime_home"), F.lit(2)).alias("half"),
    )


# -- filters --------------------------------------------------------------------------------

register(
    flt_season=lambda spark, sf: filters.season(src_parquet(spark, sf), 1996),
    flt_year=lambda spark, sf: filters.year(stats(spark, sf), YEAR),
    flt_competition=lambda spark, sf: filters.competition(stats(spark, sf), LABEL),
    flt_exact=lambda spark, sf: filters.exact(stats(spark, sf), "competition_name", NAME),
    flt_team_either_side=lambda spark, sf: filters.team_either_side(fact(spark, sf), TEAM).drop("loaded_at"),
    flt_finished=lambda spark, sf: filters.finished(played(spark, sf)).select("match_id", "status", "total_goals"),
    flt_scope=lambda spark, sf: filters.scope(bronze(spark, sf), ("PL", "PD"), (1996, 1997)),
    flt_status_domain=lambda spark, sf: filters.status_in(bronze(spark, sf), ("FINISHED", "PAUSED")),
)


@query
def flt_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    frames = {s: filters.season(src_parquet(spark, sf), s) for s in seasons(spark, sf, 1)}
    return catalog.row_counts({str(s): df for s, df in filters.nonempty(frames).items()})


# -- models, joins and windows --------------------------------------------------------------

register(
    stg_matches=lambda spark, sf: staging.stg_matches(bronze(spark, sf)),
    stg_competitions=competitions,
    stg_teams=lambda spark, sf: staging.stg_teams(derived.staged(orders(spark, sf))),
    agg_dim_teams=teams,
    fact_matches=lambda spark, sf: stamped_fact(spark, sf),
    agg_competition_stats=stats,
    agg_team_performance=performance,
    mart_team_stats=lambda spark, sf: marts.mart_team_stats(marts.team_tallies(played(spark, sf))),
    mart_match_overview=lambda spark, sf: marts.mart_match_overview(stats(spark, sf)),
    mart_league_standings=lambda spark, sf: marts.mart_league_standings(performance(spark, sf)),
    mart_team_form=lambda spark, sf: marts.mart_team_form(played(spark, sf)),
    join_anti_team=lambda spark, sf: joins.orphans(fact(spark, sf), partial_teams(spark, sf)).select(
        "match_id", "home_team_id"
    ),
    join_competition=lambda spark, sf: marts.fact_matches(
        derived.staged(orders(spark, sf)).drop("competition_name"), competitions(spark, sf), scalars.wall_clock(RUN_TS)
    ).select("match_id", "competition_code", "competition_name"),
)

# -- aggregates and reports -----------------------------------------------------------------

register(
    agg_table_stats=lambda spark, sf: reports.table_stats(fact(spark, sf), "match_id"),
    agg_key_metrics=lambda spark, sf: reports.key_metrics(fact(spark, sf)),
    agg_freshness=lambda spark, sf: reports.freshness(stamped_fact(spark, sf)),
    agg_count=lambda spark, sf: reports.row_count(bronze(spark, sf)),
    agg_date_range=lambda spark, sf: reports.date_range(bronze(spark, sf)),
    agg_by_year=lambda spark, sf: reports.matches_by_year(bronze(spark, sf)),
    agg_kpi=lambda spark, sf: reports.key_figures(stats(spark, sf), performance(spark, sf), YEAR, LABEL),
    agg_kpi_competition=lambda spark, sf: reports.competition_figures(stats(spark, sf), NAME),
    agg_matches_by_competition=lambda spark, sf: reports.matches_by_competition(stats(spark, sf)),
    agg_home_away_mean=lambda spark, sf: reports.outcome_means(stats(spark, sf)),
    agg_goal_distribution=lambda spark, sf: reports.goal_distribution(stats(spark, sf)),
    agg_distinct_values=lambda spark, sf: reports.distinct_values(performance(spark, sf), "team_name"),
    agg_form_counts=lambda spark, sf: reports.form_counts(fact(spark, sf), TEAM),
    # a season appended twice, as a re-run of an appending load leaves it
    agg_having_dup=lambda spark, sf: reports.duplicates(
        sets.concat([fact(spark, sf), filters.year(fact(spark, sf), 1995)]), "match_id"
    ),
    srt_competition_stats=lambda spark, sf: reports.competition_table(stats(spark, sf)),
    srt_team_performance=lambda spark, sf: reports.performance_table(performance(spark, sf)),
    srt_league_table=lambda spark, sf: reports.league_table(performance(spark, sf), CODE),
    top_recent_matches=lambda spark, sf: reports.recent_matches(fact(spark, sf)),
    top_first_last_matches=lambda spark, sf: reports.first_and_last(bronze(spark, sf)),
    top_team_points5=lambda spark, sf: reports.top_teams(marts.mart_team_stats(marts.team_tallies(played(spark, sf)))),
    top_points=lambda spark, sf: reports.most_points(performance(spark, sf), CODE),
    top_goals=lambda spark, sf: reports.most_goals(performance(spark, sf), CODE),
    top_defense=lambda spark, sf: reports.best_defense(performance(spark, sf), CODE),
    top_standings20=lambda spark, sf: reports.standings_chart(performance(spark, sf), CODE),
    top_team_matches20=lambda spark, sf: reports.team_recent(fact(spark, sf), TEAM),
    lim_sample=lambda spark, sf: reports.sample_rows(bronze(spark, sf), "id", 5),
    sel_first_row=lambda spark, sf: reports.team_row(performance(spark, sf), TEAM),
)

# -- set operations -------------------------------------------------------------------------

@query
def set_concat(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze(spark, sf).select("id", "status", "score_halfTime_home", "season_year")
    older = rows.where(F.col("season_year") < YEAR).drop("score_halfTime_home")
    return sets.concat([older, rows.where(F.col("season_year") >= YEAR)])


@query
def set_extend(spark: SparkSession, sf: str) -> DataFrame:
    root = raw_match_folder(spark, sf)
    paths = [f"{root}/competition_code={r.code}" for r in derived.competitions(orders(spark, sf)).collect()]
    return landing.raw_matches(spark, paths, base_path=root).select("id", "utcDate", "competition_code", "season_year")


@query
def set_union_counts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.row_counts({
        "fact_matches": fact(spark, sf), "dim_teams": teams(spark, sf), "agg_team_performance": performance(spark, sf),
    })


# -- quality --------------------------------------------------------------------------------

register(
    dq_unique=lambda spark, sf: quality.unique(fact(spark, sf), "fact_matches", "match_id").unionAll(
        quality.unique(fact(spark, sf), "fact_matches", "home_team_id")
    ),
    dq_not_null=lambda spark, sf: quality.row_checks(
        fact(spark, sf), "fact_matches", quality.not_null("match_id", "home_team_id", "fulltime_home_score", "winner")
    ),
    dq_accepted_values=lambda spark, sf: quality.row_checks(
        staging.stg_matches(bronze(spark, sf)), "stg_matches",
        [*quality.silver_rules(("PL", "FL1")), quality.accepted_values("winner", ("HOME_TEAM", "DRAW"))],
    ),
    dq_valid_scores=lambda spark, sf: quality.row_checks(fact(spark, sf), "fact_matches", [quality.valid_scores()]),
    dq_halftime=lambda spark, sf: quality.row_checks(
        fact(spark, sf), "fact_matches", [quality.halftime_within_fulltime()]
    ),
    dq_dates=lambda spark, sf: quality.row_checks(
        fact(spark, sf), "fact_matches", [quality.reasonable_dates(AS_OF, MIN_DATE)]
    ),
    dq_no_duplicates=lambda spark, sf: quality.no_duplicates(fact(spark, sf), "fact_matches", "match_id"),
    dq_ref_integrity=lambda spark, sf: quality.referential_integrity(fact(spark, sf), partial_teams(spark, sf)),
    dq_missing_loads=lambda spark, sf: quality.missing_loads(
        bronze(spark, sf), ("PL", "FL1", "PD", "BL1"), seasons(spark, sf, 1)
    ),
    dq_landing_files=lambda spark, sf: quality.landing_status(
        spark, landing_folder(spark, sf), [*map(weekly.season_folder, seasons(spark, sf, 1)), weekly.COMPETITIONS]
    ),
)


@query
def dq_nonempty_allnull(spark: SparkSession, sf: str) -> DataFrame:
    scores = fact(spark, sf).select("fulltime_home_score", "fulltime_away_score", "winner")
    return quality.row_checks(scores, "scores", [quality.all_null_rows(scores)], nonempty=True)


@query
def dq_payload_defects(spark: SparkSession, sf: str) -> DataFrame:
    """A drop of one document per match, some cut short, some without a list, some with a wrong count."""
    key, path = F.col("o_orderkey"), new_scratch(spark, "defects")
    whole = F.format_string('{"extracted_at":"x","data":{"matches":[{"id":%d}]},"record_count":%d}', key, F.when(key % 13 == 0, 2).otherwise(1))
    text = F.when(key % 7 == 0, F.substring(whole, 1, 30)).when(key % 11 == 0, '{"extracted_at":"x","data":{},"record_count":0}').otherwise(whole)
    orders(spark, sf).select(text.alias("value")).write.text(path)
    return landing.envelope_defects(landing.read_envelopes(spark, path))


def _weekly(spark: SparkSession, sf: str, label: str) -> tuple[Layers, weekly.LoadResult]:
    layers = fresh_layers(spark, label)
    result = weekly.run(
        layers, raw_match_folder(spark, sf), raw_competition_folder(spark, sf), new_scratch(spark, f"{label}-landing"),
        seasons=seasons(spark, sf), run_ts=RUN_TS, as_of=AS_OF, min_date=MIN_DATE,
    )
    return layers, result


@query
def dq_gold_tables(spark: SparkSession, sf: str) -> DataFrame:
    layers, rows = fresh_layers(spark, "gold"), fact(spark, sf)
    layers.replace(rows, "gold", "fact_matches", ("match_year",))
    layers.replace(teams(spark, sf), "gold", "dim_teams")
    layers.replace(performance(spark, sf), "gold", "agg_team_performance")
    layers.replace(stats(spark, sf), "gold", "agg_competition_stats")
    return weekly.gold_health(layers)


@query
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return _weekly(spark, sf, "weekly")[1].report
