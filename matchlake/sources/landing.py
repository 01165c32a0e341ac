"""Readers for landed payloads: JSON envelopes and parquet datasets.

An envelope is one JSON document `{extracted_at, data: {matches | competitions: [...]}, record_count}`.
Documents sit under `competition_code=<code>/season_year=<year>/` folders, so the tags of a
record come from its folder and a season filter prunes folders. One document per line keeps the
files splittable; pretty-printed files need `multi_line=True` and are read one file per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions import shape


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEAM = _struct(id=T.LongType(), name=T.StringType())
_SCORE = _struct(home=T.LongType(), away=T.LongType())

# leaves whose types are fixed whatever a drop happens to hold
KNOWN_MATCH = _struct(
    id=T.LongType(), utcDate=T.StringType(), status=T.StringType(), homeTeam=_TEAM, awayTeam=_TEAM,
    score=_struct(winner=T.StringType(), fullTime=_SCORE, halfTime=_SCORE),
)
KNOWN_COMPETITION = _struct(id=T.LongType(), code=T.StringType(), name=T.StringType())

CORRUPT = "_corrupt_record"


def _envelope(records: str, record: T.StructType) -> T.StructType:
    return _struct(extracted_at=T.StringType(), data=_struct(**{records: T.ArrayType(record)}), record_count=T.LongType())


MATCH_ENVELOPE = _envelope("matches", KNOWN_MATCH)
COMPETITION_ENVELOPE = _envelope("competitions", KNOWN_COMPETITION)


def _overlay(found: T.DataType, known: T.DataType) -> T.DataType:
    """`found` with the types of `known` where both have a field; fields of either side stay."""
    if isinstance(found, T.StructType) and isinstance(known, T.StructType):
        there = {f.name: f.dataType for f in found.fields}
        # known fields first, in their order: JSON text made of them does not depend on the drop
        fixed = [T.StructField(f.name, _overlay(there.pop(f.name), f.dataType) if f.name in there else f.dataType) for f in known.fields]
        return T.StructType(fixed + [T.StructField(n, t) for n, t in there.items()])
    if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
        return T.ArrayType(_overlay(found.elementType, known.elementType))
    return known


def _json_reader(spark: SparkSession, multi_line: bool, base_path: str | None):
    reader = spark.read.option("multiLine", multi_line)
    return reader.option("basePath", base_path) if base_path else reader


def discover_schema(
    spark: SparkSession, paths: str | Sequence[str], known: T.StructType = MATCH_ENVELOPE, multi_line: bool = False
) -> T.StructType:
    """Schema of a drop: every field found in it, with the known leaves at their fixed types.

    This reads the drop once more, so call it per new season rather than over the
    whole landing area, and pass the result to the readers.
    """
    found = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", "true").json(paths).schema
    kept = T.StructType([f for f in found.fields if f.name != CORRUPT])
    return _overlay(kept, known)


def read_envelopes(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = MATCH_ENVELOPE,
    multi_line: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """One row per document; text that is not JSON arrives in `_corrupt_record`."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = _json_reader(spark, multi_line, base_path).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(with_corrupt).json(paths)


def envelope_defects(envelopes: DataFrame, records: str = "matches", by: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each value of the columns `by`: documents read, documents that did not parse, documents without the record list, and
    documents whose record_count is not the number of their records; records announced and held."""
    corrupt = F.col(CORRUPT).isNotNull()
    absent = ~corrupt & F.col(f"data.{records}").isNull()
    held = F.array_size(f"data.{records}")
    miscounted = ~corrupt & ~absent & ~F.col("record_count").eqNullSafe(held.cast("bigint"))
    return envelopes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(corrupt).alias("corrupt"),
        F.count_if(absent).alias("without_records"),
        F.count_if(miscounted).alias("miscounted"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("records"),
        F.coalesce(F.sum(held), F.lit(0)).cast("bigint").alias("held"),
    )


def _records(envelopes: DataFrame, records: str, tags: Sequence[str]) -> DataFrame:
    exploded = envelopes.select(*tags, F.explode(f"data.{records}").alias("_record"))
    fields = exploded.schema["_record"].dataType.fieldNames()
    return exploded.select(*[F.col(shape.quoted("_record", n)) for n in fields], *tags)


def _explode_tagged(envelopes: DataFrame, records: str, tags: Mapping[str, Column | object], sep: str | None) -> DataFrame:
    """One row per record with its document's tags, which replace record fields of their name."""
    held = {f"_tag_{name}": value if isinstance(value, Column) else F.lit(value) for name, value in tags.items()}
    rows = _records(envelopes.withColumns(held), records, list(held))
    flat = rows if sep is None else shape.flatten(rows, sep)
    return shape.tag(flat, **{name: F.col(f"_tag_{name}") for name in tags}).drop(*held)


def raw_matches(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = MATCH_ENVELOPE,
    multi_line: bool = False,
    base_path: str | None = None,
    sep: str | None = "_",
    carried: Sequence[str] = (),
    **tags: object,
) -> DataFrame:
    """One row per landed match, flattened with `sep` and tagged.

    Tags are the folder columns, the document's columns named in `carried`, and the constants passed as keywords for a folder of one
    league and season. `sep=None` keeps the nested fields.
    """
    envelopes = read_envelopes(spark, paths, schema, multi_line, base_path)
    folders = {c: F.col(c) for c in envelopes.columns if c not in schema.fieldNames() and c != CORRUPT}
    return _explode_tagged(envelopes, "matches", {**folders, **{c: F.col(c) for c in carried}, **tags}, sep)


# matches_<code>_<season>.json
_FILE_NAME = r"^matches_(.+)_(\d+)\.json$"


def raw_matches_by_file_name(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = MATCH_ENVELOPE,
    multi_line: bool = True,
    sep: str | None = "_",
) -> DataFrame:
    """As raw_matches for a flat folder of `matches_<code>_<season>.json` files; other files are left out."""
    reader = spark.read.option("pathGlobFilter", "matches_*.json").option("multiLine", multi_line)
    envelopes = reader.schema(schema).json(folder).withColumn("_file", F.col("_metadata.file_name"))
    named = envelopes.where(F.col("_file").rlike(_FILE_NAME))
    tags = {
        "competition_code": F.regexp_extract("_file", _FILE_NAME, 1),
        "season_year": F.regexp_extract("_file", _FILE_NAME, 2).cast("int"),
    }
    return _explode_tagged(named, "matches", tags, sep)


def raw_competitions(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = COMPETITION_ENVELOPE,
    multi_line: bool = False,
    sep: str | None = ".",
) -> DataFrame:
    return _explode_tagged(read_envelopes(spark, paths, schema, multi_line), "competitions", {}, sep)


def competition_ids(competitions: DataFrame) -> DataFrame:
    """The ids that bound a match load; join them with `left_semi`, never collect them."""
    return competitions.select(F.col("id").alias("competition_id")).distinct()


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None, merge_schema: bool = False
) -> DataFrame:
    """Landing parquet. A given schema saves the footer read; `merge_schema` takes in later columns."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def scan_directory(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every parquet dataset directly under `root`, keyed by its name without the suffix.

    Spark lists the files (content is never read); only the dataset names reach the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    # paths come back with the scheme written in different ways, so cut at the folder itself
    folder = root.split(":", 1)[-1].strip("/")
    below = F.split_part(F.col("path"), F.lit(f"/{folder}/"), F.lit(2))
    entries = files.select(F.split_part(below, F.lit("/"), F.lit(1)).alias("entry")).distinct().collect()
    return {
        e.entry.removesuffix(".parquet"): read_parquet(spark, f"{root.rstrip('/')}/{e.entry}")
        for e in sorted(entries)
    }
