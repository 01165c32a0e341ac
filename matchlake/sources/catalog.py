"""Reading catalog tables: parameterised SQL and an inventory of the layers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_query(
    spark: SparkSession, text: str, params: Mapping[str, object] | None = None, **frames: DataFrame
) -> DataFrame:
    """SQL text with bound `:name` parameters; `{name}` stands for a DataFrame passed by keyword."""
    return spark.sql(text, args=dict(params or {}), **frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """`(table_name, row_count)` for each table, as one job."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def inventory(spark: SparkSession, databases: Mapping[str, str]) -> DataFrame:
    """`(layer, table_name, row_count)` of every table in the databases, given as layer -> database."""
    parts = []
    for layer, database in databases.items():
        if not spark.catalog.databaseExists(database):
            continue
        tables = {
            t.name: spark.table(f"`{database}`.`{t.name}`")
            for t in spark.catalog.listTables(database)
            if not t.isTemporary
        }
        if tables:
            parts.append(row_counts(tables).select(F.lit(layer).alias("layer"), "table_name", "row_count"))
    if not parts:
        return spark.createDataFrame([], "layer string, table_name string, row_count bigint")
    return reduce(DataFrame.unionAll, parts)
