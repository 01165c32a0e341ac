"""Writers for the landing area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _size_or_null(payloads: DataFrame, records: str) -> Column:
    fields = payloads.schema["payload"].dataType.fieldNames()
    # array_size is NULL for a missing list, where size would give -1 or NULL by setting
    return F.array_size(F.col(f"payload.{records}")) if records in fields else F.lit(None).cast("int")


def envelope(payloads: DataFrame, extracted_at: Column | None = None) -> DataFrame:
    """Wrap the struct column `payload` of each row; other columns stay as folder keys."""
    count = F.coalesce(_size_or_null(payloads, "matches"), _size_or_null(payloads, "competitions"), F.lit(0))
    stamp = F.current_timestamp() if extracted_at is None else extracted_at
    return payloads.select(
        *[c for c in payloads.columns if c != "payload"],
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        F.col("payload").alias("data"),
        count.cast("bigint").alias("record_count"),
    )


def write_envelopes(
    payloads: DataFrame, path: str, folders: tuple[str, ...] = (), extracted_at: Column | None = None
) -> None:
    """One JSON document per line, under a folder per key. Row by row: nothing is gathered.

    Only the folders in `payloads` are replaced, whatever overwrite mode the session has.
    """
    writer = envelope(payloads, extracted_at).write.mode("overwrite").option("ignoreNullFields", "false")
    writer = writer.option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*folders) if folders else writer).json(path)


def write_by_season(df: DataFrame, path: str, clustered: bool = False) -> None:
    """Parquet with one folder per season; a season without rows gets none.

    Only the seasons in `df` are replaced, so landing one season again leaves the rest. REBALANCE lets AQE split a season that holds much of the data and merge small ones, so
    file sizes are even. Pass `clustered=True` when the input is read season by season
    already, which saves that shuffle.
    """
    rows = df if clustered else df.hint("rebalance", F.col("season_year"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("season_year").parquet(path)
