"""The bronze, silver and gold databases of the catalog, and every write into them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from matchlake import domain
from matchlake.functions.shape import quoted


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_mode_lock = Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Dynamic partition overwrite for the statements inside; insertInto takes it from the session only."""
    with _mode_lock:
        before = spark.conf.get(_OVERWRITE_MODE)
        spark.conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(_OVERWRITE_MODE, before)


@dataclass(frozen=True)
class Layers:
    """Names and places of the layer databases. `prefix` keeps runs apart in one catalog."""

    spark: SparkSession
    root: str | None = None
    prefix: str = ""

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def databases(self) -> dict[str, str]:
        return {layer: self.database(layer) for layer in domain.LAYERS}

    def name(self, layer: str, table: str) -> str:
        return quoted(self.database(layer), table)

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def ensure(self, *layers: str) -> None:
        for layer in layers or domain.LAYERS:
            place = f" LOCATION '{self.root}/{layer}'" if self.root else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.database(layer))}{place}")

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = (), clustered: bool = False
    ) -> DataFrame:
        """Write the whole table anew.

        The new rows go to a table beside the old one, which gives way once they are complete: a
        rebuild that fails leaves the old rows. A table without partitions then takes the old one's
        name; partitions cannot be renamed, so their files are copied. With `partition_by` the rows are rebalanced on those columns, where AQE splits hot
        values. `clustered=True` says the input is read in that order anyway and saves the shuffle.
        """
        self.ensure(layer)
        fresh = f"{table}__new_{uuid.uuid4().hex[:8]}"
        try:
            df.write.format("parquet").saveAsTable(self.name(layer, fresh))
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, fresh)}")
            raise
        if partition_by:
            complete = self.table(layer, fresh)
            if not clustered:
                complete = complete.hint("rebalance", *[F.col(c) for c in partition_by])
            writer = complete.write.format("parquet").mode("overwrite")
            writer.partitionBy(*partition_by).saveAsTable(self.name(layer, table))
            self.spark.sql(f"DROP TABLE {self.name(layer, fresh)}")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")
            self.spark.sql(f"ALTER TABLE {self.name(layer, fresh)} RENAME TO {self.name(layer, table)}")
        return self.table(layer, table)

    def append(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Add rows, matching columns by name."""
        self.ensure(layer)
        if self.exists(layer, table):
            df = self._aligned(df, layer, table)
        writer = df.write.format("parquet").mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(self.name(layer, table))
        return self.table(layer, table)

    def replace_season(self, df: DataFrame, layer: str, table: str, season: int) -> int:
        """Swap one season's partition and return its rows; other seasons are not touched.

        Dynamic overwrite stages the new files and swaps them in at commit, so a read that fails
        half way leaves the old rows, and a second run leaves the same ones.
        """
        dated = df.drop("season_year").withColumn("season_year", F.lit(int(season)))
        return self.replace_seasons(dated, layer, table, [season])[season]

    def replace_seasons(self, df: DataFrame, layer: str, table: str, seasons: Sequence[int]) -> dict[int, int]:
        """Swap the partitions of all `seasons` that have rows in `df`, in one job; returns the rows of each.

        REBALANCE gives each season even files, as one task would otherwise meet many seasons.
        """
        self.ensure(layer)
        if not self.exists(layer, table):
            df.limit(0).write.format("parquet").partitionBy("season_year").saveAsTable(self.name(layer, table))
        if len(seasons) > 1:
            df = df.hint("rebalance", F.col("season_year"))
        counted = Observation()
        rows = self._aligned(df, layer, table).observe(
            counted, *[F.count_if(F.col("season_year") == s).alias(f"n{s}") for s in seasons]
        )
        with _dynamic_overwrite(self.spark):
            rows.write.mode("overwrite").insertInto(self.name(layer, table))
        return {s: counted.get[f"n{s}"] for s in seasons}

    def _aligned(self, df: DataFrame, layer: str, table: str) -> DataFrame:
        """Columns in table order: new ones are added to the table, absent ones are NULL."""
        target = self.table(layer, table).schema
        known = {f.name.lower() for f in target.fields}
        new = [f for f in df.schema.fields if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({columns})")
            target = self.table(layer, table).schema
        present = {c.lower() for c in df.columns}
        return df.selectExpr(*[
            f"CAST({quoted(f.name) if f.name.lower() in present else 'NULL'} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
            for f in target.fields
        ])


def together(*steps: Callable[[], object], threads: int = 4) -> list:
    """Run independent table builds at once, so one's last tasks do not idle the cluster."""
    with ThreadPoolExecutor(threads) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def load_seasons(
    layers: Layers, read_season: Callable[[int], DataFrame], seasons: Iterable[int], table: str = "matches",
    read_all: Callable[[Sequence[int]], DataFrame] | None = None,
) -> DataFrame:
    """Load each season into its own bronze partition: `(season_year, rows_loaded, error)`.

    With `read_all`, which gives the rows of several seasons with their season_year, one job loads all of
    them. Seasons it has no rows for, and all seasons if that job fails, are loaded one by one. A season that cannot be read is reported and leaves the rest, and its own old rows, as they
    were. An empty season is skipped. The list of seasons is an argument; rows never reach the driver.
    """
    seasons, loaded = list(seasons), {}
    if read_all is not None and seasons:
        try:
            loaded = layers.replace_seasons(read_all(seasons), "bronze", table, seasons)
        except (PySparkException, Py4JJavaError):
            loaded = {}
    outcome = []
    for season in seasons:
        if loaded.get(season):
            outcome.append((season, loaded[season], None))
            continue
        try:
            df = read_season(season)
            rows = 0 if df.isEmpty() else layers.replace_season(df, "bronze", table, season)
            outcome.append((season, rows, None))
        except (PySparkException, Py4JJavaError) as failure:
            outcome.append((season, 0, str(failure).splitlines()[0]))
    return layers.spark.createDataFrame(outcome, "season_year int, rows_loaded bigint, error string")
