"""Named tables, views, layers and stored summaries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.runtime import scratch_path
from tidemark.sources import files

LAYERS = ("raw", "silver", "gold", "ai")


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    buckets: int = 0,
    bucket_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """Create or replace a table whose files live in the shared folder, and read it back."""
    writer = df.write.format(fmt).mode("overwrite").option("path", path or scratch_path(df.sparkSession, name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class LayerPaths:
    """One path root per layer, so that a table is addressed as layer and name."""

    root: str

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{name}"

    def write(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(layer, name))
        return df.sparkSession.read.schema(df.schema).parquet(self.path(layer, name))


@dataclass(frozen=True)
class StoredSummary:
    """A query result kept as files, recomputed whole or for the touched periods only.

    `period` is a coarse, never-NULL column of what `build` returns. Each refresh writes new folders, one for a
    period and version, and then notes the periods it stands for; readers take the newest noted version of a
    period. A period that has become empty is noted without rows, so its old rows are no longer read.
    """

    spark: SparkSession
    path: str
    period: str
    schema: str
    build: Callable[[DataFrame], DataFrame]

    def _notes(self) -> DataFrame:
        kind = f"{self._kind()}, version long"
        self.spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{self.path}/notes/first")
        return self.spark.read.schema(kind).option("recursiveFileLookup", True).parquet(f"{self.path}/notes")

    def _kind(self) -> str:
        field = StructType.fromDDL(self.schema)[self.period]
        return f"{self.period} {field.dataType.simpleString()}"

    def _write(self, rows: DataFrame, periods: DataFrame) -> None:
        version = self._notes().agg(F.coalesce(F.max("version"), F.lit(-1)) + 1).first()[0]
        stamped = rows.withColumn("version", F.lit(version))
        files.write_partitioned(stamped, f"{self.path}/rows", [self.period, "version"], mode="append")
        noted = periods.select(self.period).distinct().withColumn("version", F.lit(version).cast("long"))
        noted.write.parquet(f"{self.path}/notes/v{version}")

    def refresh(self, source: DataFrame) -> None:
        known = self._notes().select(self.period)
        self._write(self.build(source), known.union(source.select(self.period)))

    def refresh_touched(self, source: DataFrame, changed: DataFrame) -> None:
        """Recompute the periods of `changed`; a source partitioned by period is read for these only."""
        touched = changed.select(self.period).distinct()
        self._write(self.build(source.join(touched, self.period, "left_semi")), touched)

    def read(self) -> DataFrame:
        newest = self._notes().groupBy(self.period).agg(F.max("version").alias("version"))
        rows = self.spark.read.schema(f"{self.schema}, version long").parquet(f"{self.path}/rows")
        return rows.join(newest, [self.period, "version"]).drop("version")


def merge_partials(partials: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per key from the partial sums of several arrivals."""
    return partials.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


@dataclass(frozen=True)
class DeltaStore:
    """A keyed table that a stream feeds: one delta per micro-batch, merged when it is read.

    A batch costs what it brings. It writes its own folder, so a replayed batch replaces its own rows.
    `compact` merges what is there into a base; later reads take the newest base and younger deltas.
    """

    spark: SparkSession
    path: str
    schema: str
    merge: Callable[[DataFrame], DataFrame]

    def add(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch_id}")

    def _bases(self) -> DataFrame:
        self.spark.createDataFrame([], "upto long").write.mode("ignore").parquet(f"{self.path}/notes/first")
        return self.spark.read.schema("upto long").option("recursiveFileLookup", True).parquet(f"{self.path}/notes")

    def _raw(self) -> DataFrame:
        base = self._bases().agg(F.max("upto")).first()[0]
        self.spark.createDataFrame([], self.schema).write.mode("ignore").parquet(f"{self.path}/deltas/batch=-1")
        deltas = self.spark.read.schema(f"{self.schema}, batch long").parquet(f"{self.path}/deltas")
        if base is None:
            return deltas.drop("batch")
        kept = self.spark.read.schema(self.schema).parquet(f"{self.path}/bases/upto={base}")
        return kept.unionByName(deltas.filter(F.col("batch") > base).drop("batch"))

    def read(self) -> DataFrame:
        return self.merge(self._raw())

    def compact(self, upto: int) -> None:
        """Merge every delta up to a finished batch. The base is noted after it is written."""
        self.read().write.mode("overwrite").parquet(f"{self.path}/bases/upto={upto}")
        self.spark.createDataFrame([(upto,)], "upto long").write.mode("overwrite").parquet(f"{self.path}/notes/n{upto}")
