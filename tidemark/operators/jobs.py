"""Warehouse jobs: incremental models, versioned dimensions, daily metrics, expiry and tiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.changes import latest_per_key
from tidemark.sources import files


@dataclass(frozen=True)
class IncrementalModel:
    """A table partitioned by `period` that is brought up to date from the rows that came after its mark.

    A run finds the periods of the source rows newer than the newest row built in, builds those periods from all their
    rows, and replaces just these partitions. A run that is repeated, or fails half way and is repeated, ends the same: the
    mark is written after the partitions. The first run builds everything.
    """

    spark: SparkSession
    path: str
    period: str
    updated: str
    build: Callable[[DataFrame], DataFrame]

    def _marks(self) -> DataFrame:
        self.spark.createDataFrame([], "mark timestamp").write.mode("ignore").parquet(f"{self.path}/marks/first")
        return self.spark.read.schema("mark timestamp").option("recursiveFileLookup", True).parquet(f"{self.path}/marks")

    def run(self, source: DataFrame) -> None:
        mark = self._marks().agg(F.max("mark")).first()[0]
        time = F.col(self.updated).cast("timestamp")
        fresh = source if mark is None else source.filter(time > F.lit(mark))
        newest = fresh.agg(F.max(time)).first()[0]
        if newest is None:
            return
        touched = fresh.select(self.period).distinct()
        built = self.build(source.join(touched, self.period, "left_semi") if mark is not None else source)
        if mark is None:
            files.write_partitioned(built, f"{self.path}/rows", [self.period])
        else:
            files.overwrite_touched(built, f"{self.path}/rows", [self.period])
        done = self.spark.range(1).select(F.lit(newest).cast("timestamp").alias("mark"))
        done.coalesce(1).write.parquet(f"{self.path}/marks/{newest:%Y%m%dT%H%M%S%f}")

    def read(self, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")


def load_versions(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Sequence[str], at: Column) -> DataFrame:
    """Type 2 load: `target` (keys, values, valid_from, valid_to, version, is_current) with the rows of `source` as of `at`.

    A key whose values changed has its current row closed at `at` and a row of the next version opened; a new key begins
    with version 1; unchanged and absent keys stay. Of a key that comes twice in `source` the largest row counts.
    """
    names = [*keys, *values]
    given = source.select(*names).groupBy(*keys).agg(F.max(F.struct(*values)).alias("v")).select(*keys, *(F.col(f"v.{v}").alias(f"_{v}") for v in values))
    current = target.filter("is_current").join(given.withColumn("_given", F.lit(True)), list(keys), "left")
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"_{v}"))
    changed = F.coalesce(F.col("_given"), F.lit(False)) & ~same
    closing = current.select(*names, "valid_from", F.when(changed, at).otherwise(F.col("valid_to")).alias("valid_to"), "version", (~changed).alias("is_current"))
    known = target.groupBy(*keys).agg(F.max("version").alias("_last"))
    standing = target.filter("is_current").select(*keys, *(F.col(v).alias(f"_old_{v}") for v in values), F.lit(True).alias("_known"))
    news = given.join(standing, list(keys), "left").join(known, list(keys), "left")
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(f"_{v}").eqNullSafe(F.col(f"_old_{v}"))
    opened = news.filter(F.col("_known").isNull() | differs).select(
        *keys, *(F.col(f"_{v}").alias(v) for v in values), at.alias("valid_from"), F.lit(None).cast(target.schema["valid_to"].dataType).alias("valid_to"),
        (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("version"), F.lit(True).alias("is_current"),
    )
    return target.filter("NOT is_current").unionByName(closing).unionByName(opened)


def validity(changes: DataFrame, key: str, value: str, at: str, tie: str) -> DataFrame:
    """(key, value, valid_from, valid_to, is_current): a row for each stretch of time in which a key had one value."""
    order = Window.partitionBy(key).orderBy(at, tie)
    marked = changes.withColumn("_before", F.lag(F.struct(value)).over(order))
    turned = marked.filter(F.col("_before").isNull() | ~F.col(f"_before.{value}").eqNullSafe(F.col(value)))
    until = F.lead(at).over(order)
    return turned.select(key, value, F.col(at).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current"))


@dataclass(frozen=True)
class DailyMetrics:
    """Atomic and derived metrics of a day, replaced as one partition, with a log row for each run."""

    spark: SparkSession
    path: str
    atomic: Callable[[DataFrame], DataFrame]
    derived: dict[str, tuple[str, str]]

    def run(self, rows: DataFrame, day: str, date_column: str) -> None:
        """`atomic` makes (metric, value) of the day's rows; each derived metric is the quotient of two atomic ones."""
        some = rows.filter(F.col(date_column).cast("date") == F.lit(day).cast("date"))
        base = self.atomic(some).select("metric", F.col("value").cast("double").alias("value")).persist()
        try:
            made = base
            for name, (over, under) in self.derived.items():
                pick = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
                made = made.unionByName(base.agg(F.lit(name).alias("metric"), F.try_divide(pick(over), pick(under)).alias("value")))
            files.overwrite_touched(made.withColumn("day", F.lit(day)), f"{self.path}/metrics", ["day"])
            log = made.agg(F.lit(day).alias("day"), F.count("*").alias("n"))
            log.write.mode("append").parquet(f"{self.path}/log")
        finally:
            base.unpersist()

    def metrics(self) -> DataFrame:
        return self.spark.read.schema("metric string, value double, day string").parquet(f"{self.path}/metrics")

    def runs(self) -> DataFrame:
        return self.spark.read.schema("day string, n long").parquet(f"{self.path}/log")


def without_expired(df: DataFrame, period: str, oldest: Column) -> DataFrame:
    """The partitions that are kept: those of `oldest` and later, and those without a date. Deleting paths is left to an operator."""
    return df.filter(F.col(period).isNull() | (F.col(period) >= oldest))


#: Age in days below which a row is in the tier, and the codec it is written with; the last tier takes the rest.
TIERS = (("hot", 365, "snappy"), ("warm", 1460, "zstd"), ("cold", None, "gzip"))


def archive(df: DataFrame, path: str, age: Column, tiers=TIERS) -> dict[str, str]:
    """Write each tier to its own folder with its own codec; rows without an age go to the last. Returns the folders."""
    tier = F.lit(tiers[-1][0])
    for name, below, _ in reversed(tiers[:-1]):
        tier = F.when(age < below, F.lit(name)).otherwise(tier)
    folders = {}
    for name, _, codec in tiers:
        folders[name] = f"{path}/{name}"
        files.write_columnar(df.filter(tier == name), folders[name], codec=codec)
    return folders


def latest_status(snapshots: DataFrame, key: str, at: str) -> DataFrame:
    """The newest of the appended snapshots of each key."""
    return latest_per_key(snapshots, [key], [at])
