"""File readers and writers: CSV, delimited text, logs, ORC, Parquet and partitioned layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """CSV with a header line and a declared schema; types are never inferred."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.option("header", True).option("sep", sep).csv(path)


def read_with_rejects(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """Bulk load in one pass that keeps bad rows: the typed columns and CORRUPT, the text of a row that does not fit.

    The reader itself takes the header of each file and joins records with line ends in quotes. Blank lines are no rows.
    Filter on CORRUPT for the loaded or the rejected rows, or write partitioned by whether it is set.
    """
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").options(header=True, sep=sep, multiLine=True)
    rows = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    # The reader checks only columns that are used. The hash uses them all, and is never this number but for chance.
    every = F.xxhash64(*T.StructType.fromDDL(schema).fieldNames()) == F.lit(-(2**63))
    return rows.withColumn(CORRUPT, F.coalesce(F.col(CORRUPT), F.when(every, F.lit(""))))


def cast_staged(staged: DataFrame, types: dict[str, str], failed: str = "failed") -> DataFrame:
    """Cast text columns in one pass; `failed` marks rows with a value that does not fit its type (it becomes NULL)."""
    bad = F.lit(False)
    for name, kind in types.items():
        bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
    typed = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in staged.columns]
    return staged.select(*typed, bad.alias(failed))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Partition folders with even files; the rebalance hint splits a folder that holds too much."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def overwrite_touched(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions present in `df`. `df` must not read from `path`."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_columnar(df: DataFrame, path: str, fmt: str = "parquet", codec: str = "zstd") -> None:
    df.write.format(fmt).option("compression", codec).save(path)


def read_evolved(spark: SparkSession, *paths: str) -> DataFrame:
    """Read files written under different schemas; a column that a file lacks is NULL."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def slice_of(key: Column, slices: int) -> Column:
    """A stable slice number for work that proceeds piece by piece."""
    return F.pmod(F.xxhash64(key), F.lit(slices))
