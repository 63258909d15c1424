"""Layouts of stored tables: sort keys, Bloom filters, Z-order and compaction."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes that a compacted file holds.
FILE_BYTES = 128 << 20
#: Least and greatest values are kept for each row group; small ones make them narrow.
GROUP_BYTES = 8 << 20


def write_sorted(rows: DataFrame, path: str, by: Sequence[str], files: int, bloom: Sequence[str] = (), group_bytes: int = GROUP_BYTES) -> None:
    """Write `files` files that divide the order of `by` between them, each sorted, with Bloom filters for some columns."""
    placed = rows.repartitionByRange(files, *by).sortWithinPartitions(*by)
    writer = placed.write.option("parquet.block.size", group_bytes)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def grid_place(df: DataFrame, column: str, bits: int) -> Column:
    """The place of a value among 2^bits ranges of about equal numbers of rows; NULL is in the first."""
    cuts = df.select(F.percentile_approx(column, [i / 2**bits for i in range(1, 2**bits)], 10_000)).first()[0] or []
    bounds = F.array(*(F.lit(c) for c in sorted(set(cuts)))) if cuts else F.array().cast("array<double>")
    return F.coalesce(F.size(F.filter(bounds, lambda b: F.col(column) > b)), F.lit(0))


def z_value(places: Sequence[Column], bits: int) -> Column:
    """The bits of whole numbers taken in turn, the highest first."""
    n = len(places)
    parts = [F.shiftleft(F.shiftright(p, i).bitwiseAND(1).cast("long"), i * n + (n - 1 - k)) for k, p in enumerate(places) for i in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_z_ordered(rows: DataFrame, path: str, by: Sequence[str], files: int, bits: int = 5, group_bytes: int = GROUP_BYTES) -> None:
    """Write files that each hold a box of all the columns in `by`, so that a range on any of them skips files."""
    key = z_value([grid_place(rows, c, bits) for c in by], bits)
    placed = rows.withColumn("_z", key).repartitionByRange(files, "_z", *by).sortWithinPartitions("_z", *by).drop("_z")
    placed.write.option("parquet.block.size", group_bytes).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes below a folder, from the store's own listing."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    row = found.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()  # lengths only, no contents
    return row["n"], row["bytes"]


def compact(spark: SparkSession, path: str, into: str, schema: StructType, file_bytes: int = FILE_BYTES) -> str:
    """Write a folder of many small files anew as files of about `file_bytes`; returns the new folder."""
    _, size = stored_bytes(spark, path)
    spark.read.schema(schema).parquet(path).repartition(max(1, math.ceil(size / file_bytes))).write.parquet(into)
    return into


def file_counts(spark: SparkSession, folders: dict[str, str], schema: StructType) -> DataFrame:
    """(stage, files, n): how many files and rows each folder has."""
    counted = []
    for stage, path in folders.items():
        n_files, _ = stored_bytes(spark, path)
        counted.append(spark.read.schema(schema).parquet(path).agg(F.lit(stage).alias("stage"), F.lit(n_files).alias("files"), F.count("*").alias("n")))
    return reduce(DataFrame.union, counted)
