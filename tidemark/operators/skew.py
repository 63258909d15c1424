"""Aggregates over keys of which a few hold much of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_aggregate(df: DataFrame, keys: list[str], spread: str, sums: dict[str, Column], salts: int) -> DataFrame:
    """Two-stage aggregate: by key and a salt from the hash of `spread`, then by key. `sums` are summable aggregates."""
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).alias("_salt")
    part = df.groupBy(*keys, salt).agg(*(c.alias(n) for n, c in sums.items()))
    return part.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in sums))


def skewed_keys(df: DataFrame, key: str, times: float) -> DataFrame:
    """Keys with more than `times` the mean number of rows. There are fewer of them than keys / times."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    mean = sizes.agg(F.avg("_n").alias("_mean"))
    return sizes.crossJoin(F.broadcast(mean)).filter(F.col("_n") > times * F.col("_mean")).select(key)


def split_aggregate(df: DataFrame, key: str, hot: DataFrame, spread: str, sums: dict[str, Column], salts: int) -> DataFrame:
    """Hot keys in two stages, the others in one. A NULL key is never hot."""
    salted = salted_aggregate(df.join(hot, key, "left_semi"), [key], spread, sums, salts)
    plain = df.join(hot, key, "left_anti").groupBy(key).agg(*(c.alias(n) for n, c in sums.items()))
    return salted.unionByName(plain)
