"""Ranks and quantiles over few large groups, from counts of equal values.

Rows are counted by (group, value) with map-side combine. The window then sees one row for each different value of a
group, however many rows the group has, and its result is joined back by group and value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_ranks(df: DataFrame, by: str, value: str) -> DataFrame:
    """`df` with rank and dense_rank by descending `value` in each group, and `reached`: rows with a value not smaller.

    NULL groups are one group, NULL values come last.
    """
    counts = df.groupBy(F.col(by).alias("_by"), F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    order = Window.partitionBy("_by").orderBy(F.desc("_value"))
    reached = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select(
        "_by", "_value", (reached - F.col("_n") + 1).cast("int").alias("rank"), F.row_number().over(order).alias("dense_rank"), reached.alias("reached")
    )
    on = F.col(by).eqNullSafe(F.col("_by")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(ranked, on).drop("_by", "_value")


def quantiles(df: DataFrame, by: str, value: str, share: float, name: str) -> DataFrame:
    """The exact quantile of each group, between two values in proportion; NULL values do not count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    reached = F.sum("_n").over(Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    place = share * (F.sum("_n").over(Window.partitionBy(by)) - 1)
    placed = counts.select(by, F.col(value).alias("_v"), reached.alias("_reached"), place.alias("_place"))
    first: Column = F.min(F.when(F.col("_reached") > F.floor("_place"), F.col("_v")))
    second: Column = F.min(F.when(F.col("_reached") > F.ceil("_place"), F.col("_v")))
    part = F.max(F.col("_place") - F.floor("_place"))
    return placed.groupBy(by).agg((first + (second - first) * part).alias(name))


def not_in(left: DataFrame, key: str, listed: DataFrame, column: str) -> DataFrame:
    """`left` rows whose key is NOT IN the listed values, as SQL has it, without sending the list to every task.

    A NULL in the list leaves no row, an empty list all rows; else a NULL key is left out and the rest is an anti join by
    key, which the planner may broadcast only below its size limit.
    """
    values = listed.select(F.col(column).alias("_listed"))
    found = values.agg(F.count("*").alias("n"), F.count_if(F.col("_listed").isNull()).alias("nulls")).first()
    if found["nulls"]:
        return left.limit(0)
    if not found["n"]:
        return left
    return left.filter(F.col(key).isNotNull()).join(values, F.col(key) == F.col("_listed"), "left_anti")
