"""Change-log apply, upserts and latest-version collapse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` per key.

    An aggregate with map-side combine: every task sends one row per key, however
    many versions a key has.
    """
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ("ts_ms", "offset")
) -> DataFrame:
    """Apply a before/after change log to a table; the newest change of a key wins.

    A change whose key differs before and after ends the old key and begins the new one. A row without
    `after` is a delete, whatever its `op` says; so is `op = 'd'`.
    """
    before = F.struct(*(F.col(f"before.{k}").alias(k) for k in keys))
    after = F.struct(*(F.col(f"after.{k}").alias(k) for k in keys))
    gone = F.col("after").isNull() | F.coalesce(F.col("op") == "d", F.lit(False))
    moved = F.col("before").isNotNull() & ~gone & ~before.eqNullSafe(after)
    row = lambda key, image: F.struct(key.alias("key"), image.alias("row"))
    nothing = F.when(F.lit(False), F.col("after"))
    effects = (
        F.when(gone, F.array(row(F.when(F.col("before").isNull(), after).otherwise(before), nothing)))
        .when(moved, F.array(row(before, nothing), row(after, F.col("after"))))
        .otherwise(F.array(row(after, F.col("after"))))
    )
    exploded = changes.select(F.explode(effects).alias("e"), *order).select("e.key.*", "e.row", *order)
    last = latest_per_key(exploded, keys, order)
    matched = [F.col(f"t.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    on = matched[0]
    for more in matched[1:]:
        on = on & more
    kept = target.alias("t").join(last.alias("l"), on, "left_anti")
    return kept.unionByName(last.filter("row IS NOT NULL").select("row.*").select(*target.columns))


def one_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`updates`, failing at run time where a key is NULL or comes twice."""
    names = ", ".join(keys)
    counted = updates.groupBy(*keys).agg(F.max(F.struct(*updates.columns)).alias("_row"), F.count("*").alias("_n"))
    bad = F.col("_n") > 1
    for k in keys:
        bad = bad | F.col(k).isNull()
    message = F.lit(f"each key ({names}) must be set and come once")
    return counted.filter(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True)).select("_row.*")


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert or replace rows by key. `updates` has one row per key, which is checked."""
    checked = one_per_key(updates, keys)
    return target.join(checked.select(*keys), list(keys), "left_anti").unionByName(checked)


def update_columns(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Overwrite some columns of the matching rows, with NULL too, and leave the others alone."""
    fresh = updates.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_matched"))
    joined = target.join(fresh, list(keys), "left")
    hit = F.col("_matched").isNotNull()
    values = [F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    return joined.select(*values)


def merge_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], deleted: str | None = None
) -> DataFrame:
    """MERGE semantics on files: matched rows updated or deleted, unmatched rows inserted. A NULL flag deletes nothing."""
    live = source.filter(~F.coalesce(F.expr(deleted), F.lit(False))) if deleted else source
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(live.select(*target.columns))
