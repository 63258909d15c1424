"""The registry that binds a query name to a Spark plan and to check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Show dates and timestamps as ISO text so that two engines print them alike."""
    temporal = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if not any(isinstance(f.dataType, temporal) for f in df.schema.fields):
        return df
    return df.select(
        *(
            F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, temporal) else f"`{f.name}`"
            for f in df.schema.fields
        )
    )


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, root: portable(fn(Tables(spark, root)))
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn

    return register
