"""Thin options for stores outside Spark: JDBC databases and Kafka topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_scan(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **properties: str
) -> DataFrame:
    """Parallel table scan, split on a numeric column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties
    )


def jdbc_write(df: DataFrame, url: str, table: str, mode: str = "overwrite", **properties: str) -> None:
    df.write.jdbc(url, table, mode=mode, properties=properties)


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """A topic as a stream of key, value and broker columns."""
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    )
    return (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()


def parse_json_value(df: DataFrame, schema: str, event_time: str | None = None, delay: str = "5 seconds") -> DataFrame:
    """`value` bytes or text to typed columns and `rejected`: the text of a message that is no JSON object of the schema.

    With an event time the rows get a watermark; rows without that time can't be placed and are rejected too.
    """
    text = F.col("value").cast("string")
    parsed = F.from_json(text, f"{schema}, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    rows = df.select(text.alias("_text"), parsed.alias("r"))
    broken = F.col("r").isNull() | F.col("r._broken").isNotNull()
    if event_time:
        broken = broken | F.col(f"r.{event_time}").isNull()
    rejected = F.when(broken, F.coalesce("_text", F.lit(""))).alias("rejected")
    rows = rows.select("r.*", rejected).drop("_broken")
    return rows.withWatermark(event_time, delay) if event_time else rows


def to_message(df: DataFrame, key: Column) -> DataFrame:
    """Rows as key and JSON value, the shape a topic sink takes."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start a query that publishes `key`, `value` rows to a topic."""
    return (
        df.writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint})
        .start()
    )
