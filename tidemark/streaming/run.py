"""Running a stream to the end of its input and reading what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import scratch_path


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder as a stream, or one file of it. `files_per_trigger` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        reader, path = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    return reader.load(path)


def event_stream(spark: SparkSession, path: str, schema: str, event_time: str, delay: str = "5 seconds") -> DataFrame:
    """A Parquet folder or file as a stream with a watermark.

    The files hold timestamps without a zone, which a watermark refuses, so the
    event time is cast first.
    """
    rows = file_stream(spark, path, schema)
    return rows.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def _finish(writer, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def append_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Append to Parquet files with a checkpoint; a restart resumes where the last run ended."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    _finish(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> None:
    """Hand every micro-batch to `handle(rows, batch_id)`."""
    _finish(stream.writeStream.outputMode(mode).foreachBatch(handle), checkpoint)


def final_state(stream: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Run to the end and return the result table as it then stands.

    Each micro-batch goes to its own folder, so a replayed batch rewrites the same
    files. Without `keys` the query runs in complete mode and the last batch is the
    result; with `keys` it runs in update mode and the last row per key is.
    """
    spark, root = stream.sparkSession, scratch_path(stream.sparkSession, label)
    out = f"{root}/out"

    last = [-1]

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        last[0] = max(last[0], batch_id)

    each_batch(stream, write, f"{root}/checkpoint", "update" if keys else "complete")
    if last[0] < 0:  # no input at all
        return spark.createDataFrame([], stream.schema)
    if keys:
        typed = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
        rows = spark.read.schema(typed).parquet(out)
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("row"))
        return latest.select("row.*")
    return spark.read.schema(stream.schema).parquet(f"{out}/batch={last[0]}")


def appended(stream: DataFrame, label: str) -> DataFrame:
    """Run an append-mode stream to the end of its input and read the rows it wrote."""
    root = scratch_path(stream.sparkSession, label)
    return append_files(stream, f"{root}/out", f"{root}/checkpoint")


#: A row this long after the last one closes what a stream still holds; it is in no result itself.
LONG_AFTER = "INTERVAL 1000 DAYS"


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def replay(
    rows: DataFrame, label: str, event_time: str, n_pieces: int = 2, arrival: Column | None = None, closing: Sequence[dict] = ({},)
) -> str:
    """Write a table as a stream would bring it and return the folder: `n_pieces` equal stretches of arrival time, one
    behind the other, then closing rows far after the last event. Their columns are null but for the event time and what
    `closing` gives; a filter of the stream must let one of them through, or the watermark stays where it is.

    `arrival` is the event time by default; where it is later, rows come late. Rows without an event time come first.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, label)
    came = (F.col(event_time) if arrival is None else arrival).cast("timestamp")
    first, last, end = rows.select(F.min(came), F.max(came), F.max(F.col(event_time).cast("timestamp"))).first()
    for piece in range(n_pieces if last is not None else 0):
        step = (last - first) / n_pieces
        after, until = came > F.lit(first + piece * step), came <= F.lit(first + (piece + 1) * step)
        if piece == 0:
            after = F.lit(True)
        if piece == n_pieces - 1:
            until = F.lit(True)
        inside = F.coalesce(after & until, F.lit(piece == 0))
        rows.filter(inside).write.mode("append").parquet(path)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    at = F.coalesce(F.lit(end), F.lit("2000-01-01").cast("timestamp")) + F.expr(LONG_AFTER)
    ending = [F.struct(*(as_column(({event_time: at} | values).get(name)).cast(kind).alias(name) for name, kind in kinds.items())) for values in closing]
    spark.range(1).select(F.inline(F.array(*ending))).coalesce(1).write.mode("append").parquet(path)
    return path


def replayed(
    rows: DataFrame, label: str, event_time: str, delay: str, n_pieces: int = 2, arrival: Column | None = None, closing: Sequence[dict] = ({},)
) -> DataFrame:
    """`replay` as a stream with a watermark, one file a micro-batch."""
    path = replay(rows.coalesce(1), label, event_time, n_pieces, arrival, closing)
    stream = file_stream(rows.sparkSession, path, rows.schema, files_per_trigger=1)
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)


def routed(
    stream: DataFrame, label: str, event_time: str, delay: str, on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]
) -> None:
    """Hand the rows of each micro-batch that are older than the watermark to `late`, the others to `on_time`.

    The watermark is the greatest event time of earlier batches less `delay`. Each batch notes its greatest event time
    under its number, so a replayed batch notes the same and is divided the same.
    """
    spark, root = stream.sparkSession, scratch_path(stream.sparkSession, label)
    kind = "batch long, upto timestamp"
    spark.createDataFrame([], kind).write.parquet(f"{root}/notes/first")

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            notes = spark.read.schema(kind).option("recursiveFileLookup", True).parquet(f"{root}/notes")
            mark = notes.filter(F.col("batch") < batch_id).agg((F.max("upto") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
            behind = F.coalesce(F.col(event_time) < F.lit(mark).cast("timestamp"), F.lit(False))
            on_time(rows.filter(~behind), batch_id)
            late(rows.filter(behind), batch_id)
            noted = rows.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(event_time).cast("timestamp").alias("upto"))
            noted.write.mode("overwrite").parquet(f"{root}/notes/b{batch_id}")
        finally:
            rows.unpersist()

    each_batch(stream, handle, f"{root}/checkpoint")
