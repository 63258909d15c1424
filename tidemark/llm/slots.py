"""Sharding over fixed virtual slots.

Records are hashed into thousands of slots, whose number never changes. A small versioned map says which shard holds
which slot. To rebalance, bytes are summed by slot and the map is edited: as few slots as possible move, whole, and the
edited map is stored as the next version. Readers name the version that they use.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, whole_text, written
from tidemark.runtime import scratch_path

#: Virtual slots. The map and the sums by slot have this many rows, whatever the table.
SLOTS = 8192
#: What a record costs beside its text.
RECORD_BYTES = 8
#: A slot of more than this many times the mean number of rows, and of HOT_ROWS at least, is dealt anew row by row.
HOT_TIMES, HOT_ROWS = 16, 10_000


@dataclass(frozen=True)
class SlotMap:
    """Version `version` of the map: `shards[s]` is the shard of slot s, one of 0 to n_shards - 1."""

    version: int
    n_shards: int
    shards: tuple[int, ...]

    @staticmethod
    def first(n_shards: int, n_slots: int = SLOTS) -> SlotMap:
        """Version 0: slots in turn."""
        return SlotMap(0, n_shards, tuple(s % n_shards for s in range(n_slots)))

    def rebalanced(self, sizes: list[int]) -> SlotMap:
        """The next version. While a move makes the fullest and the emptiest shard more alike, that slot moves whose size
        comes nearest to half their difference; ties go to the smaller slot and shard."""
        size, shard = np.asarray(sizes, np.int64), np.asarray(self.shards)
        load = np.bincount(shard, size, self.n_shards).astype(np.int64)
        while True:
            full, empty = int(load.argmax()), int(load.argmin())
            gap = load[full] - load[empty]
            there = np.flatnonzero((shard == full) & (size > 0) & (size < gap))
            if not len(there):
                return SlotMap(self.version + 1, self.n_shards, tuple(shard.tolist()))
            slot = there[np.abs(2 * size[there] - gap).argmin()]
            shard[slot] = empty
            load[full] -= size[slot]
            load[empty] += size[slot]

    def grown(self, sizes: list[int]) -> SlotMap:
        """The next version with one more shard. Slots move into the new shard only, from the fullest shard each time, as
        long as the new one stays at or below its equal part."""
        size, shard, new = np.asarray(sizes, np.int64), np.asarray(self.shards), self.n_shards
        load = np.bincount(shard, size, new + 1).astype(np.int64)
        room = int(size.sum()) // (new + 1)
        while True:
            full = int(load[:new].argmax())
            there = np.flatnonzero((shard == full) & (size > 0) & (size <= room - load[new]))
            if not len(there):
                return SlotMap(self.version + 1, new + 1, tuple(shard.tolist()))
            slot = there[size[there].argmax()]
            shard[slot] = new
            load[full] -= size[slot]
            load[new] += size[slot]

    def store(self, spark: SparkSession, folder: str) -> None:
        """Write this version beside the others; a stored version is never changed."""
        rows = [(slot, shard, self.n_shards) for slot, shard in enumerate(self.shards)]
        spark.createDataFrame(rows, "slot int, shard int, n_shards int").coalesce(1).write.parquet(f"{folder}/version={self.version}")

    @staticmethod
    def load(spark: SparkSession, folder: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{folder}/version={version}").orderBy("slot").collect()
        return SlotMap(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))


def slot_of(*parts: Column, n_slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(n_slots)).cast("int")


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, row, virtual_slot) of every document, stored so that `row` keeps naming one row.

    The slot is a hash of id and text. Where one slot holds far more rows than the mean, as when an id and its text repeat,
    its rows are dealt over all slots by their row number as well.
    """
    whole = whole_text(col(text))
    size = F.octet_length(whole).cast("long") + F.lit(RECORD_BYTES)
    rows = docs.select(
        col(doc_id).alias("doc_id"), size.alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"), slot_of(col(doc_id), whole, n_slots=n_slots).alias("virtual_slot"),
    )
    rows = written(rows, "slot_records")
    counts = {r["virtual_slot"]: r["n"] for r in rows.groupBy("virtual_slot").agg(F.count("*").alias("n")).collect()}
    limit = max(HOT_ROWS, HOT_TIMES * sum(counts.values()) // n_slots)
    hot = [slot for slot, n in counts.items() if n > limit]
    anew = slot_of(F.col("virtual_slot"), F.col("row"), n_slots=n_slots)
    return rows.withColumn("virtual_slot", F.when(F.col("virtual_slot").isin(hot), anew).otherwise(F.col("virtual_slot")))


def slot_sums(rows: DataFrame, n_slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot: at most `n_slots` rows come to the driver."""
    size, n = [0] * n_slots, [0] * n_slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        size[r["virtual_slot"]], n[r["virtual_slot"]] = r["size"], r["n"]
    return size, n


def placed(rows: DataFrame, counts: list[int], slots: SlotMap) -> DataFrame:
    """The records with `shard` and `slot`, their place in it: the rows of a virtual slot are numbered by themselves and
    begin where the shard's earlier virtual slots end."""
    begin, filled = [0] * len(counts), [0] * slots.n_shards
    for s, shard in enumerate(slots.shards):
        begin[s], filled[shard] = filled[shard], filled[shard] + counts[s]
    small = rows.sparkSession.createDataFrame(
        [(s, shard, begin[s]) for s, shard in enumerate(slots.shards)], "virtual_slot int, shard int, begin long"
    )
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "row")
    numbered = rows.withColumn("place", F.row_number().over(order) - 1)
    joined = numbered.join(F.broadcast(small), "virtual_slot")
    return joined.withColumn("slot", F.col("begin") + F.col("place")).drop("begin", "place")


def shard_documents(docs: DataFrame, n_shards: int = 24, folder: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its shard, its place in the shard and its virtual slot; shards are nearly equal in bytes.

    The map begins as version 0 (slots in turn), is edited by the bytes of the slots to version 1, and both are stored in
    `folder`. A document counts as its UTF-8 bytes and RECORD_BYTES; it is never divided, so a document larger than an
    equal part makes its shard larger. A null text counts as none, like an empty one. Repeated rows and rows with null
    ids are placed each on their own; ties of id and text keep the order in which they were read. An empty table gives no
    rows. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "slot_map")
    rows = records(docs, doc_id, text)
    size, n = slot_sums(rows)
    first = SlotMap.first(n_shards)
    edited = first.rebalanced(size)
    for version in (first, edited):
        version.store(spark, folder)
    return placed(rows, n, edited).select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot")
