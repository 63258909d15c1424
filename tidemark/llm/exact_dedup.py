"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by digest, that lives in the shared folder.
A new batch is cut to one row per digest before any join (map-side combine, so a group of copies
sends one row per task), then anti-joined with the index by sort-merge. The index side is read in
its buckets and never shuffled. Only digests that the index lacks are appended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, col, whole_text, written
from tidemark.sources.publish import unique_name


@dataclass(frozen=True)
class DigestIndex:
    """Digests of all texts that were kept so far.

    `path` holds the files, `buckets` is fixed when the index is made. Each row has the digest
    (SHA-256 of the normalised text), the id and row of the document that stays, and the batch that
    brought it. A batch that is run again after a failure meets only digests of other batches, so
    its own earlier, possibly partial append does not make its documents look like copies.
    """

    spark: SparkSession
    path: str
    buckets: int = 64

    COLUMNS = "digest BINARY, keep STRUCT<doc_id: BIGINT, row: BIGINT>, batch STRING"

    def table(self) -> str:
        """A catalog entry over the files; it is made anew in each session."""
        name = unique_name("digest_index")
        self.spark.sql(
            f"CREATE TABLE {name} ({self.COLUMNS}) USING parquet LOCATION '{self.path}' "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )
        return name

    def add(self, docs: DataFrame, batch: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Deduplicate `docs` against the index and itself, append what is new, return a row per document.

        Texts are equal when identical after lower-casing A-Z. A text that the index knows from
        another batch keeps the indexed document. Otherwise the largest `doc_id` stays; among
        repeated rows with one id exactly one row stays; null ids lose to any id. A null text counts
        as empty. Extra columns are ignored. An empty table gives no rows and leaves the index as it is.

        Returns doc_id, keep_id, group_size (within `docs`), kept, text_sha256.
        """
        digest = F.unhex(F.sha2(ascii_lower(whole_text(col(text))).cast("binary"), 256))
        rows = docs.select(col(doc_id).cast("long").alias("doc_id"), digest.alias("digest"))
        # Ids and digests only, about 50 bytes a document: the texts are read and hashed once.
        rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
        groups = rows.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
        )
        groups = written(groups, "digest_groups")

        name = self.table()
        try:
            known = self.spark.table(name)
            older = known.filter(F.col("batch") != batch).select("digest", F.col("keep").alias("older"))
            mine = known.filter(F.col("batch") == batch).select("digest")
            unseen = groups.join(older.hint("merge"), "digest", "left_anti")
            addition = unseen.join(mine.hint("merge"), "digest", "left_anti")
            addition = addition.select("digest", "keep", F.lit(batch).alias("batch"))
            addition = written(addition, "digest_addition")  # a table can't be read and appended to at once
            winners = written(groups.join(older.hint("merge"), "digest", "left"), "digest_winners")
            (
                addition.repartition(self.buckets, "digest")
                .write.format("parquet")
                .mode("append")
                .bucketBy(self.buckets, "digest")
                .sortBy("digest")
                .option("path", self.path)
                .saveAsTable(name)
            )
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

        # Both sides are exchanged for this join, so the adaptive planner splits a group of copies
        # that holds a large part of the rows.
        verdicts = rows.join(winners.hint("merge"), "digest")
        stays = F.col("older").isNull() & (F.struct("doc_id", "row") == F.col("keep"))
        return verdicts.select(
            "doc_id",
            F.when(F.col("older").isNull(), F.col("keep.doc_id")).otherwise(F.col("older.doc_id")).alias("keep_id"),
            "group_size",
            F.coalesce(stays, F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
