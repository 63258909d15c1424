"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the hash is least among its neighbours. A cut
thus depends on the bytes around it only: text that is inserted or removed elsewhere moves no cut, and a
passage that two documents share is cut alike inside both. Chunks are compared by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, whole_text, written

#: Bytes that the rolling hash spans: each step shifts it by two of its 32 bits.
SPAN = 16
#: A cut is the least hash among so many on either side, so chunks have 2 * RADIUS + 1 bytes on average.
RADIUS = 16
#: In text that repeats itself no hash is less than those before it. Where a chunk would pass so many bytes, it ends at the
#: first hash beyond them that none beside it is below, so each piece begins at the same place of the repeated part.
LONGEST = 512
#: Words of a reported run of repeated chunks. The cuts nearest to the ends of a shared passage lie some 12 words
#: inside it, so passages of 50 words and more are found.
MIN_WORDS = 30

_GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=7) for b in range(256)], "u4")


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of the table's numbers, each shifted by two for every byte since."""
    h, reach = _GEAR[data], 1
    while reach < SPAN:
        h[reach:] += h[:-reach] << np.uint32(2 * reach)
        reach *= 2
    return h * np.uint32(0x9E3779B1)


def least_before(h: np.ndarray) -> np.ndarray:
    """At each place, the least of the RADIUS hashes before it; the largest number where there are fewer."""
    least, reach = h.copy(), 1
    while reach < RADIUS:
        least[reach:] = np.minimum(least[reach:], least[:-reach])
        reach *= 2
    out = np.full(len(h), np.iinfo("u4").max, "u4")
    out[1:] = least[:-1]
    return out


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text, the last one its length."""
    n = len(data)
    if n == 0:
        return np.empty(0, "i8")
    h = rolling(data)
    ends = np.flatnonzero((h < least_before(h)) & (h <= least_before(h[::-1])[::-1])) + 1
    # Near the ends of the text a cut has too few neighbours to be the same elsewhere.
    ends = ends[(ends > RADIUS + SPAN) & (ends < n - RADIUS)]
    if (np.diff(ends, prepend=0, append=n) > LONGEST).any():
        ends = np.sort(np.append(ends, periodic_cuts(h, ends)))
    return np.append(ends, n)


def periodic_cuts(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Further ends inside chunks of more than LONGEST bytes, at hashes that none of the RADIUS on either side is below."""
    n = len(h)
    level = np.flatnonzero((h <= least_before(h)) & (h <= least_before(h[::-1])[::-1])) + 1
    level = level[(level > RADIUS + SPAN) & (level < n - RADIUS)]
    more = []
    bounds = np.concatenate(([0], ends, [n]))
    for i in np.flatnonzero(np.diff(bounds) > LONGEST).tolist():
        at, last = int(bounds[i]), int(bounds[i + 1])
        own = level[np.searchsorted(level, at, "right") : np.searchsorted(level, last)]
        # The repeated part begins where the first level hash is; pieces are counted from there.
        at = int(own[0]) if len(own) else last
        while last - at > LONGEST:
            more.append(at)
            k = int(np.searchsorted(own, at + LONGEST // 2))
            at = int(own[k]) if k < len(own) else last
        if len(own) and at < last:
            more.append(at)
    return np.array(more, "i8")


def chunk_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row for each chunk of each text: row, doc_id, start and size in bytes, n_words that begin in it, digest (hi, lo)."""
    identity = F.xxhash64(F.coalesce(col(doc_id).cast("string"), F.lit("-")), whole_text(col(text)))
    rows = docs.select(identity.alias("row"), col(doc_id).cast("long").alias("doc_id"), col(text).cast("string").alias("text"))
    schema = "row long, doc_id long, start long, size long, n_words int, hi long, lo long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        white = np.zeros(256, bool)
        white[[9, 10, 11, 12, 13, 32]] = True
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            ids = zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
            for row, number, value in ids:
                raw = (value.as_py() or "").encode("utf-8", "surrogatepass")
                if not raw:
                    continue
                data = np.frombuffer(raw, "u1")
                ends = cuts(data)
                starts = np.concatenate(([0], ends[:-1]))
                space = white[data]
                begins = ~space & np.concatenate(([True], space[:-1]))
                counted = np.concatenate(([0], np.cumsum(begins)))
                parts = b"".join([digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
                digests = np.frombuffer(parts, ">i8").astype("i8").reshape(-1, 2)
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row, "i8")),
                        pa.array([number] * n, pa.int64()),
                        pa.array(starts),
                        pa.array(ends - starts),
                        pa.array((counted[ends] - counted[starts]).astype("i4")),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                    ],
                    ["row", "doc_id", "start", "size", "n_words", "hi", "lo"],
                )

    return rows.mapInArrow(run, schema)


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Runs of chunks that other documents hold too.

    Runs of at least `min_words` words are reported. A run is divided where a stretch of `min_words` words and more
    begins or ends of which earlier documents hold every chunk: such a stretch is repeated and may go, while the
    first document that holds a chunk keeps it. Returns a row per part: doc_id, start and size (bytes of the UTF-8
    text), n_words, first_id (the least id among the documents that hold one of its chunks), repeated and row
    (identity of the text). A part that is not repeated may have fewer words than its run must have.

    A chunk is repeated if two documents hold it; equal rows (same id and text) are one document. Chunks are
    counted over all documents by an aggregate with map-side combine, and occurrences meet only the digests that
    repeat, in a join that the adaptive planner splits where a chunk is frequent. Null and empty texts have no
    chunks; null ids are reported as null and come after all others. Of ties, copies of one text with
    different ids, the least id holds first. Texts of any length are cut whole, also where they repeat themselves. An
    empty table gives no rows; extra columns are ignored.
    """
    chunks = chunk_rows(docs, doc_id, text)
    found = chunks.groupBy("hi", "lo").agg(
        F.min("row").alias("least"), F.max("row").alias("most"), F.min("doc_id").alias("first_id")
    )
    shared = written(found.filter("least <> most").select("hi", "lo", "first_id"), "shared_chunks")
    met = chunks.join(shared.hint("merge"), ["hi", "lo"]).select("row", "doc_id", "start", "size", "n_words", "first_id")
    # One document's chunks in order, with equal rows once.
    order = Window.partitionBy("row").orderBy("start")
    once = met.withColumns({"before": F.lag("start").over(order), "ended": F.lag(F.col("start") + F.col("size")).over(order)})
    once = once.filter("before IS NULL OR before <> start")
    begins = F.coalesce(F.col("ended") != F.col("start"), F.lit(True))
    earlier = F.coalesce(F.col("first_id") < F.col("doc_id"), F.col("doc_id").isNull() & F.col("first_id").isNotNull())
    once = once.withColumns({"begins": begins, "earlier": earlier})
    whole = ["row", "doc_id", "run"]

    def joined(parts: DataFrame, flag: str) -> DataFrame:
        """Neighbours of one run with the same flag made one, each with its `run`."""
        changes = F.col("begins") | (F.col(flag) != F.lag(flag).over(order))
        parts = parts.withColumn("run", F.sum(F.col("begins").cast("int")).over(order))
        parts = parts.withColumn("part", F.sum(changes.cast("int")).over(order))
        return parts.groupBy(*whole, "part", flag).agg(
            F.min("start").alias("start"),
            F.sum("size").alias("size"),
            F.sum("n_words").alias("n_words"),
            F.min("first_id").alias("first_id"),
            F.max("begins").alias("begins"),
        )

    # Too short a stretch does not go, so it stays with what is beside it.
    parts = joined(once, "earlier").withColumn("repeated", F.col("earlier") & (F.col("n_words") >= min_words))
    spans = joined(parts.drop("run", "part", "earlier"), "repeated")
    in_run = F.sum("n_words").over(Window.partitionBy(*whole))
    spans = spans.withColumn("in_run", in_run).filter(F.col("in_run") >= min_words)
    return spans.select("doc_id", "start", "size", "n_words", "first_id", "repeated", "row")


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the spans that an earlier document holds; columns and rows stay as they are.

    Half characters at the edges of a span stay out of the text. Null texts stay null.
    """
    row, gone = fresh(docs, "td_row"), fresh(docs, "td_spans")
    spans = repeated_spans(docs, min_words, doc_id, text).filter("repeated")
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias(gone))
    identity = F.xxhash64(F.coalesce(col(doc_id).cast("string"), F.lit("-")), whole_text(col(text)))
    joined = docs.withColumn(row, identity).join(spans.withColumnRenamed("row", row), row, "left")

    @F.pandas_udf("string")
    def without(texts, spans):
        def cut(value, some):
            if some is None or value is None:
                return value
            raw, kept, at = value.encode("utf-8", "surrogatepass"), [], 0
            for s in some:
                kept.append(raw[at : s["start"]])
                at = s["start"] + s["size"]
            return b"".join([*kept, raw[at:]]).decode("utf-8", "ignore")

        return texts.combine(spans, cut)

    cut = F.when(F.col(gone).isNull(), col(text)).otherwise(without(col(text), F.col(gone)))
    return joined.withColumn(text, cut).select(*(col(c) for c in docs.columns))
