"""What a chain of filters removes, for every order of the filters, from a sparse document-term matrix.

Texts are read once. A task turns about SHARD_BYTES of text into one shard of a matrix in compressed sparse rows, with the
words of the shard numbered by themselves. The distinct words of all shards get global numbers, part by part of a hash,
and each shard's columns are renumbered to them. A row's sum is its document's number of words, its nonzero entries are the distinct words.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, whole_text, written
from tidemark.runtime import scratch_path

#: Text of one shard, and of the corpus for one part of the dictionary.
SHARD_BYTES, PART_BYTES = 16 << 20, 4 << 20
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_CAPITALS_PERCENT, MARKS = 200, 50, 2, "#$%&*|"

CARRIED = "doc_id array<long>, part array<string>, fails array<int>, digest array<binary>"
SHARDS = f"shard long, {CARRIED}, begins array<long>, codes array<int>, counts array<int>, words array<binary>"
NUMBERED = "shard long, h int, places array<int>, words binary"
MATRIX = f"shard long, {CARRIED}, begins array<long>, terms array<long>, counts array<int>"
SUMS = "doc_id long, part string, fails int, digest binary, n_words long, n_distinct long"


def table_of(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


WHITE, CAPITAL, MARK = table_of(b" \t\n\x0b\x0c\r"), table_of(bytes(range(65, 91))), table_of(MARKS.encode())


def within(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many true entries each stretch between two offsets has."""
    sums = np.concatenate([[0], np.cumsum(found, dtype=np.int32 if len(found) < 1 << 31 else np.int64)]).astype(np.int64, copy=False)
    return sums[offsets[1:]] - sums[offsets[:-1]]


def sparse_rows(data: np.ndarray, offsets: np.ndarray, parts: int):
    """(begins, codes, counts, words) of texts that lie one behind the other: a matrix in compressed sparse rows.

    The different words are numbered in the order of a hash that has `parts` values; `words` holds those of each value,
    joined by line ends, which no word contains.
    """
    inside = ~WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    first[edges] = inside[edges]  # a word never goes on in the next text
    starts = np.flatnonzero(first)
    letters = data[inside]
    ends = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(letters))
    encoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
    words = encoded.dictionary.to_pylist()
    hashed = np.fromiter((crc32(w) % parts for w in words), np.int64, len(words))
    order = np.argsort(hashed, kind="stable")
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words))
    cuts = np.searchsorted(hashed[order], np.arange(parts + 1)).tolist()
    in_order = [words[i] for i in order.tolist()]
    packed = [b"\n".join(in_order[a:b]) for a, b in zip(cuts, cuts[1:])]
    width, n_docs = max(1, len(words)), len(offsets) - 1
    docs = np.searchsorted(offsets, starts, "right") - 1  # an empty text ends where it begins and gets none
    cells, counts = np.unique(docs * width + number[encoded.indices.to_numpy()], return_counts=True)
    begins = np.searchsorted(cells, np.arange(n_docs + 1, dtype=np.int64) * width)
    return begins, cells % width, counts, packed


def one_list(values) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def shards(parts: int):
    """One row a shard: ids, parts, failures of C and D, digests, and the sparse rows under the shard's own numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SHARD_BYTES, "right")) - 1)
                own = offsets[a : b + 1] - offsets[a]
                piece = data[offsets[a] : offsets[b]]
                capitals = 100 * within(CAPITAL[piece], own) > MOST_CAPITALS_PERCENT * within((piece & 0xC0) != 0x80, own)
                fails = 4 * capitals.astype(np.int32) + 8 * (within(MARK[piece], own) > 0).astype(np.int32)
                view = memoryview(piece)
                digests = [hashlib.sha256(view[x:y]).digest() for x, y in zip(own[:-1].tolist(), own[1:].tolist())]
                begins, codes, counts, words = sparse_rows(piece, own, parts)
                lists = [
                    batch.column("doc_id")[a:b], batch.column("part")[a:b], pa.array(fails, pa.int32()), pa.array(digests, pa.binary()),
                    pa.array(begins, pa.int64()), pa.array(codes, pa.int32()), pa.array(counts, pa.int32()), pa.array(words, pa.binary()),
                ]
                names = ["doc_id", "part", "fails", "digest", "begins", "codes", "counts", "words"]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *map(one_list, lists)], ["shard", *names])
                number, a = number + 1, b

    return run


def numbered(key: tuple, rows: pa.Table) -> pa.Table:
    """Number the different words of one hash value in the order of their bytes: for each shard the numbers of its words, and
    one row without shard that holds the words. A word comes once from each shard at most."""
    per_shard = [w.split(b"\n") for w in rows["words"].to_pylist()]
    words = sorted(set().union(*per_shard))
    place = {w: i for i, w in enumerate(words)}
    places = [[place[w] for w in own] for own in per_shard]
    return pa.table(
        {
            "shard": pa.array([*rows["shard"].to_pylist(), None], pa.int64()), "h": pa.array([key[0].as_py()] * (len(places) + 1), pa.int32()),
            "places": pa.array([*places, None], pa.list_(pa.int32())), "words": pa.array([None] * len(places) + [b"\n".join(words)], pa.binary()),
        }
    )


def renumbered(parts: int, local: pa.Table, places: pa.Table):
    """(shard row, begins, terms, counts) of each shard: its columns under the numbers that hold for all shards."""
    found = sorted(zip(places["h"].to_pylist(), range(len(places))))
    lists = places["places"].combine_chunks()
    terms = [lists[i].values.to_numpy().astype(np.int64) * parts + h for h, i in found]
    terms = np.concatenate(terms) if terms else np.zeros(0, np.int64)
    values = lambda c, i: local[c][i].values.to_numpy(zero_copy_only=False)
    for i in range(len(local)):
        yield i, values("begins", i), terms[values("codes", i)], values("counts", i)


def matrix_rows(parts: int):
    def run(local: pa.Table, places: pa.Table) -> pa.Table:
        terms = [t for _, _, t, _ in renumbered(parts, local, places)]
        return local.append_column("terms", pa.array(terms, pa.list_(pa.int64()))).select([c.split()[0] for c in MATRIX.split(", ")])

    return run


def sums_of(begins: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row sums and numbers of nonzero entries of sparse rows."""
    sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    return sums[begins[1:]] - sums[begins[:-1]], np.diff(begins)


def summed_rows(parts: int):
    def run(local: pa.Table, places: pa.Table) -> pa.Table:
        out = []
        for i, begins, terms, counts in renumbered(parts, local, places):
            n_words, n_distinct = sums_of(begins, terms, counts)
            carried = {c: local[c][i].values for c in ("doc_id", "part", "fails", "digest")}
            out.append(pa.table({**carried, "n_words": pa.array(n_words, pa.int64()), "n_distinct": pa.array(n_distinct, pa.int64())}))
        return pa.concat_tables(out)

    return run


@dataclass(frozen=True)
class TermMatrix:
    """A document-term matrix: shards under their own numbers, bucketed by shard, and the global numbers of their words.

    A word's number is its place among the words of its hash value, times the number of hash values, plus that value.
    """

    local: DataFrame
    places: DataFrame
    parts: int

    @staticmethod
    def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> TermMatrix:
        """The dictionary is built in as many parts as the corpus has PART_BYTES; each is one bounded task."""
        spark = docs.sparkSession
        part_name = F.coalesce(col(part).cast("string"), F.lit(""))
        some = docs.select(col(doc_id).cast("long").alias("doc_id"), part_name.alias("part"), whole_text(col(text)).alias("text"))
        size = some.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        parts = max(8, math.ceil(size / PART_BYTES))
        name, buckets = f"term_shards_{uuid.uuid4().hex[:12]}", int(spark.conf.get("spark.sql.shuffle.partitions"))
        made = some.mapInArrow(shards(parts), SHARDS)
        made.write.bucketBy(buckets, "shard").option("path", scratch_path(spark, "term_shards")).option("compression", "zstd").saveAsTable(name)
        local = spark.table(name)
        words = local.select("shard", F.posexplode("words").alias("h", "words")).filter(F.octet_length("words") > 0)
        places = written(words.groupBy("h").applyInArrow(numbered, NUMBERED), "term_numbers")
        return TermMatrix(local.drop("words"), places, parts)

    def _beside(self, run, schema: str) -> DataFrame:
        own = self.places.filter("shard IS NOT NULL").select("shard", "h", "places")
        return self.local.groupBy("shard").cogroup(own.groupBy("shard")).applyInArrow(run(self.parts), schema)

    def shards(self) -> DataFrame:
        """(shard, doc_id[], part[], fails[], digest[], begins[], terms[], counts[]): row i of a shard has the columns
        terms[begins[i]:begins[i+1]] with their counts."""
        return self._beside(matrix_rows, MATRIX)

    def row_sums(self) -> DataFrame:
        """One row a document: the sum and the number of nonzero entries of its row, with what the shard carries beside."""
        return self._beside(summed_rows, SUMS)

    def dictionary(self) -> DataFrame:
        """(term, word) of the different words of all texts."""
        words = self.places.filter("shard IS NULL").select("h", F.posexplode(F.split(F.col("words").cast("string"), "\n")).alias("place", "word"))
        return words.select((F.col("place").cast("long") * self.parts + F.col("h")).alias("term"), "word")


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, n_words, n_distinct, fails) of every document; bit k of `fails` stands for filter k of FILTERS.

    Identical texts are found by SHA-256. The smallest id of each group of copies comes from a partial aggregate, and only
    groups of two and more are joined back, which the adaptive planner splits where a group is large.
    """
    rows = written(TermMatrix.build(docs, doc_id, text, part).row_sums(), "row_sums")
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(firsts, "digest", "left")
    short = F.col("n_words") < LEAST_WORDS
    repetitive = 100 * F.col("n_distinct") < LEAST_DISTINCT_PERCENT * F.col("n_words")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    fails = F.col("fails") + short.cast("int") + 2 * repetitive.cast("int") + 16 * copy.cast("int")
    return rows.select("doc_id", "part", "n_words", "n_distinct", fails.alias("fails"))


def audit(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """For each part, order of the filters and step: what stays, goes and is lost."""
    known = labels.select(col(doc_id).alias("doc_id"), col(quality).alias("q"), col(toxic).alias("x")).filter("doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(*(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(n) for c, n in (("q", "good"), ("x", "bad"))))
    flagged = failed.join(known, "doc_id", "left")
    sums = (F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))
    cells = flagged.groupBy("part", "fails").agg(*sums)  # 32 rows a part at most
    cells = cells.groupBy("part").agg(F.collect_list(F.struct("fails", *("n", "good", "bad"))).alias("cells"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    steps = steps.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    before = F.expr("substring(filter_order, 1, step - 1)")
    bit_of = lambda letter: F.lit(1 << FILTERS.index(letter))
    bit = sum((F.when(F.col("filter") == f, bit_of(f)).otherwise(0) for f in FILTERS), F.lit(0))
    earlier = sum((F.when(F.contains(before, F.lit(f)), bit_of(f)).otherwise(0) for f in FILTERS), F.lit(0))
    steps = steps.withColumn("bit", bit).withColumn("earlier", earlier)

    def total(of: str, holds) -> Column:
        return F.aggregate(F.filter("cells", lambda c: holds(c["fails"])), F.lit(0).cast("long"), lambda s, c: s + c[of])

    mine = lambda f: f.bitwiseAND(F.col("bit")) > 0
    gone = lambda f: f.bitwiseAND(F.col("earlier")) > 0
    now = lambda f: mine(f) & ~gone(f)
    rows = steps.select(
        "part", "filter_order", "step", "filter",
        total("n", lambda f: ~mine(f) & ~gone(f)).alias("kept"), total("n", now).alias("removed"),
        total("n", lambda f: mine(f) & gone(f)).alias("redundant"), total("n", lambda f: f == F.col("bit")).alias("unique_fails"),
        total("good", now).alias("good_lost"), total("bad", now).alias("toxic_lost"),
    )
    every = Window.partitionBy("part", "filter")  # 120 rows
    return rows.withColumn("shapley", F.sum("removed").over(every)).drop("filter")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How the filters A to E act on `docs` in each of their 120 orders, by source.

    A: under 200 words. B: distinct words under half of the words. C: A-Z over 2 % of the code points. D: one of `#$%&*|`.
    E: the text of a smaller doc_id. Words are what lies between ASCII white space. A null text is empty (it fails A only),
    a null source is the part ''. Repeated rows count each; equal texts of one id are no copies of each other; a null doc_id
    is neither smaller nor larger and has no label. A document counts as good or toxic if any row of `labels` says so; rows
    with null labels say nothing. Texts of any length are read whole, one longer than a shard is its own shard. An empty
    table gives no rows. Other columns are ignored, whatever their names.
    """
    return audit(failures(docs), labels)
