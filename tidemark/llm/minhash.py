"""Near-duplicate detection with circulant MinHash.

Two permutations of the 64-bit numbers make the whole signature: the first scatters the shingles,
the second, shifted circularly by k, gives coordinate k. Bands of coordinates name candidate buckets.
Every link is confirmed on full shingle sets.

Copies never meet in pairs. Documents with equal sets are one class, made by an aggregate with
map-side combine. In a bucket, classes are first compared with one centre; components of these links settle
most buckets, and classes of one centre that are still apart are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col, fresh, row_key, whole_text, written

SHINGLE = 5
#: 24 bands of 4 coordinates: a pair at similarity 0.85 shares no bucket with probability 2e-8, at 0.8 2e-6.
BANDS, ROWS = 24, 4
#: Coordinates x shingles that are hashed at a time.
BLOCK = 1 << 18

#: Classes of a centre that are dealt to one block, and shingles that are compared at a time.
BLOCK_SIZE, COLUMNS = 256, 4096

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SCATTER, _SHIFT, _BAND = np.uint64(0x8C71D06EB5A3F24B), np.uint64(0x5851F42D4C957F2D), np.uint64(0xD1342543DE82EF95)
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], "u8")


def permute(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers, in place (multiply and xor-shift, each invertible)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xE9846AF9B1A615D)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xE9846AF9B1A615D)
    x ^= x >> np.uint64(28)
    return x


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of 64-bit hashes of the five-word shingles of a whole text.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. Fewer than five words are one
    shingle; no words are none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, "u8")
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], "u8")
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), "u8", len(words))
    n = len(words) - SHINGLE + 1
    sums = np.zeros(n, "u8")
    for k in range(SHINGLE):
        sums += hashes[k : k + n] * _PLACES[k]
    return np.unique(permute(sums))


def signature(hashes: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the least value of the second permutation at the k-th shift."""
    scattered = permute(hashes ^ _SCATTER)
    shifts = (np.arange(coordinates, dtype="u8") * _SHIFT)[:, None]
    least = np.full(coordinates, np.iinfo("u8").max, "u8")
    step = max(1, BLOCK // coordinates)
    for at in range(0, len(scattered), step):
        np.minimum(least, permute(scattered[None, at : at + step] + shifts).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A number for each band: a hash of its place and its coordinates."""
    parts = least.reshape(bands, rows)
    key = np.arange(bands, dtype="u8") * _BAND
    for r in range(rows):
        key = permute(key + parts[:, r])
    return key.view("i8")


def sketch(docs: DataFrame, doc_id: str, text: str, bands: int, rows: int) -> DataFrame:
    """doc_id, row (key of the row), n_shingles, set_digest (null if the set is empty), band keys b0, b1, ..."""
    chosen = docs.select(
        col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("row"), col(text).cast("string").alias("text")
    )
    names = [f"b{i}" for i in range(bands)]
    schema = "doc_id long, row string, n_shingles long, set_digest binary, " + ", ".join(f"{n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, keys = [], [], np.zeros((batch.num_rows, bands), "i8")
            for i, t in enumerate(batch.column("text")):
                found = shingles(t.as_py())
                n.append(len(found))
                digests.append(xxhash.xxh128_digest(found.tobytes()) if len(found) else None)
                if len(found):
                    keys[i] = band_keys(signature(found, bands * rows), bands, rows)
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(keys[:, j]) for j in range(bands))],
                ["doc_id", "row", "n_shingles", "set_digest", *names],
            )

    return chosen.mapInArrow(run, schema)


def texts_of(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """class and text of every class in `pairs`. A text is smaller than the hashes of its shingles."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    asked = written(asked.join(classes.select("class", F.col("least.row").alias("row")), "class"), "near_asked")
    texts = docs.select(row_key(doc_id, text).alias("row"), whole_text(col(text)).alias("text"))
    # One of repeated rows is enough.
    texts = texts.join(asked.hint("merge"), "row").select("class", "text").dropDuplicates(["class"])
    return written(texts, "near_texts")


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets have 100 * |a and b| >= percent * |a or b|.

    The sets are computed again from the texts where a pair meets.
    """
    first = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    # A centre that many members are compared with is split by the adaptive planner.
    met = pairs.join(second.hint("merge"), "b").join(first.hint("merge"), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            out = []
            for a, b, ta, tb in zip(*(batch.column(i) for i in range(4)), strict=True):
                a, b = a.as_py(), b.as_py()
                if a != last:
                    last, held = a, shingles(ta.as_py())
                other = shingles(tb.as_py())
                both = len(np.intersect1d(held, other, assume_unique=True))
                if 100 * both >= percent * (len(held) + len(other) - both):
                    out.append((a, b))
            sides = [pa.array([pair[i] for pair in out], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(sides, ["a", "b"])

    return written(met.mapInArrow(run, "a long, b long"), "near_links")


def components(links: DataFrame) -> DataFrame:
    """class and component (the least class reachable) of every class in `links` (a, b).

    Labels spread along links by aggregates and shorten by following the label of a label, until
    none changes. Each round is cut by a table in the shared folder.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links_both_ways")
    labels = both.groupBy(F.col("a").alias("class")).agg(F.min("b").alias("near"))
    labels = written(labels.select("class", F.least("class", "near").alias("component")), "labels")
    while True:
        seen = labels.select(F.col("class").alias("b"), F.col("component").alias("near"))
        spread = both.join(seen.hint("merge"), "b").groupBy(F.col("a").alias("class")).agg(F.min("near").alias("near"))
        old = F.col("component").alias("old")
        spread = spread.join(labels, "class").select("class", F.least("near", "component").alias("component"), old)
        spread = written(spread, "labels_spread")
        up = spread.select(F.col("class").alias("component"), F.col("component").alias("up"))
        labels = written(spread.join(up.hint("merge"), "component").select("class", F.col("up").alias("component"), "old"), "labels")
        if labels.filter("component <> old").isEmpty():
            return labels.select("class", "component")


def meeting(classes: DataFrame, names: list[str]) -> DataFrame:
    """Pairs (a, b): the centre of a bucket and each other class in it, for buckets with more than one class.

    The centre is the class that meets the most others over all its buckets: the original among edited copies.
    """
    banded = classes.select("class", F.explode(F.array(*names)).alias("bucket"))
    buckets = written(banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    inside = written(banded.join(buckets.hint("merge"), "bucket"), "bucket_members")
    weights = written(inside.groupBy("class").agg(F.sum("n").alias("weight")), "class_weights")
    weighed = written(inside.drop("n").join(weights.hint("merge"), "class"), "bucket_members")
    centres = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "class")).alias("most"))
    centres = written(centres.select("bucket", F.col("most.class").alias("centre")), "bucket_centres")
    centred = weighed.join(centres.hint("merge"), "bucket").filter("class <> centre")
    return centred.select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct()


def links_inside(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, labels: np.ndarray, percent: int) -> np.ndarray:
    """Rows (i, j), i of `left` and j of `right`, of sets that are linked and have different labels."""
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = np.cumsum(times > 1) - 1
    kept = times[place] > 1
    owner, place = owner[kept], often[place[kept]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((len(left), len(right)), "f4")
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        at, end = np.searchsorted(place, (low, low + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), "f4")
        held[owner[at:end], place[at:end] - low] = 1
        both += held[left] @ held[right].T
    either = sizes[left][:, None] + sizes[right][None] - both
    found = (100 * both >= percent * either) & (labels[left][:, None] != labels[right][None])
    i, j = np.nonzero(found)
    return np.column_stack((left[i], right[j]))


def compare_rest(stars: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between classes that met one centre but are in different components so far.

    Two classes that share a bucket share its centre, so no candidate is missed. The classes of a centre are dealt
    to blocks of about BLOCK_SIZE, and each pair of blocks is compared in one task, which returns links only: a
    large group costs many bounded tasks, and none of its pairs is a row. Centres whose classes are all of one
    component are settled and left out.
    """
    own = F.coalesce("component", "class").alias("component")
    met = stars.select(F.col("a").alias("centre"), F.col("b").alias("class"))
    met = written(met.join(labels.hint("merge"), "class", "left").select("centre", "class", own), "star_labels")
    sizes = met.groupBy("centre").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    blocks = F.ceil(F.col("n") / F.lit(BLOCK_SIZE)).cast("int").alias("blocks")
    open_ = written(sizes.filter("low <> high").select("centre", blocks), "open_centres")
    members = met.join(open_.hint("merge"), "centre")
    members = members.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    held = written(members.join(texts.hint("merge"), "class"), "open_members")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = held.withColumn("other", other).select(
        "centre", "class", "component", "text", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )

    def run(table: pa.Table) -> pa.Table:
        ids, labels_ = table.column("class").to_numpy(), table.column("component").to_numpy()
        sets = [shingles(t.as_py()) for t in table.column("text")]
        own_, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        left, right = np.flatnonzero(own_ == i[0]), np.flatnonzero(own_ == j[0])
        found = links_inside(sets, left, right, labels_, percent) if len(left) and len(right) else np.empty((0, 2), "i8")
        return pa.table({"a": ids[found[:, 0]], "b": ids[found[:, 1]]})

    return written(dealt.groupBy("centre", "i", "j").applyInArrow(run, "a long, b long"), "near_links")


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Groups of documents whose shingle sets are alike, one row per document.

    Returns doc_id, n_shingles (size of the set), component_id (the least doc_id reachable over links with
    100 * |a and b| >= percent * |a or b|, itself included), kept (doc_id = component_id) and row (the key of
    the row, `common.row_key`).

    Documents without words, null ones too, have an empty set and are linked with nothing. Null ids come
    after all others as the least of a component; where a component, or an empty document, has no other id,
    component_id is null and the row with the least key is kept. Repeated rows are in one class and each get a
    row. An empty table gives no rows. Extra columns are ignored.
    """
    names = [f"b{i}" for i in range(bands)]
    sketched = written(sketch(docs, doc_id, text, bands, rows), "sketches")
    member = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    filled = sketched.filter("set_digest IS NOT NULL").withColumn("class", F.xxhash64("set_digest"))
    classes = filled.groupBy("class", "n_shingles", *names).agg(F.min(member).alias("least"))
    classes = written(classes, "set_classes")

    stars = written(meeting(classes, names), "near_stars")
    texts = texts_of(stars, classes, docs, doc_id, text)
    links = confirm(stars, texts, percent)
    labels = components(links)
    more = compare_rest(stars, labels, texts, percent)
    if not more.isEmpty():
        labels = components(links.union(more))

    # A group's least member, then each class with its own or its group's.
    grouped = classes.select("class", "least").join(labels, "class", "left")
    grouped = written(grouped.withColumn("component", F.coalesce("component", "class")), "class_groups")
    least = written(grouped.groupBy("component").agg(F.min("least").alias("first")), "group_firsts")
    firsts = written(grouped.join(least.hint("merge"), "component").select("class", "first"), "class_firsts")
    own = sketched.filter("set_digest IS NULL").select("doc_id", "n_shingles", "row", member.alias("first"))
    linked = filled.select("doc_id", "n_shingles", "row", "class").join(firsts.hint("merge"), "class").drop("class")
    every = linked.unionByName(own)
    kept = (F.struct("doc_id") == F.struct("first.doc_id")) & (F.col("doc_id").isNotNull() | (F.col("row") == F.col("first.row")))
    return every.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), kept.alias("kept"), "row")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group stays: the one with the least id; of repeated rows one. Columns stay as they are."""
    row = fresh(docs, "td_row")
    verdicts = near_duplicates(docs, percent, doc_id, text)
    keep = written(verdicts.filter("kept").select(F.col("row").alias(row)).distinct(), "near_kept")
    kept = docs.withColumn(row, row_key(doc_id, text)).join(keep.hint("merge"), row, "left_semi")
    return kept.dropDuplicates([row]).drop(row)
