"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are integer inner products. Rows are dealt into buckets by descending length. Inside a bucket every coordinate of
the unit vectors has a sorted list; for an anchor the coordinates of greatest magnitude are its focus. A row can reach a
threshold only if each focus coordinate lies in a range that the threshold allows, so the ranges cut slices from the
sorted lists, the slices are intersected, and only what is left is multiplied out. Thresholds rise as better rows are met,
and a bucket whose greatest length cannot reach the threshold ends the search.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import col, written

#: Rows of one bucket, rows of one stretch of sorted lists inside it, and anchors of one block: a task holds one of each.
BUCKET_ROWS, STRETCH_ROWS, BLOCK_ANCHORS = 16384, 4096, 1024
#: Coordinates whose ranges are intersected.
FOCUS = 3
#: Greatest magnitude of a component whose scores are sure to fit a long, up to 2048 dimensions.
LARGEST = 1 << 26
#: Rounding of unit vectors never excludes a row.
SLACK = 1e-9


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double. Null where a component is null or not finite, or beyond LARGEST."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale) > LARGEST))
    return F.when(x.isNotNull() & ~odd, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("int")))


def participants(rows: DataFrame, row_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, v, size) of the rows that take part; where an id repeats, the smallest (label, vector) stands for it."""
    some = rows.select(col(row_id).cast("long").alias("id"), col(label).cast("long").alias("label"), quantised(col(vector), scale).alias("v"))
    some = some.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    once = some.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    return once.withColumn("size", F.sqrt(square))


def length_buckets(rows: DataFrame, n_buckets: int) -> DataFrame:
    """The rows with the bucket that their place in the order of descending length gives; equal lengths go by id."""
    dealt = rows.repartitionByRange(n_buckets, F.desc("size"), F.col("id"))
    return written(dealt.withColumn("bucket", F.spark_partition_id()), "length_buckets")


def matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a float64 matrix, or int64 where a float could round; missing components count as zero."""
    lists = lists.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widest(lists: pa.ChunkedArray) -> int:
    return max((len(v) for v in lists), default=0)


class Stretch:
    """Rows of nearly one length with a sorted list for each coordinate that an anchor looked at."""

    def __init__(self, ids, labels, vectors, sizes):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.longest, self.shortest = float(sizes.max()), float(sizes.min())
        self.unit = vectors / np.where(sizes > 0, sizes, 1.0)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int):
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def least_cosine(self, size: float, threshold: float) -> float:
        """The cosine that a row needs at least to score `threshold`; above 1 none can."""
        other = self.longest if threshold > 0 else self.shortest
        if threshold == -math.inf or size * other == 0:
            return 2.0 if threshold > 0 else -1.0
        return threshold / (size * other) - SLACK

    def candidates(self, unit: np.ndarray, focus: np.ndarray, cosine: float):
        """Rows whose focus coordinates all lie in the ranges that the cosine allows; None for all rows."""
        if cosine <= -1:
            return None
        angle, met, asked = math.acos(min(cosine, 1.0)), None, 0
        for f in focus:
            own = math.acos(min(1.0, max(-1.0, unit[f])))
            low, high = math.cos(min(math.pi, own + angle)) - SLACK, math.cos(max(0.0, own - angle)) + SLACK
            order, values = self.sorted_list(int(f))
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if a == 0 and b == len(values):
                continue  # this coordinate excludes nothing
            met = np.zeros(len(values), np.int8) if met is None else met
            met[order[a:b]] += 1
            asked += 1
        return None if met is None else np.flatnonzero(met == asked)


class Anchor:
    def __init__(self, vector: np.ndarray):
        self.vector = vector
        self.size = math.sqrt(float((vector.astype(np.float64) ** 2).sum()))
        self.unit = vector / self.size if self.size else vector.astype(np.float64)
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]


class Best:
    """The first `k` rows met with scores from `low` to `high`: higher scores first, ties by smaller id."""

    def __init__(self, k: int, low: float = -math.inf, high: float = math.inf):
        self.k, self.high, self.threshold = k, high, low
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = (scores >= self.threshold) & (scores <= self.high)
        if not fit.any():
            return
        s, i = np.concatenate([self.scores, scores[fit]]), np.concatenate([self.ids, ids[fit]])
        order = np.lexsort((i, -s))[: self.k]
        self.scores, self.ids = s[order], i[order]
        if len(order) == self.k:
            self.threshold = max(self.threshold, float(self.scores[-1]))


def search(stretches: list[Stretch], anchor: Anchor, fits, bests: list[Best]) -> None:
    """Fill `bests` from the stretches, which come by descending length; `fits(stretch, rows)` is a mask of rows."""
    for stretch in stretches:
        threshold = min(b.threshold for b in bests)
        cosine = stretch.least_cosine(anchor.size, threshold)
        if cosine > 1:
            if threshold > 0:
                return  # later rows are shorter still
            continue
        rows = stretch.candidates(anchor.unit, anchor.focus, cosine)
        rows = np.arange(len(stretch.ids)) if rows is None else rows
        rows = rows[fits(stretch, rows)]
        if len(rows):
            scores = (stretch.vectors[rows] @ anchor.vector).astype(np.int64)
            for best in bests:
                best.add(scores, stretch.ids[rows])


def block_of(rows: pa.Table, anchors: pa.Table) -> tuple[list[Stretch], list[Anchor]]:
    """The stretches of a bucket and the anchors of a block. Floats hold the scores exactly below 2^53, else integers do."""
    width = max(widest(rows["v"]), widest(anchors["v"]))
    vectors, wanted = matrix(rows["v"], width), matrix(anchors["v"], width)
    sizes = rows["size"].to_numpy()
    largest = float(sizes.max(initial=0)) * math.sqrt(float((wanted.astype(np.float64) ** 2).sum(1).max(initial=0)))
    if largest < 2.0**52:
        vectors, wanted = vectors.astype(np.float64), wanted.astype(np.float64)
    order = np.lexsort((rows["id"].to_numpy(), -sizes))
    ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
    cuts = [order[a : a + STRETCH_ROWS] for a in range(0, len(order), STRETCH_ROWS)]
    return [Stretch(ids[c], labels[c], vectors[c], sizes[c]) for c in cuts], [Anchor(q) for q in wanted]


POSITIVES = "anchor_id long, other_id long, score long"
NEGATIVES = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def nearest_of_label(n_positives: int):
    """For each anchor of a block the best rows of a bucket with its label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        stretches, vectors = block_of(rows, anchors)
        for a, label, anchor in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), vectors):
            best = Best(n_positives)
            search(stretches, anchor, lambda s, r: (s.labels[r] == label) & (s.ids[r] != a), [best])
            out[0] += [a] * len(best.ids)
            out[1] += best.ids.tolist()
            out[2] += best.scores.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("anchor_id", "other_id", "score"), out)})

    return run


def below_positives(n_negatives: int, low: int, high: int):
    """For each anchor and positive the best rows of a bucket with another label and a score in the positive's range."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names = [part.split()[0] for part in NEGATIVES.split(", ")]
        out = {n: [] for n in names}
        stretches, vectors = block_of(rows, anchors)
        for a, label, positives, anchor in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), anchors["positives"].to_pylist(), vectors):
            # low * p <= 100 * s <= high * p in whole numbers; no score fits below a negative positive.
            ranges = [(p, -(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            held = [(p, Best(n_negatives, least, most)) for p, least, most in ranges if least <= most]
            if not held:
                continue
            search(stretches, anchor, lambda s, r: s.labels[r] != label, [b for _, b in held])
            for p, best in held:
                values = (a, p["other_id"], None, p["score"], None)
                for name, value in zip(names, values):
                    out[name] += [value] * len(best.ids)
                out["negative_id"][len(out["negative_id"]) - len(best.ids) :] = best.ids.tolist()
                out["negative_score"][len(out["negative_score"]) - len(best.ids) :] = best.scores.tolist()
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return run


def against_all(table: DataFrame, anchors: DataFrame, n_buckets: int, n_blocks: int, run, schema: str) -> DataFrame:
    """`run(bucket, block)` for every bucket of rows and every block of anchors, each pair one bounded task."""
    rows = table.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = anchors.drop("bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
    asked = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))))
    return rows.groupBy("bucket", "block").cogroup(asked.groupBy("bucket", "block")).applyInArrow(run, schema)


def first_of(rows: DataFrame, keys: list[str], score: str, other: str, n: int) -> DataFrame:
    """The first `n` rows of each key with their rank; Spark cuts each task's rows to `n` a key before the exchange."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine_hard_negatives(
    rows: DataFrame,
    anchor_every: int = 100,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    bucket_rows: int = BUCKET_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """Hard negatives of every anchor (rows whose id is divisible by `anchor_every`), exact over all rows.

    Components become floor(scale * x). An anchor's positives are its first `n_positives` other rows of the same label;
    for each, its first `n_negatives` rows of another label with low * positive_score <= 100 * score <= high * positive_score
    come back with their rank. Higher scores come first, ties by smaller id; where fewer rows fit, all of them.

    Rows with a null id, label or vector, or with a component that is null, not finite, or beyond 2^26 once scaled, take no
    part. Rows that share an id count once, as the smallest (label, vector). A shorter vector counts as filled up with
    zeros, an empty one scores 0 with all. An anchor without positives, or whose positives score below zero, has no rows.
    An empty table gives no rows. Other columns of `rows` are ignored, whatever their names.
    """
    n_buckets = max(1, math.ceil(rows.count() / bucket_rows))
    table = length_buckets(participants(rows, row_id, label, vector, scale), n_buckets)
    n_buckets = (table.agg(F.max("bucket")).first()[0] or 0) + 1
    anchors = table.filter(F.col("id") % anchor_every == 0)
    n_blocks = max(1, math.ceil(anchors.count() / block_anchors))
    near = against_all(table, anchors, n_buckets, n_blocks, nearest_of_label(n_positives), POSITIVES)
    near = first_of(near, ["anchor_id"], "score", "other_id", n_positives)
    grouped = near.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("positives"))
    asked = written(anchors.join(grouped, "id"), "positives")
    found = against_all(table, asked, n_buckets, n_blocks, below_positives(n_negatives, low, high), NEGATIVES)
    ranked = first_of(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", n_negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
