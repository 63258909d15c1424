"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader.

A whole text becomes a sparse vector of hashed n-grams of its words and of their shapes (case and
the marks around a word). Training goes document by document with FTRL-Proximal updates; a score is the
logistic function of a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import col, fresh

BITS = 20
#: The most labelled documents that a model is fitted on; the choice is by a hash of the id.
MOST_LABELLED = 20_000
PASSES = 5
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-4
#: Words whose hashes a worker remembers.
REMEMBERED = 100_000

_CORE = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "u8")


def shape(core: str) -> str:
    if not core:
        return "-"
    if core.isdigit():
        return "0"
    if not core.isalpha():
        return "?"
    if core.islower():
        return "a"
    if core.isupper():
        return "A" if len(core) > 1 else "I"
    return "Aa" if core[1:].islower() else "aA"


def word_codes(word: str) -> tuple[int, int]:
    """Hashes of a word without the marks around it, in lower case, and of its shape with them."""
    before, core, after = _CORE.match(word).groups()
    return (
        xxhash.xxh64_intdigest(core.lower().encode("utf-8", "surrogatepass")),
        xxhash.xxh64_intdigest(f"{shape(core)}\0{before}\0{after}".encode("utf-8", "surrogatepass"), seed=1),
    )


class Features:
    """Turns texts into sparse vectors: (places, values), sorted by place."""

    def __init__(self, bits: int = BITS):
        self.bits, self.known = bits, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.empty(0, "i8"), np.empty(0)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = word_codes(w)
        codes = np.array([known[w] for w in words], "u8")
        plain, shapes = codes[:, 0], codes[:, 1]
        # A word that comes again at once has a shape of its own, whatever the word is.
        again = np.concatenate(([False], plain[1:] == plain[:-1]))
        shapes = np.where(again, _ODD[2], shapes)
        parts = [self._grams(plain, (1, 2)), self._grams(shapes, (1, 2, 3))]
        places = np.concatenate([p for p, _ in parts])
        values = np.concatenate([v for _, v in parts])
        order = np.argsort(places, kind="stable")
        return places[order], values[order]

    def _grams(self, codes: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Hashed n-grams of one kind with damped counts, of length 1 together."""
        found = []
        for n in sizes:
            if len(codes) >= n:
                sums = np.full(len(codes) - n + 1, n, "u8")
                for k in range(n):
                    sums = (sums ^ (sums >> np.uint64(29))) * _ODD[1] + codes[k : len(codes) - n + 1 + k] * _ODD[0]
                found.append((sums ^ (sums >> np.uint64(32))) * _ODD[2] >> np.uint64(64 - self.bits))
        places, counts = np.unique(np.concatenate(found).astype("i8"), return_counts=True)
        values = np.log1p(counts)
        return places, values / np.sqrt(values @ values)


class Ftrl:
    """FTRL-Proximal for logistic loss, with lazily computed weights; the last place is the intercept."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        g = (logistic(w @ values) - label) * values
        more = self.n[places] + g * g
        self.z[places] += g - (np.sqrt(more) - np.sqrt(self.n[places])) / self.alpha * w
        self.n[places] = more


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def training_rows(labels: DataFrame, label: str, fold: Column, most: int, doc_id: str) -> DataFrame:
    """At most `most` labelled ids outside the fold, the least by a hash of the id, with that hash."""
    known = labels.select(col(doc_id).alias("doc_id"), col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~fold)
    hashed = known.withColumn("turn", F.xxhash64(F.lit("train"), "doc_id"))
    return hashed.orderBy("turn", "doc_id", "label").limit(most)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fold: Column,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_LABELLED,
    passes: int = PASSES,
    bits: int = BITS,
) -> bytes:
    """Weights (float32, 2**bits places and the intercept) learnt from labelled documents.

    `fold` is a boolean column of `doc_id`: rows where it is true are never learnt from. At most `most`
    labelled documents are used, so their ids may be broadcast to find the texts, and one task may train.
    Labels other than 0 and 1, null ones and ids without a document are left out. With nothing to learn from all
    weights are 0.
    """
    chosen = training_rows(labels, label, fold, most, doc_id)
    texts = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("turn", "label", "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column("text")]
            columns = [
                batch.column("turn"),
                batch.column("label"),
                pa.array([p.astype("i4") for p, _ in found], pa.list_(pa.int32())),
                pa.array([v.astype("f4") for _, v in found], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["turn", "label", "places", "vals"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, size = Ftrl(2**bits), 2**bits
        held = []
        for b in batches:
            for y, p, v in zip(*(b.column(c) for c in ("label", "places", "vals")), strict=True):
                held.append((y.as_py(), p.values.to_numpy(), v.values.to_numpy()))
        for _ in range(passes):
            for y, p, v in held:
                model.update(np.append(p, size), np.append(v, 1.0), y)
        weights = model.weights(slice(None)).astype("<f4")
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()]})

    vectors = rows.mapInArrow(hashed, "turn long, label int, places array<int>, vals array<float>")
    one = vectors.repartition(1).sortWithinPartitions("turn", F.xxhash64("places"), "label")
    fitted = one.mapInArrow(train, "weights binary").collect()
    return bytes(fitted[0].weights) if fitted else bytes(4 * (2**bits + 1))


def with_score(docs: DataFrame, weights: bytes, score: str, text: str = "text") -> DataFrame:
    """`docs` with the column `score`: the probability of label 1 for each whole text."""
    bits = (len(weights) // 4 - 1).bit_length() - 1

    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = np.frombuffer(weights, "<f4").astype(float), Features(bits)
        for batch in batches:
            out = []
            for t in batch.column(place):
                places, values = features(t.as_py())
                out.append(float(logistic(w[places] @ values + w[-1])))
            yield batch.append_column("score", pa.array(out, pa.float64()))

    # Plain names for the way through Arrow, whatever the columns are called.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, score)


def fold_of(doc_id: Column, folds: int, held: int) -> Column:
    """Whether crc32 of the id as text, modulo `folds`, is `held`; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == held, F.lit(False))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held: int = 2,
    threshold: float = 0.7,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_LABELLED,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Labels are learnt only outside the fold `held`. The score sees the whole text and nothing else. Null and
    empty texts have no n-grams: their score is that of the intercept. Without any label every score
    is 0.5. Repeated rows have equal scores. An empty table gives no rows. Extra columns are ignored.
    """
    weights = fit(docs, labels, fold_of(F.col("doc_id"), folds, held), doc_id=doc_id, text=text, most=most)
    rows = docs.select(
        col(doc_id).alias("doc_id"), fold_of(col(doc_id), folds, held).alias("held_out"), col(text).cast("string").alias("text")
    )
    scored = with_score(rows, weights, "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held: int = 2,
    threshold: float = 0.7,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_LABELLED,
) -> DataFrame:
    """The documents whose score, as in `score_quality`, reaches the threshold; columns stay as they are.

    Without any label nothing can be judged and all documents stay.
    """
    weights = fit(docs, labels, fold_of(F.col("doc_id"), folds, held), doc_id=doc_id, text=text, most=most)
    if not any(weights):
        return docs
    score = fresh(docs, "td_score")
    return with_score(docs, weights, score, text).filter(col(score) >= threshold).drop(score)
