"""Toxicity: a support vector machine on a gapped string kernel with Nyström landmarks.

Words are compared by their common subsequences of four characters. A subsequence may skip up to two
characters and then counts less, so that an insult with inserted, dropped or doubled characters stays near the
plain one. A word begins and ends with a mark that subsequences may hold, so a stem at the front of a word
differs from the same letters inside one. The kernel of two sentences is the sum over their words, and a
text is as toxic as its most toxic word.

Labels are given for whole texts, so training finds which words of a toxic text are at fault: it begins with the
words that toxic texts favour, fits the machine on the Nyström features of these and of the words of clean
texts, and takes the most toxic word of each text under the new machine for the next round.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import col
from tidemark.llm.quality import fold_of, logistic, training_rows

#: Most labelled documents that a model is fitted on; the choice is by a hash of the id.
MOST_LABELLED = 8_000
LANDMARKS = 192
ROUNDS = 3
#: A word can be at fault only if the log-odds of its use in toxic against clean texts are larger.
SUSPECT = 1.5
#: Standard errors that the odds of a landmark are lowered by.
CHANCE = 1.4
#: The words of clean texts that the machine is fitted on: the most frequent, and after each round those it gets wrong most
#: often. None takes all of them.
CLEAN_WORDS, WRONG_WORDS = 8_000, 4_000
BITS = 20
DECAY = 0.6
#: Offsets of the second to fourth character of a subsequence: four characters within six.
GAPS = tuple(g for g in combinations(range(1, 6), 3))
WEIGHTS = tuple(DECAY ** (g[2] - 3) for g in GAPS)
#: Characters that are scored at a time.
BLOCK = 1 << 19

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], "u8")
#: Digits and signs that stand for letters.
_STANDS_FOR = {ord(a): ord(b) for a, b in zip("013457@", "oieasta", strict=True)}
_SPACE, _DROP = 0, 0xFFFF


def _classes() -> np.ndarray:
    """Of each 16-bit character: itself if it belongs to a word, _SPACE, or _DROP for marks."""
    table = np.full(1 << 16, _DROP, "u2")
    for c in range(1 << 16):
        ch = chr(c)
        if ch.isspace():
            table[c] = _SPACE
        elif ch.isalnum():
            table[c] = _STANDS_FOR.get(c, c)
    table[ord("@")] = ord("a")
    return table


_CLASS = _classes()


def characters(text: str | None) -> np.ndarray:
    """Lower-case word characters with one _SPACE before, between and after words.

    Marks inside and around words are dropped; letters that stand alone one after another join to a word.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.where(points < 1 << 16, _CLASS[points & 0xFFFF], (points & 0x7FFF) | 0x8000)
    codes = np.concatenate(([_SPACE], codes[codes != _DROP], [_SPACE]))
    codes = codes[np.concatenate(([True], (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)))]
    spaces = np.flatnonzero(codes == _SPACE)
    if len(spaces) > 2:
        alone = np.diff(spaces) == 2  # words of one letter
        codes = np.delete(codes, spaces[1:-1][alone[:-1] & alone[1:]])
    return codes


def grams(codes: np.ndarray):
    """For each gap pattern: the bucket of the subsequence at each place, and its weight (0: reaches into another word)."""
    wide = codes.astype("u8")
    keyed = [wide * m for m in _MIX]
    spaces = np.cumsum(codes == _SPACE)
    for gap, weight in zip(GAPS, WEIGHTS, strict=True):
        n = len(codes) - gap[2]
        if n <= 0:
            continue
        sums = keyed[0][:n] + keyed[1][gap[0] : gap[0] + n] + keyed[2][gap[1] : gap[1] + n] + keyed[3][gap[2] :]
        buckets = ((sums ^ (sums >> np.uint64(31))) * _MIX[1]) >> np.uint64(64 - BITS)
        inside = spaces[gap[2] - 1 : gap[2] - 1 + n] == spaces[:n]
        yield buckets.astype("i8"), np.where(inside, weight, 0.0)


def embed(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of one word, of length 1."""
    found = list(grams(word))
    if not found:
        return np.empty(0, "i8"), np.empty(0)
    buckets, weights = np.concatenate([b for b, _ in found]), np.concatenate([w for _, w in found])
    norm = np.sqrt(weights @ weights)
    return buckets[weights > 0], weights[weights > 0] / norm if norm else weights[:0]


class Machine:
    """Scores texts with one weight for each bucket, the intercept, and the map from decision to probability."""

    def __init__(self, vector: np.ndarray, bias: float, slope: float, offset: float):
        self.vector, self.bias, self.slope, self.offset = vector, bias, slope, offset

    def words(self, codes: np.ndarray) -> np.ndarray:
        """The decision for each word of `characters`."""
        starts = np.flatnonzero(codes[:-1] == _SPACE)
        if len(codes) < 3:
            return np.empty(0)
        hits, norms = np.zeros(len(codes)), np.zeros(len(codes))
        for buckets, weights in grams(codes):
            hits[: len(buckets)] += self.vector[buckets] * weights
            norms[: len(buckets)] += weights * weights
        sums, squares = np.add.reduceat(hits[:-1], starts), np.add.reduceat(norms[:-1], starts)
        return self.bias + sums / np.sqrt(np.maximum(squares, 1e-12))

    def decision(self, text: str | None) -> float:
        """That of the most toxic word; the intercept for a text without words."""
        codes, most = characters(text), self.bias
        while len(codes) > 2:
            cut = len(codes)
            if cut > BLOCK:
                near = np.flatnonzero(codes[BLOCK:] == _SPACE)
                cut = BLOCK + int(near[0]) + 1
            most = max(most, float(self.words(codes[:cut]).max(initial=self.bias)))
            codes = codes[cut - 1 :]
        return most

    def score(self, text: str | None) -> float:
        return float(logistic(self.slope * self.decision(text) + self.offset))

    def pack(self) -> bytes:
        return np.concatenate((self.vector, [self.bias, self.slope, self.offset])).astype("<f4").tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Machine:
        x = np.frombuffer(data, "<f4").astype(float)
        return cls(x[:-3], *map(float, x[-3:]))


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """The linear machine that minimises ridge/2 |w|^2 + sum cost * max(0, 1 - y x.w)^2, by Newton steps."""
    w, kept = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    kept[-1, -1] = 1e-6  # the intercept is free
    active = np.ones(len(y), bool)
    for _ in range(30):
        a = x[active] * (2 * cost[active])[:, None]
        w = np.linalg.solve(kept + x[active].T @ a, a.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps with a slight pull to 0."""
    x, w = np.column_stack((z, np.ones(len(z)))), np.zeros(2)
    for _ in range(30):
        p = logistic(x @ w)
        hessian = x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + np.diag([1e-2, 1e-4])
        w -= np.linalg.solve(hessian, x.T @ (p - y) + np.array([1e-2, 1e-4]) * w)
    return float(w[0]), float(w[1])


def train(
    texts: list[str | None], labels: list[int], clean_words: int | None = CLEAN_WORDS, wrong_words: int | None = WRONG_WORDS
) -> Machine:
    """A machine from labelled texts; without both labels it gives every text the share of label 1 (0.5 if none)."""
    y = np.array(labels, float)
    coded = [characters(t) for t in texts]
    share = float(y.mean()) if len(y) else 0.5
    flat = Machine(np.zeros(1 << BITS), 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if not len(y) or y.min() == y.max():
        return flat
    held: list[list[bytes]] = []
    met: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for codes, label in zip(coded, labels, strict=True):
        cuts = np.flatnonzero(codes == _SPACE)
        raw = codes.astype("<u2").tobytes()
        words = {raw[2 * a : 2 * b + 2] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)}
        held.append(sorted(words))
        met[label].update(words)
    n1, n0 = y.sum(), (1 - y).sum()
    odds = {w: np.log((k + 0.5) / (n1 + 1)) - np.log((met[0][w] + 0.5) / (n0 + 1)) for w, k in met[1].items()}
    # Landmarks and the first round take words whose odds are large beyond chance.
    sure = {w: odds[w] - CHANCE * np.sqrt(1 / (k + 0.5) + 1 / (met[0][w] + 0.5)) for w, k in met[1].items()}
    suspect = sorted((w for w in sure if sure[w] > SUSPECT), key=lambda w: (-met[1][w] * odds[w], w))
    if not suspect:
        return flat
    common = sorted(met[0], key=lambda w: (-met[0][w], w))
    landmarks = suspect[: LANDMARKS // 2]
    landmarks += [w for w in common if w not in set(landmarks)][: LANDMARKS - len(landmarks)]

    # Kernel columns only for buckets that landmarks have.
    marks = [embed(np.frombuffer(w, "<u2")) for w in landmarks]
    buckets = np.unique(np.concatenate([b for b, _ in marks]))
    table = np.zeros((len(buckets) + 1, len(landmarks)))
    for j, (b, v) in enumerate(marks):
        np.add.at(table[:, j], np.searchsorted(buckets, b), v)

    rows: dict[bytes, np.ndarray] = {}

    def kernel(words: list[bytes]) -> np.ndarray:
        for w in words:
            if w not in rows:
                b, v = embed(np.frombuffer(w, "<u2"))
                at = np.minimum(np.searchsorted(buckets, b), len(buckets) - 1)
                rows[w] = v @ table[np.where(buckets[at] == b, at, len(buckets))]
        return np.array([rows[w] for w in words])

    between = kernel(landmarks)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    kept = values > 1e-6 * values.max()
    project = vectors[:, kept] / np.sqrt(values[kept])

    def machine(w: np.ndarray) -> Machine:
        vector = np.zeros(1 << BITS)
        vector[buckets] = table[:-1] @ (project @ w[:-1])
        return Machine(vector, float(w[-1]), 1.0, 0.0)

    negatives = [w for w in common if odds.get(w, -9) < SUSPECT / 2][:clean_words]
    toxic = [i for i, label in enumerate(labels) if label]
    chosen = {i: max(held[i], key=lambda w: (sure.get(w, -9), w)) for i in toxic if held[i]}
    chosen = {i: w for i, w in chosen.items() if sure[w] > SUSPECT}
    model = flat
    for _ in range(ROUNDS):
        positives = sorted(set(chosen.values()))
        words = positives + negatives
        x = kernel(words) @ project
        x = np.column_stack((x, np.ones(len(x))))
        sign = np.concatenate((np.ones(len(positives)), -np.ones(len(negatives))))
        uses = Counter(chosen.values())
        cost = np.array([uses[w] for w in positives] + [1 + np.log1p(met[0][w]) for w in negatives])
        cost[sign > 0] *= cost[sign < 0].sum() / 2 / cost[sign > 0].sum()
        model = machine(squared_hinge(x, sign, cost))
        best = [model.words(c) for c in coded]
        chosen, wrong = {}, Counter()
        for i, found in enumerate(best):
            if not len(found):
                continue
            top = int(found.argmax())
            cuts = np.flatnonzero(coded[i] == _SPACE)
            word = coded[i][cuts[top] : cuts[top + 1] + 1].astype("<u2").tobytes()
            if labels[i] and odds.get(word, 0) > SUSPECT:
                chosen[i] = word
            elif not labels[i] and found[top] > -0.5:
                wrong[word] += 1
        negatives = list(dict.fromkeys(negatives + [w for w, _ in wrong.most_common(wrong_words)]))
        if not chosen:
            return flat
    z = np.array([float(b.max(initial=model.bias)) for b in (model.words(c) for c in coded)])
    model.slope, model.offset = platt(z, y)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    fold: Column,
    label: str,
    doc_id: str,
    text: str,
    most: int = MOST_LABELLED,
    clean_words: int | None = CLEAN_WORDS,
    wrong_words: int | None = WRONG_WORDS,
) -> bytes:
    """A packed machine (4 MB) learnt from at most `most` labelled documents outside the fold, in one task."""
    chosen = training_rows(labels, label, fold, most, doc_id)
    texts = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("turn", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marks = [], []
        for b in batches:
            texts += b.column("text").to_pylist()
            marks += b.column("label").to_pylist()
        yield pa.RecordBatch.from_pydict({"model": [train(texts, marks, clean_words, wrong_words).pack()]})

    one = rows.repartition(1).sortWithinPartitions("turn", "text", "label")
    fitted = one.mapInArrow(run, "model binary").collect()
    return bytes(fitted[0].model) if fitted else train([], []).pack()


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held: int = 0,
    threshold: float = 0.5,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = MOST_LABELLED,
    clean_words: int | None = CLEAN_WORDS,
    wrong_words: int | None = WRONG_WORDS,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Labels are learnt only outside the fold `held`. The score sees the whole text and nothing else. Null and
    empty texts, and texts without a letter or digit, have no word: their score is that of the intercept.
    Without labels of both kinds every score is the share of label 1 among them, 0.5 if there is none.
    Repeated rows, and equal texts, have equal scores. Texts of any length are read whole, block by block. `clean_words` and
    `wrong_words` bound the words that the machine is fitted on; None fits it on all. An empty table gives no rows. Extra
    columns are ignored.
    """
    packed = fit(docs, labels, fold_of(F.col("doc_id"), folds, held), label, doc_id, text, most, clean_words, wrong_words)
    rows = docs.select(
        col(doc_id).alias("doc_id"), fold_of(col(doc_id), folds, held).alias("held_out"), col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Machine.unpack(packed)
        for batch in batches:
            scores = pa.array([model.score(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], ["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
