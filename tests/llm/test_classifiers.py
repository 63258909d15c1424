import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import frame, odd, words

from tidemark.llm import queries, toxicity
from tidemark.llm.quality import Features, Ftrl, keep_good, logistic, score_quality
from tidemark.llm.toxicity import Machine, characters, score_toxicity, train

ROOT = "/root/testdata/sf0.1"


def labelled(rng, n=300):
    docs, labels = [], []
    for i in range(n):
        bad, rude = rng.random() < 0.3, rng.random() < 0.3
        w = words(rng, rng.randrange(20, 120)).split()
        if bad:
            w = [x + "***" for x in w]
        if rude:
            w[rng.randrange(len(w))] = rng.choice(["blockhead", "numbskull"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(rude)))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_quality_learns_and_odd_rows_get_scores(spark):
    docs, labels = labelled(random.Random(5))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (10**6, 0, 0), (4, 7, 7)], LABELS)
    extra = [(1000 + k, t) for k, (_, t) in enumerate(odd())]
    got = {r.doc_id: r for r in score_quality(frame(spark, docs + extra), marks).collect()}
    assert len(got) == len(docs) + len(extra)
    held = [(got[i].score, y) for i, y, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[1000].score == got[1001].score == got[1002].score  # no words: the intercept


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = labelled(random.Random(6), 120)
    turned = [(i, 1 - q, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in labels]
    a, b = (
        {r.doc_id: r.score for r in score_quality(frame(spark, docs), spark.createDataFrame(x, LABELS)).collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_no_labels_no_documents(spark):
    docs, none = frame(spark, odd()), spark.createDataFrame([], LABELS)
    assert {r.score for r in score_quality(docs, none).collect()} == {0.5}
    assert keep_good(docs, none).count() == len(odd())
    assert {r.score for r in score_toxicity(docs, none).collect()} == {0.5}
    assert score_quality(frame(spark, []), none).count() == 0
    assert score_toxicity(frame(spark, []), none).count() == 0
    one_kind = spark.createDataFrame([(6, 1, 1), (7, 1, 1)], LABELS)
    assert all(r.score > 0.9 for r in score_toxicity(docs, one_kind).collect())


def test_kept_documents_are_unchanged(spark):
    docs, labels = labelled(random.Random(7), 200)
    kept = keep_good(frame(spark, docs), spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame(spark, []).columns
    texts = dict(docs)
    assert all(texts[r.doc_id] == r.text for r in kept.collect())


def test_ftrl_agrees_with_a_plain_version():
    rng = np.random.default_rng(0)
    model, z, n = Ftrl(50, l1=0.01), np.zeros(51), np.zeros(51)
    for _ in range(200):
        places = rng.choice(50, 6, replace=False)
        values, label = rng.random(6), int(rng.random() < 0.5)
        w = {}
        for i in places:
            w[i] = 0.0 if abs(z[i]) <= 0.01 else -(z[i] - np.sign(z[i]) * 0.01) / ((1 + n[i] ** 0.5) / 0.3 + 1e-4)
        p = logistic(sum(w[i] * v for i, v in zip(places, values, strict=True)))
        for i, v in zip(places, values, strict=True):
            g = (p - label) * v
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.3
            z[i] += g - sigma * w[i]
            n[i] += g * g
        model.update(places, values, label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_features_are_whole_and_of_length_one():
    f = Features(16)
    places, values = f(words(random.Random(1), 5000))
    assert np.isclose(values @ values, 2)  # one for words, one for shapes
    assert len(f(None)[0]) == len(f("  ")[0]) == 0


def test_insults_with_gaps_and_inserted_characters():
    docs, labels = labelled(random.Random(9), 600)
    model = train([t for _, t in docs], [r for _, _, r in labels])
    plain = words(random.Random(2), 200)
    for insult in ("blockhead", "BLOCKHEAD!", "block-head", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "bloockhead", "blockheadd", "numbskul"):
        assert model.score(f"{plain} {insult} {plain}") > 0.5, insult
    assert model.score(plain) < 0.5
    again = Machine.unpack(model.pack())
    assert abs(again.score(plain) - model.score(plain)) < 1e-4


def test_long_texts_are_scored_in_pieces(monkeypatch):
    docs, labels = labelled(random.Random(9), 400)
    model = train([t for _, t in docs], [r for _, _, r in labels])
    text = words(random.Random(3), 3000) + " blockhead " + words(random.Random(4), 3000)
    whole = model.decision(text)
    monkeypatch.setattr(toxicity, "BLOCK", 500)
    assert model.decision(text) == pytest.approx(whole)
    assert characters(None).tolist() == [0, 0][: len(characters(None))]


@pytest.mark.parametrize(("name", "label", "least"), [("op8_quality_ftrl", "quality", 0.98), ("op7_toxicity_string_kernel", "toxic", 0.9)])
def test_queries_on_held_out_documents(spark, name, label, least):
    got = queries.QUERIES[name](spark, ROOT)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    marks = spark.read.parquet(f"{ROOT}/labels.parquet").filter(F.col(label).isNotNull())
    held = got.filter("held_out").join(marks, "doc_id").select("score", label).collect()
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > least
