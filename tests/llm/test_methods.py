"""Text operators next to plain versions of their methods."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from samples import frame, odd, words

from tidemark.llm import toxicity
from tidemark.llm.decontaminate import find_leaks
from tidemark.llm.quality import score_quality
from tidemark.llm.substring_dedup import chunk_rows, cuts, repeated_spans
from tidemark.llm.toxicity import DECAY, embed, score_toxicity, squared_hinge, train


def kernel_row(word):
    """Weights of the four-character subsequences of a marked word within six characters, each start by itself."""
    marked = " " + word + " "
    out = Counter()
    for a, b, c, d in combinations(range(len(marked)), 4):
        if d - a <= 5 and " " not in marked[a + 1 : d]:
            out[marked[a] + marked[b] + marked[c] + marked[d]] += DECAY ** (d - a - 3)
    return out


def plain_kernel(one, two):
    a, b = kernel_row(one), kernel_row(two)
    # Each occurrence counts by itself, so equal subsequences of one word add up.
    dot = sum(a[s] * b[s] for s in a)
    return dot


def coded(word):
    return toxicity.characters(word)


@pytest.mark.parametrize("pair", [("kernel", "kernal"), ("insult", "ins-ult"), ("wordy", "sword"), ("ab", "abc"), ("aaaa", "aaaaa"), ("x", "y")])
def test_kernel_is_that_of_gapped_subsequences(pair):
    one, two = (w.replace("-", "") for w in pair)
    values = []
    for a, b in ((one, two), (one, one), (two, two)):
        left, right = (list(toxicity.grams(coded(w))) for w in (a, b))
        sums = []
        for side in (left, right):
            total = Counter()
            for buckets, weights in side:
                for bucket, weight in zip(buckets.tolist(), weights.tolist()):
                    total[bucket] += weight
            sums.append(total)
        values.append(sum(v * sums[1][k] for k, v in sums[0].items()))
    assert np.allclose(values, [plain_kernel(one, two), plain_kernel(one, one), plain_kernel(two, two)])
    buckets, weights = embed(coded(one))
    assert not len(weights) or abs(weights @ weights - 1) < 1e-9


def test_machine_is_at_the_minimum():
    rng = np.random.default_rng(3)
    x = np.column_stack((rng.normal(size=(80, 5)), np.ones(80)))
    y = np.sign(x[:, 0] + 0.3 * rng.normal(size=80))
    cost = rng.uniform(0.5, 2, 80)
    w = squared_hinge(x, y, cost)

    def loss(v):
        ridge = np.array([1, 1, 1, 1, 1, 1e-6])
        return 0.5 * (ridge * v * v).sum() + (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()

    best = loss(w)
    assert all(loss(w + d) >= best for d in rng.normal(scale=1e-3, size=(200, 6)))


def labelled(n=240):
    rng = random.Random(9)
    docs = []
    for k in range(n):
        toxic = k % 4 == 0
        text = words(rng, 30, 300)
        docs.append((k, f"{text} {rng.choice(('blarghface', 'blargh-face', 'blarg hface'))} {words(rng, 5, 300)}" if toxic else text, int(toxic)))
    return docs


@pytest.mark.parametrize("bounds", [(8000, 4000), (None, None), (50, 5)])
def test_machine_on_all_words_or_few(bounds):
    docs = labelled()
    model = train([t for _, t, _ in docs], [y for _, _, y in docs], *bounds)
    assert model.score("w1 w2 blarghface w3") > 0.5 > model.score("w1 w2 w3")


def test_trained_classifiers_score_odd_rows(spark):
    docs = labelled()
    labels = spark.createDataFrame([(i, y, 1 - y) for i, _, y in docs], "doc_id long, toxic int, quality int")
    table = frame(spark, [*((i, t) for i, t, _ in docs), *odd()])
    for rows in (score_toxicity(table, labels, clean_words=None, wrong_words=None), score_quality(table, labels)):
        got = rows.collect()
        assert len(got) == len(docs) + len(odd()) and all(0 <= r.score <= 1 for r in got)
        assert sum(r.doc_id is None for r in got) == 2
        by_text = defaultdict(set)
        texts = {i: t for i, t, _ in docs}
        for r in got:
            if r.doc_id in texts and r.doc_id > 11:
                by_text[texts[r.doc_id]].add(r.score)
        assert all(len(s) == 1 for s in by_text.values())


def long_copies(docs, least):
    """doc_ids that share `least` words side by side with another text."""
    seen = defaultdict(set)
    for i, t in docs:
        w = (t or "").split()
        for a in range(len(w) - least + 1):
            seen[tuple(w[a : a + least])].add(t)
    shared = {k for k, texts in seen.items() if len(texts) > 1}
    return {i for i, t in docs if any(tuple((t or "").split()[a : a + least]) in shared for a in range(len((t or "").split()) - least + 1))}


def test_repeated_passages_agree_with_all_substrings(spark):
    rng = random.Random(21)
    passages = [words(rng, rng.randrange(55, 120), 3000) for _ in range(12)]
    docs = []
    for k in range(150):
        parts = [words(rng, rng.randrange(20, 120), 3000)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), words(rng, rng.randrange(20, 60), 3000)]
        docs.append((k, " ".join(parts)))
    docs += [(200, docs[0][1]), (201, words(rng, 200, 3000)), (202, None), (203, "")]
    got = repeated_spans(frame(spark, docs)).collect()
    found = {r.doc_id for r in got}
    texts = dict(docs)
    copies = {i for i, t in docs if t and sum(t == x for _, x in docs) > 1}
    assert long_copies(docs, 51) | copies == found  # nothing shares from 20 to 50 words here
    for r in got:
        raw = texts[r.doc_id].encode()[r.start : r.start + r.size]
        # `first_id` holds one of its chunks at least; the whole of it is somewhere else too.
        assert any(i != r.doc_id and raw in (t or "").encode() for i, t in docs)


@pytest.mark.parametrize("part", ["a", "He ", "ab cd ef ", "0123456789abcdef", "0123456789abcdefg "])
def test_text_that_repeats_itself_is_cut_and_found_again(spark, part):
    rng = random.Random(len(part))
    body = part * (6000 // len(part))
    sizes = np.diff(cuts(np.frombuffer(body.encode(), "u1")), prepend=0)
    assert sizes.max() <= 2 * 512 + 64
    docs = [(1, f"{words(rng, 40)} {body} {words(rng, 40)}"), (2, f"{words(rng, 53)} {body[len(part) :]}{part * 3} {words(rng, 47)}")]
    rows = chunk_rows(frame(spark, docs), "doc_id", "text").collect()
    inner = {i: Counter((r.hi, r.lo) for r in rows if r.doc_id == i) for i in (1, 2)}
    size = {(r.hi, r.lo): r.size for r in rows}
    shared = sum(size[k] * min(n, inner[2][k]) for k, n in inner[1].items())
    assert shared > 0.75 * len(body)


def test_leaks_by_their_own_thresholds(spark):
    rng = random.Random(6)
    item = words(rng, 40, 9000)
    w = item.split()
    far = f"{words(rng, 20)} {' '.join(w[:14])} {words(rng, 60)} {' '.join(w[26:])} {words(rng, 20)}"
    docs = frame(spark, [(1, far), (2, f"{words(rng, 30)} tiny phrase {words(rng, 9)}"), (3, f"{words(rng, 30)} {' '.join(w[5:15])} {words(rng, 30)}")])
    items = spark.createDataFrame([(1, item), (2, "Tiny phrase"), (3, "tiny")], "item_id long, text string")
    pairs = lambda **how: {(r.doc_id, r.item_id) for r in find_leaks(docs, items, **how).collect()}
    assert pairs() == set()
    assert pairs(shortest=1) == {(2, 2), (2, 3)}
    assert pairs(shift=None) == {(1, 1)}
    assert pairs(least_part=10, least_inside=0.0) == {(1, 1), (3, 1)}
