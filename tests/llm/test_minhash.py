import random
from collections import defaultdict

import numpy as np
from samples import frame, odd, words

from tidemark.llm.minhash import drop_near_duplicates, near_duplicates, shingles, signature

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def brute(docs, percent):
    """Least id reachable for each document, over all pairs."""
    sets = [(i, plain_set(t)) for i, t in docs]
    group = list(range(len(sets)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                group[top(x)] = top(y)
    members = defaultdict(list)
    for x, (i, _) in enumerate(sets):
        members[top(x)].append(i)
    return [min((i for i in members[top(x)] if i is not None), default=None) for x in range(len(sets))]


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10**9)}"
    return " ".join(w)


def corpus():
    rng = random.Random(4)
    docs = []
    for _ in range(3):  # groups around the threshold, so that the centre is not linked with all
        base = words(rng, 150)
        docs += [base] + [edited(rng, base, rng.randrange(1, 6)) for _ in range(60)]
        tail = docs[-1]
        docs += [edited(rng, tail, 1) for _ in range(5)] + [base] * 4
    line = words(rng, 12)
    docs += [f"{line} {words(rng, rng.randrange(1, 6))}" for _ in range(80)]  # one common line
    docs += [words(rng, rng.randrange(1, 200)) for _ in range(60)]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_components_agree_with_brute_force(spark):
    docs = corpus()
    for percent in (80, 85):
        want = brute(docs, percent)
        got = {r.doc_id: r for r in near_duplicates(frame(spark, docs), percent).collect()}
        assert len(got) == len(docs)
        for (i, t), least in zip(docs, want, strict=True):
            assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(plain_set(t)), least, i == least)


def test_blocks_of_a_group_are_all_compared(spark, monkeypatch):
    from tidemark.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK_SIZE", 7)
    docs = corpus()
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, docs), 85).collect()}
    assert got == {i: c for (i, _), c in zip(docs, brute(docs, 85), strict=True)}


def test_odd_rows_and_nothing(spark):
    docs = odd()
    got = near_duplicates(frame(spark, docs), 85).collect()
    assert len(got) == len(docs)
    by = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)
    want = sorted(((i, len(plain_set(t)), c) for (i, t), c in zip(docs, brute(docs, 85), strict=True)), key=repr)
    assert by == want
    kept = drop_near_duplicates(frame(spark, docs), 80)
    assert kept.columns == frame(spark, []).columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 9, 10, 11]
    assert near_duplicates(frame(spark, []), 85).count() == 0
    assert drop_near_duplicates(frame(spark, []), 80).count() == 0


def test_signatures_estimate_similarity():
    rng = random.Random(1)
    a = words(rng, 2000)
    x, y = shingles(a), shingles(edited(rng, a, 30))
    both = len(np.intersect1d(x, y))
    real = both / (len(x) + len(y) - both)
    assert abs((signature(x, 512) == signature(y, 512)).mean() - real) < 0.06
