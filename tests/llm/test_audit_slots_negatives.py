import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from samples import frame, odd, words

from tidemark.llm import filter_audit, hard_negatives, queries, slots
from tidemark.llm.filter_audit import TermMatrix, audit_filters, failures
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.slots import SlotMap, shard_documents

ROOT = "/root/testdata/sf0.001"


# Filter audit


def plain_fails(docs):
    """The failing filters of each (doc_id, text), one document at a time."""
    smallest = {}
    for i, t in docs:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    out = []
    for i, t in docs:
        t = t or ""
        w = t.encode().split()
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > smallest.get(t, i),
        }
        out.append("".join(f for f in "ABCDE" if fails[f]))
    return out


def plain_audit(parts, fails, good, toxic):
    out = {}
    shapley = Counter()
    for order in map("".join, permutations("ABCDE")):
        for step, f in enumerate(order):
            rows = defaultdict(lambda: [0] * 6)
            for p, own, g, x in zip(parts, fails, good, toxic):
                r, before = rows[p], set(own) & set(order[:step])
                r[0] += f not in own and not before
                r[1] += f in own and not before
                r[2] += f in own and bool(before)
                r[3] += own == f
                r[4] += g and f in own and not before
                r[5] += x and f in own and not before
            for p, r in rows.items():
                out[p, order, step + 1] = r
                shapley[p, f] += r[1]
    return {k: (*r, shapley[k[0], k[1][k[2] - 1]]) for k, r in out.items()}


def audit_case():
    rng = random.Random(5)
    long = words(rng, 300, 5000)
    return [
        (1, long, "a"), (2, long, "a"), (2, long, "a"), (3, long.upper(), "b"), (4, "x y " * 200, "b"), (5, "", None), (6, None, ""), (None, long, "a"),
        (7, f"{long} 50%", "a"), (8, "\x1c   ", "c"), (9, "é" * 40 + " A", "c"), (10, words(rng, 4000, 9000), "c"), (None, None, None),
        (11, "\n\n  lead and trail \t\x0b", "b"), (12, "# x " * 150, "b"), (12, "# x " * 150, "b"), (13, "# x " * 150, "b"),
    ]


@pytest.mark.parametrize("size", [filter_audit.SHARD_BYTES, 64])
def test_audit_agrees_with_a_plain_count(spark, monkeypatch, size):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", size)
    case = audit_case()
    docs = spark.createDataFrame([(*c, "clash", 0) for c in case], "doc_id long, text string, source string, words string, fails int")
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (2, None, None), (4, 0, 1), (13, 1, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit_filters(docs, labels).collect()}
    ids = [c[0] for c in case]
    fails = plain_fails([c[:2] for c in case])
    want = plain_audit([c[2] or "" for c in case], fails, [i in (1, 2, 13) for i in ids], [i in (2, 4, 13) for i in ids])
    assert got == want
    assert audit_filters(docs.limit(0), labels).count() == 0
    assert audit_filters(docs, labels.limit(0)).count() == 120 * 5 * 4


def test_matrix_has_each_word_once_in_the_dictionary_and_gives_back_the_counts(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 500)
    texts = [(k, t) for k, (_, t) in enumerate(odd())]
    matrix = TermMatrix.build(frame(spark, texts))
    names = {r.term: r.word for r in matrix.dictionary().collect()}
    assert len(set(names.values())) == len(names) == matrix.dictionary().count()
    got = {}
    for s in matrix.shards().collect():
        for k, i in enumerate(s.doc_id):
            a, b = s.begins[k], s.begins[k + 1]
            got[i] = Counter(dict(zip((names[t] for t in s.terms[a:b]), s.counts[a:b])))
    assert got == {i: Counter(w.decode() for w in (t or "").encode().split()) for i, t in texts}


def test_a_text_longer_than_a_shard_is_read_whole(spark):
    text = "word other " * 500_000
    row = failures(frame(spark, [(1, text), (2, "a")])).filter("doc_id = 1").first()
    assert (row.n_words, row.n_distinct, row.fails) == (1_000_000, 2, 2)


# Slots


def test_shards_are_equal_in_bytes_and_places_have_no_gaps(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = queries.QUERIES["op12_slot_shards"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    load, places = Counter(), defaultdict(list)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert set(load) == set(range(24))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 24


def test_odd_documents_are_placed(spark):
    rows = [*odd(), *[(None, None)] * 3, *[(5, "same")] * 4]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, slot int, `virtual_slot` string")
    got = shard_documents(docs, 3).collect()
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").encode()) + 8) for i, t in rows)
    for shard in range(3):
        places = sorted(r.slot for r in got if r.shard == shard)
        assert places == list(range(len(places)))
    assert shard_documents(docs.limit(0), 3).count() == 0


def test_repeated_rows_of_one_slot_are_dealt_over_all(spark, monkeypatch):
    monkeypatch.setattr(slots, "HOT_ROWS", 100)
    docs = spark.createDataFrame([(7, "again")] * 6000 + [(k, "other") for k in range(3000)], "doc_id long, text string")
    load = Counter(r.shard for r in shard_documents(docs, 8).collect())
    assert max(load.values()) - min(load.values()) < 30


def test_maps_are_edited_by_few_whole_slots_and_stored_by_version(spark, tmp_path):
    rng = random.Random(3)
    sizes = [rng.randrange(500, 1500) for _ in range(slots.SLOTS)]
    first = SlotMap.first(24).rebalanced(sizes)
    grown = first.grown(sizes)
    moved = [s for s in range(slots.SLOTS) if grown.shards[s] != first.shards[s]]
    assert {grown.shards[s] for s in moved} == {24} and grown.n_shards == 25
    part = sum(sizes) / 25
    assert 0.98 * part < sum(sizes[s] for s in moved) <= part
    later = [s * 3 if k % 24 == 5 else s for k, s in enumerate(sizes)]  # one shard's slots have grown
    edited = first.rebalanced(later)
    load = np.bincount(edited.shards, later)
    assert load.max() - load.min() < 0.001 * load.mean()
    assert sum(a != b for a, b in zip(first.shards, edited.shards)) < 0.15 * slots.SLOTS
    for m in (first, grown):
        m.store(spark, str(tmp_path))
    assert SlotMap.load(spark, str(tmp_path), first.version) == first and SlotMap.load(spark, str(tmp_path), grown.version) == grown
    assert SlotMap.first(3).rebalanced([0] * slots.SLOTS).shards == SlotMap.first(3).shards
    alone = SlotMap.first(3).rebalanced([10**9] + [0] * (slots.SLOTS - 1))  # one document larger than all else
    assert np.bincount(alone.shards, [10**9] + [0] * (slots.SLOTS - 1)).max() == 10**9


# Hard negatives


def plain_negatives(rows, every, n_pos, n_neg, low, high, scale=256):
    once = {}
    for i, label, v in rows:
        ok = i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
        if ok:
            q = [int(np.floor(scale * float(np.float32(x)))) for x in v]
            once[i] = min(once.get(i, (label, q)), (label, q))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (la, va) in once.items():
        if a % every:
            continue
        scored = sorted((-dot(va, v), i, label) for i, (label, v) in once.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:n_pos]:
            fit = [(n, -t) for t, n, label in scored if label != la and low * -s <= 100 * -t <= high * -s][:n_neg]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(fit)]
    return sorted(out)


def vector_case(rng, n, dims, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[rng.randrange(6)]
        size = rng.choice([0.01, 0.5, 1, 1, 1, 3])
        rows.append((i, rng.randrange(4), [size * (x + rng.gauss(0, spread)) / dims**0.5 for x in c]))
    return rows


@pytest.mark.parametrize("dims, spread, bucket", [(4, 0.2, 40), (16, 1.0, 150), (1, 0.5, 1000)])
def test_negatives_agree_with_all_pairs(spark, monkeypatch, dims, spread, bucket):
    monkeypatch.setattr(hard_negatives, "STRETCH_ROWS", 25)
    rng = random.Random(dims)
    rows = vector_case(rng, 400, dims, spread)
    rows += [
        (400, 1, rows[0][2]), (401, 2, rows[0][2]), (402, 2, [0.0] * dims), (410, 1, [0.0] * dims), (405, None, rows[1][2]), (406, 1, None),
        (407, 1, [float("nan")] * dims), (408, 1, [None] * dims), (409, 1, [float("inf")] * dims), (None, 1, rows[2][2]), (403, 1, []), rows[5], rows[10],
    ]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, rank string, id int")
    got = mine_hard_negatives(table, anchor_every=10, bucket_rows=bucket, block_anchors=15)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 10, 5, 10, 30, 90)
    assert mine_hard_negatives(table.limit(0)).count() == 0


def test_large_components_keep_exact_scores(spark):
    rng = random.Random(8)
    rows = [(i, i % 3, [rng.uniform(-200_000, 200_000) for _ in range(8)]) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = mine_hard_negatives(table, anchor_every=10)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 10, 5, 10, 30, 90)


def test_coordinate_ranges_exclude_rows_and_lose_none():
    rng = np.random.default_rng(4)
    vectors = np.floor(256 * rng.normal(size=(3000, 8)) * np.array([3, 2, 1, 1, 0.2, 0.2, 0.1, 0.1])).astype(float)
    sizes = np.sqrt((vectors**2).sum(1))
    stretch = hard_negatives.Stretch(np.arange(3000), np.zeros(3000), vectors, sizes)
    kept = 0
    for q in vectors[:50]:
        anchor = hard_negatives.Anchor(q)
        scores = vectors @ q
        threshold = np.sort(scores)[-20]
        found = stretch.candidates(anchor.unit, anchor.focus, stretch.least_cosine(anchor.size, threshold))
        found = np.arange(3000) if found is None else found
        assert set(np.flatnonzero(scores >= threshold)) <= set(found)
        kept += len(found)
    assert kept < 0.8 * 50 * 3000
