import hashlib
import random
from collections import Counter, defaultdict

from samples import frame, odd

from tidemark.llm.exact_dedup import DigestIndex
from tidemark.llm.mixing import mix_sources

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_dedup_of_odd_rows(spark, tmp_path):
    docs = odd()
    got = DigestIndex(spark, str(tmp_path / "i"), 4).add(frame(spark, docs), "first").collect()
    groups = defaultdict(list)
    for i, t in docs:
        groups[hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()].append(i)
    assert len(got) == len(docs)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept) == set(groups) and set(kept.values()) == {1}


def test_a_second_batch_meets_the_index_and_a_replay_meets_itself(spark, tmp_path):
    index = DigestIndex(spark, str(tmp_path / "i"), 4)
    first = frame(spark, [(1, "a"), (2, "b")])
    index.add(first, "one").collect()
    again = {r.doc_id: r.kept for r in index.add(first, "one").collect()}
    assert again == {1: True, 2: True}
    second = {r.doc_id: (r.keep_id, r.kept) for r in index.add(frame(spark, [(7, "B"), (8, "c"), (9, "C")]), "two").collect()}
    assert second == {7: (2, False), 8: (9, False), 9: (9, True)}
    assert spark.read.parquet(str(tmp_path / "i")).count() == 3


def test_exact_dedup_of_nothing(spark, tmp_path):
    assert DigestIndex(spark, str(tmp_path / "i"), 4).add(frame(spark, []), "x").count() == 0


def test_mixture_reaches_its_weights_and_is_shuffled(spark):
    rng = random.Random(3)
    docs = [(i, "x" * rng.randrange(50, 150)) for i in range(4000)]
    base = frame(spark, docs[:3000], "big").union(frame(spark, docs[3000:3900], "small")).union(frame(spark, docs[3900:], None))
    got = mix_sources(base, {"big": 0.3, "small": 0.6, "absent": 1.0}, rest=0.1, seed=1, size=400_000).collect()
    chars = Counter()
    for r in got:
        chars[r.source] += len(r.text)
    share = {"big": 0.15, "small": 0.3, None: 0.05}
    for source, part in share.items():
        assert abs(chars[source] / 400_000 - part) < 0.15 * part + 0.01
    order = [r.doc_id for r in got]
    assert order != sorted(order)
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
    keys = {c for c in got[0].asDict()}
    assert "digest" in keys and "a.b" in keys


def test_mixture_of_large_rates_odd_rows_and_nothing(spark):
    one = mix_sources(frame(spark, [(1, "abcd")]), {"s": 1.0}, size=4 * 1000).count()
    assert 850 < one < 1150  # a mean of 1000 is drawn in parts
    many = mix_sources(frame(spark, odd()), {"s": 1.0}, seed=5)
    assert many.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert many.count() > 0
    assert mix_sources(frame(spark, []), {"s": 1.0}).count() == 0
    assert mix_sources(frame(spark, [(1, None), (2, "")]), {"s": 1.0}).count() == 0
    assert mix_sources(frame(spark, [(1, "a")]), {"s": 0.0}, rest=1.0).count() == 0


def test_the_empty_source_may_have_a_weight_of_its_own(spark):
    docs = [(i, "x" * 100) for i in range(900)]
    base = frame(spark, docs[:300], "").union(frame(spark, docs[300:600], "big")).union(frame(spark, docs[600:], None))
    got = mix_sources(base, {"": 0.5, "big": 0.25}, rest=0.25, seed=2, size=90_000).collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
    chars = Counter()
    for r in got:
        chars[r.source] += len(r.text)
    assert abs(chars[""] - 45_000) < 6_000 and abs(chars["big"] - 22_500) < 4_500 and abs(chars[None] - 22_500) < 4_500
