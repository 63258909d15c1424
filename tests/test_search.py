import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import keywords, search
from tidemark.plans import catalog

ROOT = "/root/testdata/sf0.01"


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def plain(rows, queries, k):
    """(query_id, id) in order, by comparing each query with each row."""
    out = []
    for q, v in queries:
        near = sorted((math.dist(v, x), i) for i, x in rows if i != q)[:k]
        out += [(q, i, rank) for rank, (_, i) in enumerate(near, 1)]
    return sorted(out)


def case(n=600, dims=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((rng.gauss(0, 1), float(rng.randrange(2)))) for _ in range(dims)]) for i in range(n)]
    same = rows[7][1]
    return [*rows, *[(1000 + k, same) for k in range(200)]]  # a fourth of the rows is one vector


def frames(spark, rows):
    odd = [(None, [1.0] * 6), (2001, None), (2002, [None] * 6), (2003, [float("nan")] * 6), (2004, [])]
    whole = search.vectors(table(spark, [(i, v, 0) for i, v in [*rows, *odd]]), "vec_id", "embedding")
    return whole, whole.filter("id % 20 = 0")


def found(df):
    return sorted((r.query_id, r.id, r.rank) for r in df.collect())


@pytest.mark.parametrize("blocks", [(8192, 1024), (97, 11)])
def test_exact_search_is_that_of_all_pairs(spark, monkeypatch, blocks):
    rows = case()
    whole, queries = frames(spark, rows)
    known = [(i, [float(x) for x in v]) for i, v in ((r.id, r.v) for r in whole.collect())]
    want = plain(known, [(i, v) for i, v in known if i % 20 == 0], 5)
    assert found(search.exact_nearest(whole, queries, 5, *blocks)) == want
    monkeypatch.setattr(search, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(search, "BLOCK_QUERIES", blocks[1])
    lists = search.InvertedLists.build(whole, 12)
    assert sum(n for n, _, _ in lists.sizes.values()) == len(known)
    assert found(lists.nearest(queries, 5, n_probes=2)) == want
    assert found(lists.nearest(queries, 2000, n_probes=1)) == plain(known, [(i, v) for i, v in known if i % 20 == 0], 2000)


def test_search_of_nothing(spark):
    none, queries = frames(spark, [])
    none, queries = none.filter("id < 0"), queries.filter("id < 0")
    assert search.exact_nearest(none, queries, 5).count() == 0
    assert search.InvertedLists.build(none).nearest(queries, 5).count() == 0
    assert search.ProductCodes.build(none).nearest(queries, 5).count() == 0


def test_approximate_searches_reach_their_recall(spark):
    got = {r.n_probes: r.recall for r in catalog.queries()["N9_recall_by_probes"](spark, ROOT).collect()}
    by_probes = [got[n] for n in sorted(got)]
    assert by_probes == sorted(by_probes) and by_probes[-1] == 1.0 and by_probes[-2] >= 0.9
    exact = {(r.query_id, r.id) for r in catalog.queries()["N5_exact_top_k"](spark, ROOT).collect()}
    codes = {(r.query_id, r.id) for r in catalog.queries()["N7_product_codes"](spark, ROOT).collect()}
    assert len(exact & codes) >= 0.9 * len(exact)
    grid = catalog.queries()["N11_parameter_grid"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r.cheapest for r in grid) == 1 and all(r.recall > 0.95 for r in grid if r.cheapest)
    assert all(r.n_probes / r.n_lists >= c.n_probes / c.n_lists for c in grid if c.cheapest for r in grid if r.recall > 0.95)


def test_codes_are_one_byte_a_part_and_rank_again_by_the_vectors(spark):
    whole, queries = frames(spark, case())
    codes = search.ProductCodes.build(whole, n_parts=3, n_words=16)
    assert {len(r.code) for r in codes.codes.collect()} == {3} and codes.codes.count() == whole.count()
    all_candidates = found(codes.nearest(queries, 5, n_candidates=10_000))
    assert all_candidates == found(search.exact_nearest(whole, queries, 5))


def docs_case():
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(("the", "The", f"w{rng.randrange(60)}")) for _ in range(rng.randrange(0, 40)))) for i in range(300)]
    return [*docs, (300, None), (301, ""), (None, "w1 w2"), (302, "w1, W1. w2!")]


@pytest.mark.parametrize("part", [keywords.PART_POSTINGS, 20])
def test_bm25_agrees_with_a_plain_sum(spark, monkeypatch, part):
    monkeypatch.setattr(keywords, "PART_POSTINGS", part)
    docs = spark.createDataFrame(docs_case(), "doc_id long, text string")
    queries = spark.createDataFrame([(1, "the w1 w1"), (2, "w5 unknown"), (3, None), (4, "w7 w8 w9 the")], "item_id long, text string")
    index = keywords.InvertedIndex.build(docs, "doc_id", "text")
    assert index.postings.filter("part > 0").count() > 0 or part > 20
    words = {i: [w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()] for i, t in docs_case() if i is not None}
    n, mean = len(words), sum(map(len, words.values())) / len(words)
    want = []
    for q, text in ((1, "the w1"), (2, "w5 unknown"), (4, "w7 w8 w9 the")):
        scores = {}
        for term in text.split():
            df = sum(term in w for w in words.values())
            for i, w in words.items():
                if tf := w.count(term):
                    part_score = math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
                    scores[i] = scores.get(i, 0) + round(part_score * 1e6)
        best = sorted((-s, i) for i, s in scores.items())[:10]
        want += [(q, i, -s / 1e6, rank) for rank, (s, i) in enumerate(best, 1)]
    got = sorted((r.query_id, r.id, r.score, r.rank) for r in index.bm25(queries, "item_id", "text", 10).collect())
    assert got == sorted(want)


def test_fusion_adds_reciprocal_ranks(spark):
    one = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id long, id long, rank int")
    two = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id long, id long, rank int")
    got = [(r.id, round(r.score, 6)) for r in keywords.fused(one, two, 5).orderBy("rank").collect()]
    assert got == [(11, round(1 / 62 + 1 / 61, 6)), (10, round(1 / 61, 6)), (12, round(1 / 62, 6))]


def test_largest_products_look_into_few_boxes_and_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(k + 5, [float(round(x, 2)) for x in rng.normal(size=6)]) for k in range(1200)] + [(3, [0.25] * 6), (9000, [0.25] * 6), (9001, [0.0] * 6)]
    asked = [(k, [float(round(x, 1)) for x in rng.normal(size=6)]) for k in range(40)] + [(90, [0.0] * 6), (91, None)]
    kind = "id long, v array<double>"
    frames = [search.vectors(spark.createDataFrame(r, kind), "id", "v") for r in (rows, asked)]
    want = {}
    for name, q in asked:
        if q:
            exact = sorted(((float(np.dot(q, v)), i) for i, v in rows), key=lambda p: (-round(p[0], 9), p[1]))
            want[name] = [i for _, i in exact[:4]]
    for sizes in ({}, {"block_rows": 200, "block_queries": 15}):
        got = {}
        for r in search.largest_products(*frames, 4, **sizes).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.id)
        assert got == want
    few = search.largest_products(frames[0].filter("id < 7"), frames[1], 4)
    assert few.count() == 3 * len(want) and search.largest_products(frames[0].limit(0), frames[1], 4).count() == 0


def test_recommendations_need_no_product_of_all_pairs(spark):
    plan = catalog.queries()["J37_als_recommender"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_candidates_of_buckets_are_ranked_in_blocks_and_none_is_a_row(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(400)] + [(398, [1.0] * 8), (None, [1.0] * 8)]
    frame = search.vectors(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v")
    keys = lambda v: [tuple(sum(x * (1 - 2 * (bin(i & m).count("1") % 2)) for i, x in enumerate(v)) > 0 for m in range(3 * t + 1, 3 * t + 4)) for t in range(2)]
    known = [(i, v, keys(v)) for i, v in rows if i is not None]
    want = []
    for i, v, a in known:
        if i % 7 == 0:
            near = sorted((round(math.dist(v, w), 9), j) for j, w, b in known if i != j and any(x == y for x, y in zip(a, b)))
            want += [(i, j) for _, j in near[:5]]
    for sizes in ({}, {"block_rows": 90, "block_queries": 20}):
        found = search.lsh_nearest(frame, frame.filter("id % 7 = 0"), 2, 3, 5, **sizes)
        assert [(r.query_id, r.id) for r in found.orderBy("query_id", "rank").collect()] == want
    plan = catalog.queries()["N8_lsh_search"](spark, ROOT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_an_index_reads_its_documents_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (1, "a"), (2, ""), (3, None), (None, "a b"), (4, "B c")], "id long, text string")
    docs.write.parquet(str(tmp_path / "d"))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(text):
        seen.add(1)
        return text

    index = keywords.InvertedIndex.build(spark.read.parquet(str(tmp_path / "d")).withColumn("text", noted("text")), "id", "text")
    assert seen.value <= 6 and (index.n_docs, index.mean_words) == (5, 6 / 5)
    got = sorted((r.term, r.id, r.tf, r.n_words, r.part) for r in index.postings.collect())
    assert got == [("a", 1, 1, 1, 0), ("a", 1, 2, 3, 0), ("b", 1, 1, 3, 0), ("b", 4, 1, 2, 0), ("c", 4, 1, 2, 0)]
