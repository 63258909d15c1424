"""N: search over vectors and words. Queries are the vectors whose id is divisible by 20, against all rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import keywords, search
from tidemark.plans.registry import query

K = 10
#: Share of the inverted lists that an approximate search looks into.
PROBED = 0.7


def pool(t, width: int | None = None) -> tuple[DataFrame, DataFrame]:
    rows = search.vectors(t.embeddings, "vec_id", "embedding", width)
    return rows, rows.filter("id % 20 = 0")


def shown(found: DataFrame) -> DataFrame:
    return found.select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


VALID = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
PAIRS = f"""e AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND {VALID}),
  pairs AS (SELECT q.id AS query_id, e.id, q.label AS query_label, e.label, list_distance(q.v, e.v) AS distance, q.v AS qv, e.v AS v
            FROM e q JOIN e ON q.id % 20 = 0 AND q.id <> e.id)"""
NEAR = f"{PAIRS}, near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs QUALIFY rank <= {K})"
SHOWN = "SELECT query_id, id, round(distance, 6) AS distance, CAST(rank AS INT) AS rank FROM near"


@query("N5_exact_top_k", f"WITH {NEAR} {SHOWN}")
def _(t):
    return shown(search.exact_nearest(*pool(t), K))


@query("N6_ivf_search", f"WITH {NEAR} {SHOWN}")
def _(t):
    """Inverted lists; after the first probes every list goes on being looked into that can hold a nearer vector."""
    rows, queries = pool(t)
    return shown(search.InvertedLists.build(rows).nearest(queries, K))


def recalls(rows, queries, truth, n_lists, shares) -> list[DataFrame]:
    lists = search.InvertedLists.build(rows, n_lists)
    n, out = max(1, len(lists.sizes)), []
    for share in shares:
        n_probes = max(1, math.ceil(share * n))
        found = lists.nearest(queries, K, n_probes, exact=False)
        out.append(search.recall(found, truth).select(F.lit(n).alias("n_lists"), F.lit(n_probes).alias("n_probes"), F.round("recall", 4).alias("recall")))
    return out


def union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for one in frames[1:]:
        whole = whole.union(one)
    return whole


@query("N9_recall_by_probes")
def _(t):
    """Recall of the approximate search by number of probes; PROBED is its default."""
    rows, queries = pool(t)
    return union(recalls(rows, queries, search.exact_nearest(rows, queries, K), None, (0.1, 0.3, PROBED, 1.0)))


@query("N11_parameter_grid")
def _(t):
    """Recall for pairs of (lists, probes); `cheapest` marks the fewest probed lists' share with a recall above 0.95."""
    rows, queries = pool(t)
    truth = search.exact_nearest(rows, queries, K)
    grid = union([r for n_lists in (8, 16) for r in recalls(rows, queries, truth, n_lists, (0.25, 0.75, 1.0))])
    cost = F.struct((F.col("n_probes") / F.col("n_lists")).alias("share"), F.col("n_lists").alias("n"))
    least = grid.filter("recall > 0.95").agg(F.min(cost).alias("least"))
    return grid.join(F.broadcast(least)).withColumn("cheapest", F.coalesce(cost == F.col("least"), F.lit(False))).drop("least")


@query("N7_product_codes")
def _(t):
    rows, queries = pool(t)
    return shown(search.ProductCodes.build(rows).nearest(queries, K))


@query(
    "N15_re_rank",
    f"""WITH {PAIRS}, coarse AS (SELECT *, sqrt(list_sum(list_transform(list_zip(qv, v), lambda z: pow(floor(8 * z[1]) - floor(8 * z[2]), 2)))) AS far FROM pairs),
        candidates AS (SELECT * FROM coarse QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY far, id) <= 50),
        near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM candidates QUALIFY rank <= {K}) {SHOWN}""",
)
def _(t):
    """Fifty candidates by coarse components, then the exact distance."""
    rows, queries = pool(t)
    coarse = lambda df: df.select("id", F.transform("v", lambda x: F.floor(x * 8).cast("double")).alias("v"))
    return shown(search.re_ranked(search.exact_nearest(coarse(rows), coarse(queries), 50), rows, queries, K))


@query(
    "N10_precision_mrr",
    f"""WITH {NEAR}, r AS (SELECT query_id, avg((label = query_label)::INT) AS p, coalesce(max(1.0 / rank) FILTER (label = query_label), 0) AS rr FROM near GROUP BY 1)
        SELECT count(*) AS n, round(avg(p), 6) AS precision_at_10, round(avg(rr), 6) AS mrr FROM r""",
)
def _(t):
    """A neighbour with the query's label counts as relevant."""
    found = search.exact_nearest(*pool(t), K)
    labels = t.embeddings.select(F.col("vec_id").alias("id"), "label")
    judged = found.join(labels, "id").join(labels.select(F.col("id").alias("query_id"), F.col("label").alias("want")), "query_id")
    same = F.col("label") == F.col("want")
    each = judged.groupBy("query_id").agg(F.avg(same.cast("int")).alias("p"), F.coalesce(F.max(F.when(same, 1 / F.col("rank"))), F.lit(0.0)).alias("rr"))
    return each.agg(F.count("*").alias("n"), F.round(F.avg("p"), 6).alias("precision_at_10"), F.round(F.avg("rr"), 6).alias("mrr"))


@query("N12_metadata_pre_filter", f"WITH {PAIRS}, near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs WHERE label = 3 QUALIFY rank <= {K}) {SHOWN}")
def _(t):
    """Rows of one label only, filtered before they are ranked, so no place is lost to others."""
    some = search.vectors(t.embeddings.filter("label = 3"), "vec_id", "embedding")
    return shown(search.exact_nearest(some, pool(t)[1], K))


@query("N17_version_split", f"WITH {PAIRS}, near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM pairs WHERE label % 2 = query_label % 2 QUALIFY rank <= {K}) {SHOWN}")
def _(t):
    """Versions (the parity of the label stands for one) are searched apart: no query meets a row of another version."""
    found = []
    for version in (0, 1):
        rows = search.vectors(t.embeddings.filter(F.col("label") % 2 == version), "vec_id", "embedding")
        found.append(search.exact_nearest(rows, rows.filter("id % 20 = 0"), K))
    return shown(union(found))


@query(
    "N18_model_drift",
    f"""WITH {NEAR}, later AS (SELECT query_id, id FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY list_distance(qv[1:32], v[1:32]), id) <= {K})
        SELECT query_id, count(l.id) AS shared FROM near n LEFT JOIN later l USING (query_id, id) GROUP BY 1""",
)
def _(t):
    """How many of the top ten two models share; the second model's vectors are the first halves of the first's."""
    rows, queries = pool(t)
    half = lambda df: df.select("id", F.slice("v", 1, 32).alias("v"))
    later = search.exact_nearest(half(rows), half(queries), K).select("query_id", "id", F.lit(1).alias("hit"))
    both = search.exact_nearest(rows, queries, K).join(later, ["query_id", "id"], "left")
    return both.groupBy("query_id").agg(F.count("hit").alias("shared"))


@query("N19_anomaly_score", f"WITH {PAIRS} SELECT query_id AS vec_id, round(min(distance), 6) AS score, min(distance) > 1.0 AS anomaly FROM pairs GROUP BY 1")
def _(t):
    """Distance to the nearest other vector, and whether it passes the threshold."""
    rows, queries = pool(t)
    found = search.InvertedLists.build(rows).nearest(queries, 1)
    return found.select(F.col("query_id").alias("vec_id"), F.round("distance", 6).alias("score"), (F.col("distance") > 1.0).alias("anomaly"))


@query(
    "N20_context_assembly",
    f"""WITH {NEAR}, c AS (SELECT query_id, rank, '[' || rank || '] ' || coalesce(source, '') || ': ' || substr(coalesce(text, ''), 1, 512) AS part
        FROM near JOIN documents ON doc_id = id WHERE rank <= 5) SELECT query_id, string_agg(part, chr(10) ORDER BY rank) AS context, count(*) AS n FROM c GROUP BY 1""",
)
def _(t):
    """The first chunks of the five nearest, in order and with their source. The document of a vector has its id."""
    near = search.exact_nearest(*pool(t), 5)
    docs = t.documents.select(F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("source"), F.substring(F.coalesce("text", F.lit("")), 1, 512).alias("chunk"))
    part = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col("source"), F.lit(": "), F.col("chunk")).alias("part")
    parts = F.array_sort(F.collect_list(F.struct("rank", "part")))  # five at most
    return near.join(docs, "id").select("query_id", "rank", part).groupBy("query_id").agg(F.concat_ws("\n", parts["part"]).alias("context"), F.count("*").alias("n"))


WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
INDEX = f"""d AS (SELECT doc_id AS id, {WORDS} AS w FROM documents WHERE doc_id IS NOT NULL),
  totals AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean_words FROM d),
  postings AS (SELECT term, id, any_value(n_words) AS n_words, count(*) AS tf FROM (SELECT id, len(w) AS n_words, unnest(w) AS term FROM d) GROUP BY 1, 2),
  terms AS (SELECT term, count(*) AS df FROM postings GROUP BY 1),
  asked AS (SELECT item_id AS query_id, unnest(list_distinct({WORDS})) AS term FROM benchmark),
  matched AS (SELECT * FROM asked JOIN terms USING (term) JOIN postings USING (term)),
  bm25 AS (SELECT query_id, id, CAST(sum(CAST(round(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
             / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_words / mean_words)) * 1000000) AS BIGINT)) AS BIGINT) / 1000000 AS score FROM matched, totals GROUP BY 1, 2),
  one AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM bm25 QUALIFY rank <= {K}),
  two AS (SELECT query_id, id, count(*) AS score, row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, id) AS rank FROM matched GROUP BY 1, 2 QUALIFY rank <= {K})"""


@query("N13_bm25", f"WITH {INDEX} SELECT query_id, id, score, CAST(rank AS INT) AS rank FROM one")
def _(t):
    return keywords.InvertedIndex.build(t.documents, "doc_id", "text").bm25(t.benchmark, "item_id", "text", K)


@query(
    "N14_rank_fusion",
    f"""WITH {INDEX}, f AS (SELECT query_id, id, one.rank AS rank_1, two.rank AS rank_2,
          round(coalesce(1::DOUBLE / (60 + one.rank), 0) + coalesce(1::DOUBLE / (60 + two.rank), 0), 9) AS score FROM one FULL JOIN two USING (query_id, id))
        SELECT query_id, id, CAST(rank_1 AS INT) AS rank_1, CAST(rank_2 AS INT) AS rank_2, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank
        FROM f QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= {K}""",
)
def _(t):
    """BM25 and the number of different query words that a document holds, fused by reciprocal ranks."""
    index = keywords.InvertedIndex.build(t.documents, "doc_id", "text")
    return keywords.fused(index.bm25(t.benchmark, "item_id", "text", K), index.coverage(t.benchmark, "item_id", "text", K), K)

TABLES, BITS = 8, 6
SIGNS = f"""b AS (SELECT id, v, list_transform(range(1, {TABLES * BITS + 1}), lambda m: list_sum(list_transform(range(0, len(v)), lambda i: v[i + 1] * (1 - 2 * (bit_count(i & m) % 2)))) > 0) AS bits FROM e),
  k AS (SELECT id, v, t, array_to_string(list_transform(bits[t * {BITS} + 1 : t * {BITS} + {BITS}], lambda x: x::INT), '') AS key FROM b, (SELECT unnest(range({TABLES})) AS t)),
  candidates AS (SELECT DISTINCT q.id AS query_id, r.id, list_distance(q.v, r.v) AS distance FROM k q JOIN k r USING (t, key) WHERE q.id % 20 = 0 AND q.id <> r.id),
  near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM candidates QUALIFY rank <= {K})"""


@query("N8_lsh_search", f"WITH {PAIRS}, {SIGNS} {SHOWN}")
def _(t):
    """Candidates that share a bucket in one of the hash tables, then the exact distance."""
    rows, queries = pool(t)
    return shown(search.lsh_nearest(rows, queries, TABLES, BITS, K))


@query(
    "O24_graph_expansion",
    f"""WITH {NEAR}, s AS (SELECT query_id, rank, doc_id, source FROM near JOIN documents ON doc_id = id WHERE rank <= 3),
        h AS (SELECT query_id, rank, doc_id, n_name, r_name FROM s JOIN nation ON source = 'src' || n_nationkey JOIN region ON r_regionkey = n_regionkey)
        SELECT query_id, string_agg(doc_id || ' from ' || trim(n_name) || ' in ' || trim(r_name), '; ' ORDER BY rank) AS context, count(*) AS n FROM h GROUP BY 1""",
)
def _(t):
    """From the nearest documents along the path source, nation, region; the paths of a query make its context."""
    seeds = search.exact_nearest(*pool(t), 3).select("query_id", "rank", F.col("id").alias("doc_id"))
    docs = seeds.join(t.documents.select("doc_id", "source"), "doc_id")
    hops = docs.join(t.nation, F.expr("source = concat('src', n_nationkey)")).join(t.region, F.expr("r_regionkey = n_regionkey"))
    path = F.concat(F.col("doc_id").cast("string"), F.lit(" from "), F.trim("n_name"), F.lit(" in "), F.trim("r_name")).alias("path")
    paths = F.array_sort(F.collect_list(F.struct("rank", "path")))  # three at most
    return hops.select("query_id", "rank", path).groupBy("query_id").agg(F.concat_ws("; ", paths["path"]).alias("context"), F.count("*").alias("n"))
