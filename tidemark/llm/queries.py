"""The registered queries of the text operators, and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import AGREE, LEAST_INSIDE, MASKS, SHORTEST, SPAN, find_leaks
from tidemark.llm.exact_dedup import DigestIndex
from tidemark.llm.filter_audit import audit_filters
from tidemark.llm.hard_negatives import mine_hard_negatives
from tidemark.llm.html_text import extract_text
from tidemark.llm.license_texts import KNOWN, SPELLINGS
from tidemark.llm.licenses import COPYRIGHT_LINE, PARAGRAPH_END, SCOPES, SENTENCE_END, find_licenses
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import LARGEST_MEAN, STEPS, mix_sources
from tidemark.llm.quality import score_quality
from tidemark.llm.slots import shard_documents
from tidemark.llm.substring_dedup import repeated_spans
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.toxicity import score_toxicity
from tidemark.runtime import scratch_path

QUERIES: dict = {}
CHECK_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn

    return register


#: Share of the mixture's characters by source; the sources not named share REST.
WEIGHTS = {"src0": 0.10, "src1": 0.10, "src2": 0.08, "src3": 0.08, "src4": 0.04}
REST, MIX_SEED = 0.60, 17

_shares = ", ".join(f"('{s}', CAST({w!r} AS DOUBLE) / {sum(WEIGHTS.values()) + REST!r})" for s, w in WEIGHTS.items())
_named = ", ".join(f"'{s}'" for s in WEIGHTS)
_draw = f"CAST('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':' || j), 1, 13) AS BIGINT)"


@query(
    "op1_mix_sources",
    f"""
    WITH RECURSIVE d AS (
      SELECT *, CASE WHEN source IN ({_named}) THEN source ELSE '' END AS grp FROM documents
    ), shares(grp, share) AS (
      VALUES {_shares}, ('', CAST({REST!r} AS DOUBLE) / {sum(WEIGHTS.values()) + REST!r})
    ), had AS (
      SELECT grp, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM d GROUP BY grp
    ), rated AS (
      SELECT grp, CASE WHEN chars > 0 THEN share * CAST((SELECT sum(chars) FROM had) AS DOUBLE) / chars ELSE 0 END AS rate
      FROM had JOIN shares USING (grp)
    ), rates AS (
      SELECT grp, CAST(greatest(ceil(rate / {LARGEST_MEAN}), 1) AS INT) AS parts, rate / parts AS mean FROM rated
    ), dist AS (
      SELECT grp, parts, mean, 0 AS n, exp(-mean) AS p, exp(-mean) AS s FROM rates
      UNION ALL
      SELECT grp, parts, mean, n + 1, p * mean / CAST(n + 1 AS DOUBLE), s + p * mean / CAST(n + 1 AS DOUBLE)
      FROM dist WHERE n < {STEPS - 1}
    ), sums AS (SELECT grp, any_value(parts) AS parts, list(s ORDER BY n) AS s FROM dist GROUP BY grp
    ), drawn AS (
      SELECT d.* EXCLUDE (grp), CAST(list_sum(list_transform(range(parts), lambda j:
             len(list_filter(s, lambda x: x <= {_draw} / 4503599627370496.0)))) AS INT) AS n
      FROM d JOIN sums USING (grp)
    )
    SELECT doc_id, text, lang, source, n_chars, CAST(c.copy AS INT) AS copy,
           md5('{MIX_SEED}+:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) || ':' || c.copy) AS mix_key
    FROM drawn, LATERAL (SELECT unnest(range(1, n + 1)) AS copy) c
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents replicated to WEIGHTS and shuffled."""
    return mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, REST, MIX_SEED)


_words = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_masked = ", ".join("[" + ", ".join(f"w[a + {p + 1}]" for p in m) + "]" for m in MASKS)


@query(
    "op2_benchmark_leaks",
    f"""
    WITH d AS (SELECT doc_id, {_words} AS w FROM documents),
    i AS (SELECT item_id, {_words} AS w FROM benchmark WHERE len({_words}) >= {SHORTEST}),
    dw AS (SELECT doc_id, w, unnest(range(len(w) - {SPAN - 1})) AS a FROM d WHERE len(w) >= {SPAN}),
    iw AS (SELECT item_id, w, unnest(range(len(w) - {SPAN - 1})) AS a FROM i WHERE len(w) >= {SPAN}),
    ds AS (SELECT doc_id, a, unnest(range({len(MASKS)})) AS m, unnest([{_masked}]) AS seed FROM dw),
    xs AS (SELECT item_id, a, unnest(range({len(MASKS)})) AS m, unnest([{_masked}]) AS seed FROM iw),
    long AS (SELECT DISTINCT doc_id, item_id, ds.a - xs.a AS "at" FROM ds JOIN xs USING (m, seed)),
    short AS (SELECT DISTINCT d.doc_id, i.item_id, s.a AS "at"
              FROM i, d, LATERAL (SELECT unnest(range(len(d.w) - len(i.w) + 1)) AS a) s
              WHERE len(i.w) < {SPAN} AND len(d.w) >= len(i.w) AND d.w[s.a + 1 : s.a + len(i.w)] = i.w),
    placed AS (SELECT doc_id, item_id, "at", i.w AS iw, d.w AS dw, greatest(0, -"at") AS first,
                      least(len(i.w), len(d.w) - "at") AS last
               FROM (SELECT * FROM long UNION SELECT * FROM short) JOIN i USING (item_id) JOIN d USING (doc_id)),
    judged AS (SELECT doc_id, item_id, "at", last - first AS n_words, len(iw) AS n_item,
                      len(list_filter(range(first, last), lambda k: iw[k + 1] = dw[k + "at" + 1])) AS n_equal FROM placed),
    good AS (SELECT * FROM judged WHERE (n_item < {SPAN} AND n_equal = n_item)
             OR (n_item >= {SPAN} AND n_words >= {SPAN} AND n_words >= {LEAST_INSIDE} * n_item AND n_equal >= {AGREE} * n_words))
    SELECT doc_id, item_id, CAST("at" AS INT) AS "at", CAST(n_words AS INT) AS n_words, CAST(n_equal AS INT) AS n_equal FROM good
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, "at") = 1
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _canonical(text: str) -> str:
    out = f"lower(regexp_replace({text}, '{COPYRIGHT_LINE}', '', 'g'))"
    for found, read in SPELLINGS:
        out = f"replace({out}, '{found}', '{read}')"
    return f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "op5_license_scan",
    f"""
    WITH known(license, text) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in KNOWN)}),
    digests AS (SELECT DISTINCT license, sha256({_canonical("text")}) AS digest FROM known),
    d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (
      SELECT doc_id, 0 AS scope, text AS passage FROM d
      UNION ALL SELECT doc_id, 1, unnest(regexp_split_to_array(text, '{PARAGRAPH_END}')) FROM d
      UNION ALL SELECT doc_id, 2, unnest(string_split(text, chr(10))) FROM d
      UNION ALL SELECT doc_id, 3, unnest(string_split(regexp_replace(text, '{SENTENCE_END}', '\1' || chr(10), 'g'), chr(10))) FROM d
    ), found AS (
      SELECT doc_id, license, min(scope) AS scope FROM parts JOIN digests ON digest = sha256({_canonical("passage")}) GROUP BY 1, 2
    )
    SELECT doc_id, license, [{", ".join(map(_quoted, SCOPES))}][scope + 1] AS scope FROM found
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The known licences of every document."""
    return find_licenses(table(spark, sf_dir, "documents"))


@query("op6_minhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate group at similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


_lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op9_exact_dedup",
    f"""
    WITH d AS (SELECT doc_id, sha256({_lower}) AS text_sha256, row_number() OVER () AS r FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           coalesce(doc_id = max(doc_id) OVER w AND row_number() OVER
                    (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1, false) AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for it, by an index that begins empty."""
    index = DigestIndex(spark, scratch_path(spark, "digest_index"))
    return index.add(table(spark, sf_dir, "documents"), batch="documents")


def token_set(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents encoded with the word tokenizer into files in the shared folder, read back from them."""
    import public_tokenizers

    folder = scratch_path(spark, "tokens")
    write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return read_token_files(spark, folder)


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, with a checksum of its ids."""
    return token_set(spark, table(spark, sf_dir, "documents"))


@query("op8_quality_ftrl")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_toxicity_string_kernel")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_html_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))


@query("op3_repeated_passages")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every long passage of a document that another document holds too."""
    return repeated_spans(table(spark, sf_dir, "documents")).drop("row")


_orders = "SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5"


@query(
    "op11_filter_audit",
    f"""
    WITH d AS (
      SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
    ), f AS (
      SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
             + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
             + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS fails FROM d
    ), k AS (
      SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
    ), c AS (
      SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad FROM f LEFT JOIN k USING (doc_id) GROUP BY 1, 2
    ), l(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
    o AS ({_orders}),
    s AS (
      SELECT filter_order, step, filter_order[step] AS filter, 1 << (instr('ABCDE', filter_order[step]) - 1) AS bit,
             coalesce(list_sum(list_transform(string_split(filter_order[1:step - 1], ''), lambda f: CASE WHEN f = '' THEN 0 ELSE 1 << (instr('ABCDE', f) - 1) END)), 0) AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)
    ), r AS (
      SELECT part, filter_order, step, filter,
             coalesce(sum(n) FILTER (fails & bit = 0 AND fails & earlier = 0), 0) AS kept,
             coalesce(sum(n) FILTER (fails & bit > 0 AND fails & earlier = 0), 0) AS removed,
             coalesce(sum(n) FILTER (fails & bit > 0 AND fails & earlier > 0), 0) AS redundant,
             coalesce(sum(n) FILTER (fails = bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (fails & bit > 0 AND fails & earlier = 0), 0) AS good_lost,
             coalesce(sum(bad) FILTER (fails & bit > 0 AND fails & earlier = 0), 0) AS toxic_lost
      FROM c, s GROUP BY 1, 2, 3, 4
    )
    SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
           CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What filters A to E remove in each order, by source."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


N_SHARDS = 24


@query("op12_slot_shards")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard of N_SHARDS, which are nearly equal in bytes."""
    placed = shard_documents(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


@query(
    "op13_hard_negatives",
    """
    WITH e AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), p AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) QUALIFY row_number() OVER w <= 10
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", shifted))
