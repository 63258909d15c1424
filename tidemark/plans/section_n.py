"""M to P: functions, vectors, graphs and layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import layout
from tidemark.plans.registry import query
from tidemark.runtime import scratch_path
from tidemark.sources import files, publish


@query("M7_sql_macro", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice >= 100000 GROUP BY 1")
def _(t):
    t.register("orders")
    return t.spark.sql(
        "SELECT {key}, count(*) AS n FROM orders WHERE o_totalprice >= :least GROUP BY {key}", key=F.col("o_orderpriority"), args={"least": 100000}
    )


DOT = "list_sum(list_transform(list_zip(a, b), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"
CENTRES = """x AS (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
             c AS (SELECT label, list(m ORDER BY i) AS b FROM (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
             e AS (SELECT vec_id, embedding AS a, b FROM embeddings JOIN c USING (label))"""


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def with_centres(t):
    """Each vector beside the mean vector of its label; there are as many means as labels."""
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    sorted_means = F.array_sort(F.collect_list(F.struct("i", "m")))
    centres = means.groupBy("label").agg(F.transform(sorted_means, lambda s: s["m"]).alias("b"))
    return t.embeddings.join(centres, "label").select("vec_id", F.col("embedding").alias("a"), "b")


def norm(c):
    return F.sqrt(dot(c, c))


_len = lambda c: f"sqrt({DOT.replace('(a, b)', f'({c}, {c})')})"


@query("N1_cosine", f"WITH {CENTRES} SELECT vec_id, round({DOT} / ({_len('a')} * {_len('b')}), 5) AS cosine FROM e")
def _(t):
    return with_centres(t).select("vec_id", F.round(F.try_divide(dot("a", "b"), norm("a") * norm("b")), 5).alias("cosine"))


@query(
    "N2_euclidean",
    f"WITH {CENTRES} SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(a, b), lambda z: pow(CAST(z[1] AS DOUBLE) - z[2], 2)))), 5) AS distance FROM e",
)
def _(t):
    squares = F.zip_with("a", "b", lambda x, y: F.pow(x.cast("double") - y, F.lit(2)))
    return with_centres(t).select("vec_id", F.round(F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)), 5).alias("distance"))


@query("N3_dot_product", f"WITH {CENTRES} SELECT vec_id, round({DOT}, 5) AS dot FROM e")
def _(t):
    return with_centres(t).select("vec_id", F.round(dot("a", "b"), 5).alias("dot"))


@query("N4_normalise", f"SELECT vec_id, round({_len('a')}, 5) AS norm, round(CAST(a[1] AS DOUBLE) / {_len('a')}, 5) AS first FROM (SELECT vec_id, embedding AS a FROM embeddings)")
def _(t):
    e = t.embeddings.select("vec_id", F.col("embedding").alias("a"))
    unit = F.transform("a", lambda x: F.try_divide(x.cast("double"), F.col("norm")))
    rows = e.withColumn("norm", norm("a")).withColumn("unit", unit)
    return rows.select("vec_id", F.round("norm", 5).alias("norm"), F.round(F.get("unit", F.lit(0)), 5).alias("first"))


@query(
    "N16_chunking",
    """SELECT doc_id, CAST(s AS INT) AS start, substr(text, s + 1, 512) AS chunk FROM
       (SELECT doc_id, text, unnest(range(0, CASE WHEN length(text) > 0 THEN greatest(length(text) - 128, 1) ELSE 0 END, 384)) AS s FROM documents)""",
)
def _(t):
    """Chunks of 512 characters that overlap by 128. The last one is not whole; none lies inside the one before it."""
    last = F.greatest(F.char_length("text") - 129, F.lit(0))
    starts = F.when(F.char_length("text") > 0, F.sequence(F.lit(0), last, F.lit(384)))
    rows = t.documents.select("doc_id", "text", F.explode(starts).alias("start"))
    return rows.select("doc_id", "start", F.expr("substring(text, start + 1, 512)").alias("chunk"))


EDGES = "(SELECT o_custkey AS a, l_partkey AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey)"


def bought(t):
    return t.orders.join(t.lineitem, F.expr("l_orderkey = o_orderkey")).select(F.col("o_custkey").alias("a"), F.col("l_partkey").alias("b"))


@query("O1_property_graph", f"SELECT 'bought' AS type, a AS src, b AS dst, count(*) AS weight FROM {EDGES} GROUP BY 2, 3 UNION ALL SELECT 'in', n_nationkey, n_regionkey, 1 FROM nation")
def _(t):
    e = bought(t).groupBy("a", "b").agg(F.count("*").alias("weight"))
    e = e.select(F.lit("bought").alias("type"), F.col("a").alias("src"), F.col("b").alias("dst"), "weight")
    inside = t.nation.select(F.lit("in"), F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long"), F.lit(1).cast("long"))
    return e.union(inside)


@query("O2_one_hop", f"SELECT DISTINCT a, b FROM {EDGES}")
def _(t):
    """The parts that each customer bought."""
    return bought(t).distinct()


@query(
    "O3_three_hops",
    "SELECT DISTINCT c_custkey, s_nationkey FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE c_mktsegment = 'BUILDING'",
)
def _(t):
    some = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey")
    hops = some.join(t.orders, F.expr("o_custkey = c_custkey")).join(t.lineitem, F.expr("l_orderkey = o_orderkey"))
    return hops.join(t.supplier, F.expr("s_suppkey = l_suppkey")).select("c_custkey", "s_nationkey").distinct()


@query("O13_degree", f"SELECT a, count(DISTINCT b) AS degree FROM {EDGES} GROUP BY 1")
def _(t):
    return bought(t).distinct().groupBy("a").agg(F.count("b").alias("degree"))


@query("O17_supernodes", f"WITH d AS (SELECT b, count(DISTINCT a) AS n FROM {EDGES} GROUP BY 1) SELECT DISTINCT a, b FROM {EDGES} WHERE b NOT IN (SELECT b FROM d WHERE n > (SELECT quantile_cont(n, 0.95) FROM d))")
def _(t):
    """The edges without those to parts of more neighbours than 95 in a hundred parts have."""
    e = bought(t).distinct()
    degrees = e.groupBy("b").agg(F.count("a").alias("n"))
    most = degrees.agg(F.percentile("n", 0.95).alias("most"))  # one row; degrees are counted by value
    hubs = degrees.join(F.broadcast(most)).filter("n > most").select("b")
    return e.join(hubs, "b", "left_anti").select("a", "b")


@query("O19_triples", "SELECT 'customer/' || c_custkey AS s, 'in' AS p, 'nation/' || c_nationkey AS o FROM customer UNION ALL SELECT 'nation/' || n_nationkey, 'in', 'region/' || n_regionkey FROM nation")
def _(t):
    name = lambda kind, c: F.concat(F.lit(f"{kind}/"), F.col(c).cast("string"))
    people = t.customer.select(name("customer", "c_custkey").alias("s"), F.lit("in").alias("p"), name("nation", "c_nationkey").alias("o"))
    return people.union(t.nation.select(name("nation", "n_nationkey"), F.lit("in"), name("region", "n_regionkey")))


@query("O22_cardinality", "SELECT count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 6)")
def _(t):
    pairs = t.lineitem.select("l_orderkey", "l_suppkey").distinct().groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return pairs.filter("n > 6").agg(F.count("*").alias("n"))


@query("P1_repartition_by_key", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    # One exchange serves the aggregate too.
    return t.orders.select("o_custkey").repartition("o_custkey").groupBy("o_custkey").agg(F.count("*").alias("n"))


BUCKET = "CAST('0x' || substr(md5(CAST(o_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 8"


@query(
    "P3_partition_kinds",
    f"""SELECT 'range' AS kind, CAST(year(o_orderdate) AS VARCHAR) AS part, count(*) AS n FROM orders GROUP BY 2
        UNION ALL SELECT 'list', o_orderstatus, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'hash', CAST({BUCKET} AS VARCHAR), count(*) FROM orders GROUP BY 2""",
)
def _(t):
    """Rows of each partition folder, dealt by a range of dates, a list of values and a hash."""
    hashed = F.conv(F.substring(F.md5(F.col("o_custkey").cast("string")), 1, 8), 16, 10).cast("long") % 8
    kinds = {"range": F.year("o_orderdate"), "list": F.col("o_orderstatus"), "hash": hashed}
    found = []
    for kind, part in kinds.items():
        path = scratch_path(t.spark, kind)
        files.write_partitioned(t.orders.select("o_orderkey", part.cast("string").alias("part")), path, ["part"])
        stored = t.spark.read.schema("o_orderkey long, part string").parquet(path)
        found.append(stored.groupBy("part").agg(F.count("o_orderkey").alias("n")).select(F.lit(kind).alias("kind"), "part", "n"))
    return found[0].union(found[1]).union(found[2])


@query("P4_bucketing", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    table = publish.save_table(t.lineitem.select("l_orderkey"), publish.unique_name("bucketed"), buckets=8, bucket_by=["l_orderkey"])
    return table.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("P5_sort_key", "SELECT o_custkey, o_orderdate::VARCHAR AS day, o_orderkey FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey FROM orders) WHERE o_custkey BETWEEN 10 AND 30")
def _(t):
    """Files sorted by (customer, date): a range of customers reads the row groups that hold it."""
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey")
    path = scratch_path(t.spark, "sort_key")
    layout.write_sorted(rows, path, ["o_custkey", "day"], 8)
    return t.spark.read.schema(rows.schema).parquet(path).filter("o_custkey BETWEEN 10 AND 30")


@query("P6_min_max_skip", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 100 AND 220 OR o_custkey = 7")
def _(t):
    """A range on the sorted key by least and greatest values, and single values of another column by Bloom filters."""
    rows = t.orders.select("o_orderkey", "o_custkey")
    path = scratch_path(t.spark, "skip")
    layout.write_sorted(rows, path, ["o_orderkey"], 8, bloom=["o_custkey"])
    stored = t.spark.read.schema(rows.schema).parquet(path)
    ranged = stored.filter("o_orderkey BETWEEN 100 AND 220")
    return ranged.union(stored.filter("o_custkey = 7 AND NOT o_orderkey BETWEEN 100 AND 220"))
