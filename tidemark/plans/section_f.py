"""F and G: sort, limit, paging, set operations and recursion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.changes import merge_by_key
from tidemark.operators import graph
from tidemark.plans.registry import query
from tidemark.sources import files


@query(
    "F1_multi_key_sort",
    "SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey",
)
def _(t):
    return t.supplier.select("s_nationkey", "s_acctbal", "s_suppkey").orderBy("s_nationkey", F.desc("s_acctbal"), "s_suppkey")


@query("F2_limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def _(t):
    """A page; the limit is the feature."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(40).limit(20)


@query(
    "F3_keyset_page",
    """SELECT o_orderkey FROM orders WHERE (o_orderdate, o_orderkey) < (TIMESTAMP '1998-01-01', 0) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 25""",
)
def _(t):
    before = "o_orderdate < TIMESTAMP_NTZ '1998-01-01' OR (o_orderdate = TIMESTAMP_NTZ '1998-01-01' AND o_orderkey < 0)"
    return t.orders.filter(before).orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(25).select("o_orderkey")


@query("F4_global_top_n", "SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return spent.orderBy(F.desc("spent"), "o_custkey").limit(10)


@query("F5_slices", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    # Work in stable slices of the key; together they are the whole.
    parts = None
    for i in range(4):
        part = t.lineitem.filter(files.slice_of(F.col("l_orderkey"), 4) == i).groupBy("l_returnflag").agg(F.count("*").alias("n"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("l_returnflag").agg(F.sum("n").alias("n"))


@query(
    "G1_union_aligned",
    """SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier""",
)
def _(t):
    c = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return c.unionByName(s, allowMissingColumns=True)


@query(
    "G2_reconciliation",
    """SELECT 'orders' AS side, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders
       UNION ALL SELECT 'items', count(DISTINCT l_orderkey), round(sum(l_extendedprice), 2) FROM lineitem""",
)
def _(t):
    a = t.orders.agg(F.lit("orders").alias("side"), F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"))
    b = t.lineitem.agg(F.lit("items").alias("side"), F.countDistinct("l_orderkey").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("amount"))
    return a.unionByName(b)


@query("G3_union", "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT p_partkey FROM part WHERE p_size > 45")
def _(t):
    a = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("k"))
    return a.unionByName(t.part.filter("p_size > 45").select(F.col("p_partkey").alias("k")))


@query(
    "G4_snapshot_difference",
    """SELECT 'gone' AS side, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'
       UNION ALL SELECT 'new', o_orderkey, 'F' FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t):
    old = t.orders.select("o_orderkey", "o_orderstatus")
    new = old.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")))
    side = lambda name, rows: rows.select(F.lit(name).alias("side"), "*")
    return side("gone", old.exceptAll(new)).unionByName(side("new", new.exceptAll(old)))


PARENTS = "parents AS (SELECT p_partkey AS id, p_partkey // 3 AS parent FROM part)"


@query(
    "G5_recursive_hierarchy",
    f"""WITH RECURSIVE {PARENTS}, tree AS (SELECT id, 0 AS depth FROM parents WHERE parent = id OR parent NOT IN (SELECT id FROM parents)
        UNION ALL SELECT p.id, depth + 1 FROM parents p JOIN tree ON p.parent = tree.id AND p.parent <> p.id) SELECT id, depth FROM tree""",
)
def _(t):
    """Depth below the parts whose parent is no other part: level by level, each level a join of stored tables, until one is empty."""
    links = t.part.select(F.expr("p_partkey div 3").alias("src"), F.col("p_partkey").alias("dst"))
    roots = links.join(t.part, F.expr("src = p_partkey AND src <> dst"), "left_anti").select(F.col("dst").alias("node"))
    return graph.shortest_paths(links, roots).select(F.col("node").alias("id"), F.col("distance").cast("int").alias("depth"))


@query(
    "G6_cte_chain",
    """WITH paid AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'), spent AS (SELECT o_custkey, sum(o_totalprice) AS s FROM paid GROUP BY 1),
       banded AS (SELECT *, CASE WHEN s > 1000000 THEN 'gold' WHEN s > 300000 THEN 'silver' ELSE 'base' END AS band FROM spent)
       SELECT band, count(*) AS customers, round(sum(s), 2) AS spent FROM banded GROUP BY 1""",
)
def _(t):
    paid = t.orders.filter("o_orderstatus <> 'P'")
    spent = paid.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    banded = spent.withColumn("band", F.when(F.col("s") > 1000000, "gold").when(F.col("s") > 300000, "silver").otherwise("base"))
    return banded.groupBy("band").agg(F.count("*").alias("customers"), F.round(F.sum("s"), 2).alias("spent"))


@query("G7_derived_table", "SELECT n, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("customers"))


@query("G8_correlated_scalar", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer")
def _(t):
    t.register("customer", "orders")
    return t.spark.sql("SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer")


@query("G9_uncorrelated_scalar", "SELECT event_type, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY 1")
def _(t):
    t.register("events")
    return t.spark.sql("SELECT event_type, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY event_type")


@query(
    "G10_merge_into",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS status FROM orders
       WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')
       UNION ALL SELECT -o_orderkey, 'N' FROM orders WHERE o_orderpriority = '2-HIGH'""",
)
def _(t):
    # Updates, deletes and inserts in one source.
    target = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    o, priority = t.orders, F.col("o_orderpriority")
    source = o.select(
        F.when(priority == "2-HIGH", -F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey"),
        F.when(priority == "2-HIGH", "N").when(priority == "1-URGENT", "F").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when((priority == "5-LOW") & (F.col("o_orderstatus") == "F"), True).alias("gone"),
    )
    return merge_by_key(target, source, ["o_orderkey"], "gone")
