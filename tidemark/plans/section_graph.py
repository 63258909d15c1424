"""O: graph jobs. Nodes are the parts; an edge goes from each line of an order to the next one."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import graph
from tidemark.plans.registry import query

NEXT = "(SELECT l_orderkey, l_partkey AS src, lead(l_partkey) OVER w AS dst, CAST(l_quantity AS BIGINT) AS q, CAST(lead(l_quantity) OVER w AS BIGINT) AS q2, l_linenumber FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))"
EDGES = f"e AS (SELECT src, dst, q AS w FROM {NEXT} WHERE dst IS NOT NULL)"
#: Edges between two large lines of an order: about one in twenty.
HEAVY = f"e AS (SELECT l_orderkey * 8 + l_linenumber AS id, src, dst FROM {NEXT} WHERE dst IS NOT NULL AND q >= 40 AND q2 >= 40)"
SOURCES = "s AS (SELECT p_partkey AS node FROM part WHERE p_size = 50)"


def lines(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")  # the lines of an order
    quantity = F.col("l_quantity").cast("long")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"), quantity.alias("w"), F.lead(quantity).over(w).alias("w2"))
    return rows.filter("dst IS NOT NULL")


def heavy(t):
    return lines(t).filter("w >= 40 AND w2 >= 40").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "src", "dst")


def sources(t):
    return t.part.filter("p_size = 50").select(F.col("p_partkey").alias("node"))


def walk(weight: str) -> str:
    return f"""r(node, distance) USING KEY (node) AS (SELECT node, 0::BIGINT FROM s UNION
      SELECT e.dst, min(r.distance + {weight}) FROM r JOIN e ON e.src = r.node LEFT JOIN recurring.r x ON x.node = e.dst
      WHERE x.distance IS NULL OR r.distance + {weight} < x.distance GROUP BY e.dst)"""


@query("O7_fewest_hops", f"WITH RECURSIVE {EDGES}, {SOURCES}, {walk('1')} SELECT node, distance FROM r")
def _(t):
    """Hops from the nearest part of size 50 to every part that one of them reaches."""
    return graph.shortest_paths(lines(t), sources(t)).select("node", "distance")


@query(
    "O8_weighted_shortest_path",
    f"WITH RECURSIVE {EDGES}, {SOURCES}, {walk('w')} SELECT r.node, distance, (SELECT min(e.src) FROM e JOIN r p ON p.node = e.src WHERE e.dst = r.node AND p.distance + e.w = r.distance AND r.distance > 0) AS previous FROM r",
)
def _(t):
    """Least summed quantity from the nearest part of size 50, with the part before on such a path."""
    return graph.shortest_paths(lines(t), sources(t), F.col("w"))


ROUNDS, DAMPING = 10, 0.85


def rank_sql() -> str:
    """The rounds written out one after the other."""
    steps = ["r0 AS (SELECT p_partkey AS node, 1.0::DOUBLE / (SELECT count(*) FROM part) AS rank FROM part)"]
    for i in range(ROUNDS):
        steps.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT node, {1 - DAMPING!r}::DOUBLE / c.n + {DAMPING}::DOUBLE * coalesce(l.loose, 0) / c.n + {DAMPING}::DOUBLE * coalesce(got, 0) AS rank
              FROM r{i} CROSS JOIN c CROSS JOIN (SELECT sum(rank) AS loose FROM r{i} WHERE node NOT IN (SELECT src FROM d)) l
              LEFT JOIN (SELECT e.dst, sum(rank / degree) AS got FROM r{i} JOIN e ON e.src = node JOIN d ON d.src = node GROUP BY 1) g ON g.dst = node)"""
        )
    return f"WITH {EDGES}, c AS (SELECT count(*)::DOUBLE AS n FROM part), d AS (SELECT src, count(*) AS degree FROM e GROUP BY 1), {', '.join(steps)} SELECT node, round(rank, 9) AS rank FROM r{ROUNDS}"


@query("O10_page_rank", rank_sql())
def _(t):
    nodes = t.part.select(F.col("p_partkey").alias("node"))
    return graph.page_rank(lines(t), nodes, DAMPING, ROUNDS).select("node", F.round("rank", 9).alias("rank"))


#: Orders that ship the same part on the same day belong together; a group is a star around its smallest order.
SHARED = "e AS (SELECT l_orderkey AS src, min(l_orderkey) OVER (PARTITION BY l_partkey, l_shipdate) AS dst FROM lineitem)"


def shared(t):
    """Each order with the smallest that shares a part and a day: as many rows as lines, whatever the size of a group."""
    least = t.lineitem.groupBy("l_partkey", "l_shipdate").agg(F.min("l_orderkey").alias("dst"))
    return t.lineitem.join(least, ["l_partkey", "l_shipdate"]).select(F.col("l_orderkey").alias("src"), "dst")


COMPONENTS = """b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), r(node, component) USING KEY (node) AS (SELECT DISTINCT src, src FROM b UNION
  SELECT b.dst, min(r.component) FROM r JOIN b ON b.src = r.node JOIN recurring.r x ON x.node = b.dst WHERE r.component < x.component GROUP BY b.dst)"""


@query("O11_components", f"WITH RECURSIVE {SHARED}, {COMPONENTS} SELECT node, component FROM r")
def _(t):
    return graph.components(shared(t), t.orders.join(t.lineitem, F.expr("l_orderkey = o_orderkey"), "left_semi").select(F.col("o_orderkey").alias("node")))


@query("O18_shared_attribute", f"WITH {SHARED} SELECT DISTINCT src, dst FROM e WHERE src <> dst")
def _(t):
    """An edge from each order to the first that ships the same part on the same day."""
    return shared(t).filter("src <> dst").distinct()


@query(
    "O20_entity_alignment",
    """WITH RECURSIVE k AS (SELECT c_custkey, 'a' || CAST(CAST(round(c_acctbal) AS BIGINT) AS VARCHAR) || '/' || c_nationkey AS key FROM customer
         UNION ALL SELECT c_custkey, 'b' || c_mktsegment || '/' || CAST(CAST(round(c_acctbal * 10) AS BIGINT) AS VARCHAR) FROM customer),
       e AS (SELECT c_custkey AS src, min(c_custkey) OVER (PARTITION BY key) AS dst FROM k), """
    + COMPONENTS
    + " SELECT node AS c_custkey, component AS entity FROM r",
)
def _(t):
    """One entity for customers that agree in either of two keys, directly or through others."""
    whole = lambda c: F.round(c).cast("long").cast("string")
    keys = F.array(
        F.concat(F.lit("a"), whole(F.col("c_acctbal")), F.lit("/"), F.col("c_nationkey").cast("string")),
        F.concat(F.lit("b"), F.col("c_mktsegment"), F.lit("/"), whole(F.col("c_acctbal") * 10)),
    )
    keyed = t.customer.select("c_custkey", F.explode(keys).alias("key"))
    least = keyed.groupBy("key").agg(F.min("c_custkey").alias("dst"))
    edges = keyed.join(least, "key").select(F.col("c_custkey").alias("src"), "dst")
    return graph.components(edges).select(F.col("node").alias("c_custkey"), F.col("component").alias("entity"))


def label_sql(rounds: int) -> str:
    steps = ["v0 AS (SELECT DISTINCT src AS node, src AS label FROM b)"]
    for i in range(rounds):
        steps.append(
            f"v{i + 1} AS MATERIALIZED (SELECT b.dst AS node, label FROM b JOIN v{i} ON node = src GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY b.dst ORDER BY count(*) DESC, label) = 1)"
        )
    return f"WITH {HEAVY}, b AS (SELECT src, dst FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst), {', '.join(steps)} SELECT node, label FROM v{rounds}"


@query("O12_label_propagation", label_sql(4))
def _(t):
    return graph.spread_labels(heavy(t), 4)


HOPS = """p AS (SELECT node AS origin, node, 0 AS hops, []::BIGINT[] AS edges, [node] AS nodes FROM s UNION ALL
  SELECT origin, e.dst, hops + 1, list_append(edges, e.id), list_append(nodes, e.dst) FROM p JOIN e ON e.src = p.node AND NOT list_contains(edges, e.id) WHERE hops < {})"""


@query("O5_variable_length_path", f"WITH RECURSIVE {HEAVY}, {SOURCES}, {HOPS.format(3)} SELECT origin, node, CAST(hops AS INT) AS hops, array_to_string(edges, ',') AS edges FROM p WHERE hops >= 1")
def _(t):
    """All paths of one to three heavy edges from the parts of size 50."""
    found = graph.paths(heavy(t), sources(t), 1, 3, most_degree=10_000).rows
    return found.select("origin", "node", "hops", F.array_join("edges", ",").alias("edges"))


@query("O6_path_nodes", f"WITH RECURSIVE {HEAVY}, {SOURCES}, {HOPS.format(4)} SELECT array_to_string(nodes, '>') AS nodes, count(*) AS n FROM p WHERE hops >= 1 GROUP BY 1")
def _(t):
    """The nodes of all paths of one to four edges."""
    found = graph.paths(heavy(t), sources(t), 1, 4, most_degree=10_000).rows
    return found.groupBy(F.array_join("nodes", ">").alias("nodes")).agg(F.count("*").alias("n"))


@query(
    "O4_typed_path_filter_first",
    """SELECT DISTINCT n_name, l_partkey FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey JOIN orders ON o_orderkey = l_orderkey
       WHERE s_acctbal > 5000 AND o_orderstatus = 'F' AND l_quantity >= 45""",
)
def _(t):
    """Suppliers of high balance first, then their lines, orders and nation."""
    some = t.supplier.filter("s_acctbal > 5000").join(t.nation, F.expr("n_nationkey = s_nationkey"))
    hops = t.lineitem.filter("l_quantity >= 45").join(some, F.expr("l_suppkey = s_suppkey"))
    return hops.join(t.orders.filter("o_orderstatus = 'F'"), F.expr("o_orderkey = l_orderkey"), "left_semi").select("n_name", "l_partkey").distinct()


PAIRED = "b AS (SELECT src, dst FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst), d AS (SELECT src, count(*) AS n FROM b GROUP BY 1)"


@query(
    "O14_neighbour_similarity",
    f"""WITH {HEAVY}, {PAIRED}, s AS (SELECT x.src AS a, y.src AS b, count(*) AS shared FROM b x JOIN b y ON x.dst = y.dst AND x.src < y.src JOIN d ON d.src = x.dst WHERE d.n <= 1000 GROUP BY 1, 2)
        SELECT a, s.b, shared, round(shared / (p.n + q.n - shared), 6) AS jaccard FROM s JOIN d p ON p.src = a JOIN d q ON q.src = s.b""",
)
def _(t):
    """Pairs of parts with a common neighbour. Neighbours of more than 1000 parts link nothing: they would pair all of them."""
    pairs = graph.both_ways(heavy(t))
    degree = pairs.groupBy("src").agg(F.count("*").alias("n"))
    open_ = pairs.join(degree.filter("n <= 1000").select(F.col("src").alias("dst")), "dst", "left_semi")
    x, y = open_.select(F.col("src").alias("a"), "dst"), open_.select(F.col("src").alias("b"), "dst")
    both = x.join(y, "dst").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    named = both.join(degree.select(F.col("src").alias("a"), F.col("n").alias("na")), "a").join(degree.select(F.col("src").alias("b"), F.col("n").alias("nb")), "b")
    return named.select("a", "b", "shared", F.round(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), 6).alias("jaccard"))


@query(
    "O15_friend_of_friend",
    f"""WITH {HEAVY}, {PAIRED}, c AS (SELECT x.src AS node, y.dst AS other, count(*) AS shared FROM b x JOIN b y ON x.dst = y.src AND x.src <> y.dst JOIN d ON d.src = x.dst WHERE d.n <= 1000 GROUP BY 1, 2)
        SELECT node, other, shared, CAST(row_number() OVER w AS INT) AS rank FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.src = node AND b.dst = other)
        WINDOW w AS (PARTITION BY node ORDER BY shared DESC, other) QUALIFY row_number() OVER w <= 5""",
)
def _(t):
    """The five parts that a part shares most neighbours with and is not linked to."""
    pairs = graph.both_ways(heavy(t))
    hubs = pairs.groupBy(F.col("src").alias("middle")).agg(F.count("*").alias("n")).filter("n <= 1000")
    first = pairs.select(F.col("src").alias("node"), F.col("dst").alias("middle")).join(hubs.select("middle"), "middle", "left_semi")
    far = first.join(pairs.select(F.col("src").alias("middle"), F.col("dst").alias("other")), "middle").filter("node <> other")
    counted = far.groupBy("node", "other").agg(F.count("*").alias("shared"))
    fresh = counted.join(pairs.select(F.col("src").alias("node"), F.col("dst").alias("other")), ["node", "other"], "left_anti")
    order = Window.partitionBy("node").orderBy(F.desc("shared"), "other")
    return fresh.withColumn("rank", F.row_number().over(order)).filter("rank <= 5")


@query(
    "O21_ontology_check",
    """SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NULL THEN 'order' WHEN p_partkey IS NULL THEN 'part' ELSE 'dates' END AS fault
       FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
       WHERE o_orderkey IS NULL OR p_partkey IS NULL OR l_shipdate < o_orderdate + INTERVAL 5 DAY""",
)
def _(t):
    """Lines whose ends are no order or no part, or that leave under five days after their order."""
    rows = t.lineitem.join(t.orders, F.expr("o_orderkey = l_orderkey"), "left").join(t.part.select("p_partkey"), F.expr("p_partkey = l_partkey"), "left")
    fault = F.when(F.col("o_orderkey").isNull(), "order").when(F.col("p_partkey").isNull(), "part").when(F.expr("l_shipdate < o_orderdate + INTERVAL 5 DAYS"), "dates")
    return rows.select("l_orderkey", "l_linenumber", fault.alias("fault")).filter("fault IS NOT NULL")


CLASSES = "k AS (SELECT DISTINCT p_brand AS class, substr(p_brand, 1, 7) AS parent FROM part UNION SELECT DISTINCT substr(p_brand, 1, 7), 'Brand' FROM part)"


@query(
    "O23_class_hierarchy",
    f"""WITH RECURSIVE {CLASSES}, c AS (SELECT class, class AS top FROM k UNION SELECT c.class, k.parent FROM c JOIN k ON k.class = c.top)
        SELECT top AS class, count(*) AS n FROM part JOIN c ON c.class = p_brand GROUP BY 1""",
)
def _(t):
    """Parts of each class and of the classes below it: brands belong to their group, and groups to all brands."""
    brand = t.part.select(F.col("p_brand").alias("class")).distinct()
    group = F.substring("class", 1, 7)
    links = brand.select(F.col("class").alias("src"), group.alias("dst")).union(brand.select(group, F.lit("Brand"))).distinct()
    above = graph.paths(links.withColumn("id", F.concat_ws(">", "src", "dst")), brand.select(F.col("class").alias("node")), 1, 2, most_degree=10).rows
    above = above.select("origin", F.col("node").alias("class")).union(brand.select("class", "class")).distinct()
    sizes = t.part.groupBy(F.col("p_brand").alias("origin")).agg(F.count("*").alias("n"))
    return above.join(sizes, "origin").groupBy("class").agg(F.sum("n").alias("n"))


@query(
    "O25_sync_check",
    f"""WITH {EDGES}, g AS (SELECT src, count(*) AS edges FROM e GROUP BY 1), s AS (SELECT l_partkey AS src, count(*) AS lines FROM lineitem GROUP BY 1)
        SELECT coalesce(g.src, s.src) AS node, coalesce(edges, 0) AS edges, coalesce(lines, 0) AS lines FROM g FULL JOIN s ON g.src = s.src WHERE coalesce(edges, 0) <> coalesce(lines, 0)""",
)
def _(t):
    """Nodes whose number of outgoing edges differs from the number of source rows."""
    edges = lines(t).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("edges"))
    rows = t.lineitem.groupBy(F.col("l_partkey").alias("node")).agg(F.count("*").alias("lines"))
    both = edges.join(rows, "node", "full").select("node", F.coalesce("edges", F.lit(0)).alias("edges"), F.coalesce("lines", F.lit(0)).alias("lines"))
    return both.filter("edges <> lines")


@query("O16_graph_embedding")
def _(t):
    """Vectors of parts from random walks over heavy edges."""
    walks = graph.random_walks(heavy(t), walks=2, steps=4, seed=11)
    return graph.node_vectors(walks).select("node", F.size("vector").alias("n"), F.transform("vector", lambda x: F.round(x, 4)).alias("vector"))
