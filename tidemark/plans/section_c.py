"""C: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.ranks import not_in
from tidemark.plans.registry import query
from tidemark.runtime import broadcast_if_small
from tidemark.sources import publish


def people(t):
    """Customers beside their orders, by key."""
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer.select("c_custkey", "c_name")


SAME = "o_custkey = c_custkey"


def joined(t, how: str):
    o, c = people(t)
    return o.join(c, F.expr(SAME), how).select("o_orderkey", "c_custkey", "c_name")


for _id, _how, _sql in (
    ("C1_inner_join", "inner", "JOIN"),
    ("C2_left_join", "left", "LEFT JOIN"),
    ("C30_right_join", "right", "RIGHT JOIN"),
):
    query(_id, f"SELECT o_orderkey, c_custkey, c_name FROM orders {_sql} customer ON {SAME}")(lambda t, how=_how: joined(t, how))


@query(
    "C3_full_join",
    """WITH paid AS (SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS gross FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
       back AS (SELECT CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS refunds FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
       SELECT CAST(coalesce(paid.d, back.d) AS VARCHAR) AS day, coalesce(gross, 0.0) AS gross, coalesce(refunds, 0.0) AS refunds
       FROM paid FULL JOIN back ON paid.d = back.d""",
)
def _(t):
    paid = t.orders.filter("o_orderstatus = 'F'").groupBy(F.to_date("o_orderdate").alias("day"))
    back = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.to_date("l_shipdate").alias("day"))
    paid = paid.agg(F.round(F.sum("o_totalprice"), 2).alias("gross"))
    return paid.join(back.agg(F.round(F.sum("l_extendedprice"), 2).alias("refunds")), "day", "full").fillna(0.0)


@query(
    "C4_left_join_is_null",
    "SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' WHERE o_orderkey IS NULL",
)
def _(t):
    pending = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(pending, F.expr(SAME), "left").filter("o_orderkey IS NULL").select("c_custkey")


@query(
    "C5_left_anti",
    """SELECT user_id, count(*) AS n FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL GROUP BY 1
       HAVING count(*) > (SELECT count(*) / count(DISTINCT user_id) FROM events)) GROUP BY 1""",
)
def _(t):
    per_user = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    mean = t.events.agg((F.count("*") / F.countDistinct("user_id")).alias("mean"))  # one row
    hot = per_user.crossJoin(F.broadcast(mean)).filter("n > mean").select("user_id")
    return t.events.join(hot, "user_id", "left_anti").groupBy("user_id").agg(F.count("*").alias("n"))


@query(
    "C6_semi_join",
    "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 5000)",
)
def _(t):
    rich = t.customer.filter("c_acctbal > 5000")
    return t.orders.join(rich, F.expr(SAME), "left_semi").select("o_orderkey")


@query(
    "C7_not_exists",
    """SELECT DISTINCT user_id FROM events e WHERE event_type = 'click' AND NOT EXISTS
       (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts > e.ts)""",
)
def _(t):
    seen = t.events.filter("event_type = 'click'").select("user_id", "ts").alias("e")
    bought = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("last")).alias("p")
    return seen.join(bought, F.expr("e.user_id = p.user_id AND p.last > e.ts"), "left_anti").select("user_id").distinct()


@query(
    "C8_not_in_null_aware",
    """WITH listed AS (SELECT user_id FROM events WHERE event_type = 'error'),
       holed AS (SELECT user_id FROM listed UNION ALL SELECT NULL)
       SELECT 'clean list' AS list, count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM listed WHERE user_id IS NOT NULL)
       UNION ALL SELECT 'with a NULL', count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM holed)""",
)
def _(t):
    listed = t.events.filter("event_type = 'error'").select("user_id")
    holed = listed.union(t.spark.range(1).select(F.lit(None).cast("long")))
    count = lambda name, values: not_in(t.customer, "c_custkey", values, "user_id").agg(F.lit(name).alias("list"), F.count("*").alias("n"))
    return count("clean list", listed.filter("user_id IS NOT NULL")).union(count("with a NULL", holed))


@query(
    "C9_in_subquery",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)",
)
def _(t):
    large = t.part.filter("p_size > 45").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.join(large, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber")


@query(
    "C10_share_of_total",
    """SELECT p_brand, round(sum(l_extendedprice), 2) AS amount, round(sum(l_extendedprice) / (SELECT sum(l_extendedprice) FROM lineitem), 6) AS share
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def _(t):
    by = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).groupBy("p_brand").agg(F.sum("l_extendedprice").alias("amount"))
    total = t.lineitem.agg(F.sum("l_extendedprice").alias("total"))  # one row
    share = F.round(F.col("amount") / F.col("total"), 6).alias("share")
    return by.crossJoin(F.broadcast(total)).select("p_brand", F.round("amount", 2).alias("amount"), share)


@query(
    "C11_self_join",
    """SELECT a.n_nationkey AS member, b.n_nationkey AS head FROM nation a JOIN
       (SELECT n_regionkey, min(n_nationkey) AS n_nationkey FROM nation GROUP BY 1) b ON a.n_regionkey = b.n_regionkey""",
)
def _(t):
    heads = t.nation.groupBy("n_regionkey").agg(F.min("n_nationkey").alias("head"))
    return t.nation.join(heads, "n_regionkey").select(F.col("n_nationkey").alias("member"), "head")


def star(t):
    """The order items with their dimensions; only the columns that the queries need."""
    facts = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    facts = facts.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.expr("l_orderkey = o_orderkey"))
    facts = facts.join(broadcast_if_small(t.part.select("p_partkey", "p_brand", "p_type")), F.expr("l_partkey = p_partkey"))
    return facts.join(broadcast_if_small(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")), F.expr(SAME))


@query(
    "C12_star_join",
    """SELECT c_mktsegment, p_brand, round(sum(l_extendedprice), 2) AS amount, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def _(t):
    return star(t).groupBy("c_mktsegment", "p_brand").agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.count("*").alias("n"))


@query(
    "C13_snowflake_join",
    """SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def _(t):
    rows = t.customer.join(t.nation, F.expr("c_nationkey = n_nationkey")).join(t.region, F.expr("n_regionkey = r_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


DATES = """(SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(year(d) AS INT) AS y, CAST(month(d) AS INT) AS m FROM
            (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem))"""


def date_dim(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("d")).union(t.lineitem.select(F.to_date("l_shipdate"))).distinct()
    return days.select(F.date_format("d", "yyyyMMdd").cast("int").alias("date_key"), F.year("d").alias("y"), F.month("d").alias("m"))


@query(
    "C14_role_playing_dimension",
    f"""SELECT o.y AS order_year, s.y AS ship_year, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN {DATES} o ON o.date_key = CAST(strftime(o_orderdate, '%Y%m%d') AS INT)
        JOIN {DATES} s ON s.date_key = CAST(strftime(l_shipdate, '%Y%m%d') AS INT) GROUP BY 1, 2""",
)
def _(t):
    key = lambda c: F.date_format(c, "yyyyMMdd").cast("int")
    facts = t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey"))
    facts = facts.select(key("o_orderdate").alias("order_key"), key("l_shipdate").alias("ship_key"))
    o, s = date_dim(t).alias("o"), date_dim(t).alias("s")
    rows = facts.join(o, F.expr("order_key = o.date_key")).join(s, F.expr("ship_key = s.date_key"))
    return rows.groupBy(F.col("o.y").alias("order_year"), F.col("s.y").alias("ship_year")).agg(F.count("*").alias("n"))


@query(
    "C15_junk_dimension",
    """WITH junk AS (SELECT l_returnflag, l_linestatus, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS junk_key
                     FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem))
       SELECT junk_key, count(*) AS n FROM lineitem JOIN junk USING (l_returnflag, l_linestatus) GROUP BY 1""",
)
def _(t):
    from pyspark.sql import Window

    flags = t.lineitem.select("l_returnflag", "l_linestatus").distinct()  # a handful of combinations
    junk = flags.withColumn("junk_key", F.row_number().over(Window.orderBy("l_returnflag", "l_linestatus")))
    rows = t.lineitem.join(broadcast_if_small(junk), ["l_returnflag", "l_linestatus"])
    return rows.groupBy("junk_key").agg(F.count("*").alias("n"))


@query(
    "C16_bridge_table",
    """SELECT p_type, count(DISTINCT l_orderkey) AS orders, round(sum(l_quantity), 2) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
       JOIN part ON l_partkey = p_partkey WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def _(t):
    bridge = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    rows = t.orders.filter("o_orderstatus <> 'P'").join(bridge, F.expr("o_orderkey = l_orderkey")).join(t.part, F.expr("l_partkey = p_partkey"))
    return rows.groupBy("p_type").agg(F.countDistinct("l_orderkey").alias("orders"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


FIRSTS = "(SELECT o_custkey AS k, min(o_orderdate) AS first FROM orders GROUP BY 1)"


@query(
    "C17_interval_join",
    f"""SELECT o_custkey, count(*) AS n FROM orders JOIN {FIRSTS} ON k = o_custkey AND o_orderdate > first
        AND o_orderdate <= first + INTERVAL 30 DAY GROUP BY 1""",
)
def _(t):
    firsts = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderdate").alias("first"))
    within = F.expr("k = o_custkey AND o_orderdate > first AND o_orderdate <= first + INTERVAL 30 DAYS")
    return t.orders.join(firsts, within).groupBy("o_custkey").agg(F.count("*").alias("n"))


@query(
    "C18_retention_left_join",
    """WITH f AS (SELECT user_id, min(CAST(ts AS DATE)) AS d FROM events GROUP BY 1),
       a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)
       SELECT CAST(d AS VARCHAR) AS d, count(DISTINCT f.user_id) AS users, count(DISTINCT a.user_id) AS back FROM f
       LEFT JOIN a ON a.user_id = f.user_id AND a.day BETWEEN f.d + 1 AND f.d + 7 GROUP BY 1""",
)
def _(t):
    f = t.events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("d")).alias("f")
    a = t.events.select("user_id", F.to_date("ts").alias("day")).distinct().alias("a")
    rows = f.join(a, F.expr("a.user_id = f.user_id AND a.day BETWEEN date_add(f.d, 1) AND date_add(f.d, 7)"), "left")
    return rows.groupBy("d").agg(F.countDistinct("f.user_id").alias("users"), F.countDistinct("a.user_id").alias("back"))


VALID = """(SELECT o_custkey AS k, o_orderpriority AS level, CAST(o_orderdate AS DATE) AS effective,
            lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS expiry FROM orders)"""


def levels(t):
    """A versioned dimension: each order sets the customer's level until the next one."""
    from pyspark.sql import Window

    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    day = F.to_date("o_orderdate")
    return t.orders.select(
        F.col("o_custkey").alias("k"),
        F.col("o_orderpriority").alias("level"),
        day.alias("effective"),
        F.date_sub(F.lead(day).over(order), 1).alias("expiry"),
    )


@query(
    "C19_as_of_validity",
    f"""SELECT event_id, level FROM events JOIN {VALID} v ON k = user_id AND effective <= DATE '1997-06-01' + CAST(event_id % 300 AS INT)
        AND (expiry IS NULL OR expiry >= DATE '1997-06-01' + CAST(event_id % 300 AS INT))""",
)
def _(t):
    asked = t.events.select("event_id", "user_id", F.expr("date_add(DATE'1997-06-01', CAST(event_id % 300 AS INT))").alias("d"))
    valid = F.expr("k = user_id AND effective <= d AND (expiry IS NULL OR expiry >= d)")
    return asked.join(levels(t), valid).select("event_id", "level")


@query(
    "C20_aggregate_before_join",
    """SELECT o_orderstatus, round(sum(o_totalprice), 2) AS orders, round(sum(items), 2) AS items FROM orders JOIN
       (SELECT l_orderkey, sum(l_extendedprice) AS items FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey GROUP BY 1""",
)
def _(t):
    items = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("items"))
    rows = t.orders.join(items, F.expr("o_orderkey = l_orderkey")).groupBy("o_orderstatus")
    return rows.agg(F.round(F.sum("o_totalprice"), 2).alias("orders"), F.round(F.sum("items"), 2).alias("items"))


@query(
    "C21_filter_before_join",
    """SELECT c_mktsegment, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def _(t):
    recent = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select("o_custkey")
    return t.customer.join(recent, F.expr(SAME)).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


BY_NATION = """SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""


@query("C22_broadcast_join", BY_NATION)
def _(t):
    small = broadcast_if_small(t.nation.select("n_nationkey", "n_name"))
    return t.customer.join(small, F.expr("c_nationkey = n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("C23_broadcast_hint", BY_NATION)
def _(t):
    t.register("customer", "nation")
    return t.spark.sql(
        "SELECT /*+ BROADCAST(nation) */ n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
    )


PER_ORDER = "SELECT o_orderkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1"

for _id, _hint in (("C24_sort_merge_join", "merge"), ("C25_shuffle_hash_join", "shuffle_hash")):

    def _per_order(t, hint=_hint):
        items = t.lineitem.select("l_orderkey").hint(hint)
        return t.orders.join(items, F.expr("o_orderkey = l_orderkey")).groupBy("o_orderkey").agg(F.count("*").alias("n"))

    query(_id, PER_ORDER)(_per_order)


@query(
    "C26_nested_loop_join",
    """SELECT low, count(*) AS n FROM orders JOIN (VALUES (0e0, 1e5), (1e5, 2.5e5), (2.5e5, 1e12)) b(low, high)
       ON o_totalprice >= low AND o_totalprice < high GROUP BY 1""",
)
def _(t):
    # Three price bands: a side of fixed size is the only kind a join without a key is for.
    bands = t.spark.createDataFrame([(0.0, 100000.0), (100000.0, 250000.0), (250000.0, 1e12)], "low double, high double")
    rows = t.orders.join(F.broadcast(bands), F.expr("o_totalprice >= low AND o_totalprice < high"))
    return rows.groupBy("low").agg(F.count("*").alias("n"))


@query("C27_colocated_join", PER_ORDER)
def _(t):
    names = [publish.unique_name("co_orders"), publish.unique_name("co_items")]
    o = publish.save_table(t.orders.select("o_orderkey"), names[0], buckets=8, bucket_by=["o_orderkey"], sort_by=["o_orderkey"])
    i = publish.save_table(t.lineitem.select("l_orderkey"), names[1], buckets=8, bucket_by=["l_orderkey"], sort_by=["l_orderkey"])
    rows = o.hint("merge").join(i, F.expr("o_orderkey = l_orderkey"))
    return rows.groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query(
    "C28_dimension_key_lookup",
    """SELECT event_id, coalesce(c_custkey, -1) AS customer_key FROM events
       LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = user_id""",
)
def _(t):
    known = t.customer.filter("c_acctbal > 0").select("c_custkey")
    key = F.coalesce("c_custkey", F.lit(-1).cast("long")).alias("customer_key")
    return t.events.join(known, F.expr("c_custkey = user_id"), "left").select("event_id", key)


@query(
    "C29_orphan_check",
    """SELECT 'events.user_id' AS key, count(*) AS orphans FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def _(t):
    known = t.customer.filter("c_acctbal > 0")
    lost = t.events.filter("user_id IS NOT NULL").join(known, F.expr("c_custkey = user_id"), "left_anti")
    return lost.agg(F.lit("events.user_id").alias("key"), F.count("*").alias("orphans"))
