"""B: projection, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query

DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"


@query("B1_projection_alias", "SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS amount FROM orders")
def _(t):
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("amount")
    )


@query(
    "B2_computed_column",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem",
)
def _(t):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", charge.alias("charge"))


@query(
    "B3_case",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'low' END AS level,
              CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'pending' END AS state FROM orders""",
)
def _(t):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    level = F.when(price >= 300000, "high").when(price >= 100000, "middle").otherwise("low")
    state = F.when(status == "F", "done").when(status == "O", "open").otherwise("pending")
    return t.orders.select("o_orderkey", level.alias("level"), state.alias("state"))


@query(
    "B4_comparisons",
    "SELECT p_partkey, p_size FROM part WHERE p_size > 10 AND p_size <= 40 AND p_size <> 25 AND p_retailprice > 500",
)
def _(t):
    size = F.col("p_size")
    return t.part.filter((size > 10) & (size <= 40) & (size != 25) & (F.col("p_retailprice") > 500)).select("p_partkey", "p_size")


@query(
    "B5_and_or",
    "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT') AND o_totalprice > 200000",
)
def _(t):
    either = (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT")
    return t.orders.filter(either & (F.col("o_totalprice") > 200000)).select("o_orderkey")


FIRST_PURCHASE = "(SELECT user_id, min(ts) AS first_ts FROM events WHERE event_type = 'purchase' GROUP BY 1)"


def sparse(t):
    """Customers with the time of their first purchase, NULL for those without."""
    first = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    return t.customer.join(first, F.col("c_custkey") == F.col("user_id"), "left")


@query(
    "B6_null_tests",
    f"""SELECT c_mktsegment, CAST(sum(CASE WHEN first_ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS never,
               CAST(sum(CASE WHEN first_ts IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS bought
        FROM customer LEFT JOIN {FIRST_PURCHASE} f ON c_custkey = user_id GROUP BY 1""",
)
def _(t):
    first = F.col("first_ts")
    return sparse(t).groupBy("c_mktsegment").agg(
        F.count_if(first.isNull()).alias("never"), F.count_if(first.isNotNull()).alias("bought")
    )


@query(
    "B7_coalesce",
    f"""SELECT c_custkey, coalesce(CAST(first_ts AS VARCHAR), 'never') AS first_seen
        FROM customer LEFT JOIN {FIRST_PURCHASE} f ON c_custkey = user_id""",
)
def _(t):
    return sparse(t).select("c_custkey", F.coalesce(F.col("first_ts").cast("string"), F.lit("never")).alias("first_seen"))


@query("B8_like", "SELECT p_partkey, p_name, p_type FROM part WHERE p_brand LIKE 'Brand#1%' OR p_type ILIKE '%steel%'")
def _(t):
    return t.part.filter(F.col("p_brand").like("Brand#1%") | F.col("p_type").ilike("%steel%")).select("p_partkey", "p_name", "p_type")


@query("B9_between", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def _(t):
    return t.orders.filter(F.col("o_totalprice").between(100000, 200000)).select("o_orderkey", "o_totalprice")


@query(
    "B10_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')",
)
def _(t):
    kept = F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")
    return t.orders.filter(kept).select("o_orderkey", "o_orderpriority")


@query(
    "B11_half_open_range",
    "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01'",
)
def _(t):
    # On the raw column, so that the scan can skip by statistics.
    return t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-03-01' AND o_orderdate < TIMESTAMP_NTZ '1997-04-01'").select("o_orderkey")


@query(
    "B12_casts",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS amount, CAST(o_totalprice AS BIGINT) AS whole,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS rank, TRY_CAST(o_orderpriority AS INT) AS dirty FROM orders""",
)
def _(t):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey",
        price.cast("decimal(10,2)").cast("string").alias("amount"),
        F.rint(price).cast("long").alias("whole"),
        F.substring(priority, 1, 1).try_cast("int").alias("rank"),
        priority.try_cast("int").alias("dirty"),
    )


@query(
    "B13_code_unification",
    """SELECT CASE WHEN event_type IN ('click', 'view', 'page_view') THEN 'V' WHEN event_type IN ('purchase', 'buy') THEN 'P' ELSE 'U' END AS code,
              count(*) AS n FROM events GROUP BY 1""",
)
def _(t):
    kind = F.col("event_type")
    code = F.when(kind.isin("click", "view", "page_view"), "V").when(kind.isin("purchase", "buy"), "P").otherwise("U")
    return t.events.groupBy(code.alias("code")).agg(F.count("*").alias("n"))


@query(
    "B14_boolean_normalisation",
    """SELECT l_returnflag, lower(l_linestatus) IN ('f', '1', 'true', 'yes') AS finished, count(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    finished = F.lower("l_linestatus").isin("f", "1", "true", "yes").alias("finished")
    return t.lineitem.groupBy("l_returnflag", finished).agg(F.count("*").alias("n"))


@query("B15_negative_clamp", "SELECT c_custkey, greatest(c_acctbal, 0) AS balance FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("balance"))


@query(
    "B16_null_fill",
    """SELECT c_custkey, coalesce(n, 0) AS n, coalesce(amount, 0.0) AS amount, coalesce(status, '-') AS status FROM customer LEFT JOIN
       (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS amount, max(o_orderstatus) AS status FROM orders GROUP BY 1)
       ON c_custkey = o_custkey""",
)
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"), F.max("o_orderstatus").alias("status")
    )
    joined = t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "n", "amount", "status").fillna(0, ["n", "amount"]).fillna("-", ["status"])


def drawn(label):
    """A number from 0 to 99 by a hash of the key, so that the sample is the same however the table is laid out."""
    key = F.concat_ws(":", F.lit(label), "l_orderkey", "l_linenumber")
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100


DRAWN = "CAST('0x' || substr(md5('{}:' || l_orderkey || ':' || l_linenumber), 1, 8) AS BIGINT) % 100"


@query("B17_sample", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {DRAWN.format('sample')} < 5")
def _(t):
    """One row in twenty for development; the sampling is the feature."""
    return t.lineitem.filter(drawn("sample") < 5).select("l_orderkey", "l_linenumber")


@query("B18_table_sample", f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {DRAWN.format('table')} < 10")
def _(t):
    """A table sample clause of ten percent, repeatable under its label, in SQL."""
    t.register("lineitem")
    draw = "CAST(conv(substring(md5(concat_ws(':', 'table', l_orderkey, l_linenumber)), 1, 8), 16, 10) AS LONG) % 100"
    return t.spark.sql(f"SELECT l_orderkey, l_linenumber FROM lineitem WHERE {draw} < :percent", args={"percent": 10})


@query(
    "B19_random_split",
    """SELECT CASE WHEN CAST('0x' || substr(md5('split:' || o_orderkey), 1, 8) AS BIGINT) % 10 < 8 THEN 'train' ELSE 'test' END AS part,
              count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
)
def _(t):
    # By a hash of the key, so that the split is the same however the table is laid out.
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit("split:"), F.col("o_orderkey").cast("string"))), 1, 8), 16, 10).cast("long") % 10
    part = F.when(bucket < 8, "train").otherwise("test").alias("part")
    return t.orders.groupBy(part).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
