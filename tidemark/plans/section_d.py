"""D: aggregation, skew handling and roll-ups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.skew import salted_aggregate, skewed_keys, split_aggregate
from tidemark.operators.ranks import quantiles
from tidemark.plans.registry import query


def total(c: str, name: str):
    return F.round(F.sum(c), 2).alias(name)


def exact(c):
    """A sum of cents without rounding error, so that what is divided by it is the same in any order of rows."""
    return F.sum(c.cast("decimal(18,2)") if not isinstance(c, str) else F.col(c).cast("decimal(18,2)")).cast("double")


def mean(c):
    """A mean to four places. What lies half way goes up in every engine, whatever its doubles are."""
    return F.round(exact(c) / F.count(c) + 1e-9, 4)


@query(
    "D1_counts",
    """SELECT event_type, count(*) AS n, count(props) AS with_props, count(DISTINCT user_id) AS users FROM events GROUP BY 1""",
)
def _(t):
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("props").alias("with_props"), F.countDistinct("user_id").alias("users")
    )


@query("D2_sum_coalesce", "SELECT user_id, round(sum(coalesce(value, 0)), 2) AS total FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.round(F.sum(F.coalesce("value", F.lit(0.0))), 2).alias("total"))


@query("D3_min_max", "SELECT o_custkey, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query(
    "D4_avg",
    "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY 1",
)
def _(t):
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg((exact("o_totalprice") / F.count("*")).alias("mean"))


@query(
    "D5_group_by_expression",
    "SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, count(*) AS n FROM orders GROUP BY 1",
)
def _(t):
    return t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))


@query(
    "D6_many_keys",
    """SELECT l_returnflag, l_linestatus, l_suppkey, CAST(year(l_shipdate) AS INT) AS y, count(*) AS n, round(sum(l_extendedprice), 2) AS amount
       FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def _(t):
    by = t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_suppkey", F.year("l_shipdate").alias("y"))
    return by.agg(F.count("*").alias("n"), total("l_extendedprice", "amount"))


@query("D7_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 12")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 12")


@query(
    "D8_filter_aggregate",
    """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
       FROM events GROUP BY 1""",
)
def _(t):
    t.register("events")
    return t.spark.sql(
        """SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS clicks,
                  count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY user_id"""
    )


@query(
    "D9_case_in_aggregate",
    """SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS returned,
              count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS orders FROM lineitem GROUP BY 1""",
)
def _(t):
    back = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.sum(F.when(back, F.col("l_extendedprice")).otherwise(0)), 2).alias("returned"),
        F.countDistinct(F.when(back, F.col("l_orderkey"))).alias("orders"),
    )


@query("D10_median", "SELECT l_returnflag, round(median(l_quantity), 4) AS median FROM lineitem GROUP BY 1")
def _(t):
    return quantiles(t.lineitem, "l_returnflag", "l_quantity", 0.5, "median").withColumn("median", F.round("median", 4))


@query("D11_quantile", "SELECT event_type, round(quantile_cont(value, 0.95), 4) AS p95 FROM events GROUP BY 1")
def _(t):
    return quantiles(t.events, "event_type", "value", 0.95, "p95").withColumn("p95", F.round("p95", 4))


@query("D12_stddev", "SELECT o_orderstatus, round(stddev_samp(o_totalprice), 3) AS sd FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_orderstatus").agg(F.round(F.stddev_samp("o_totalprice"), 3).alias("sd"))


@query("D13_distinct_rows", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_partkey").distinct()


@query(
    "D14_collect",
    """SELECT n_regionkey, list_aggregate(list(n_name ORDER BY n_name), 'string_agg', '|') AS names,
              count(DISTINCT n_name) AS different FROM nation GROUP BY 1""",
)
def _(t):
    return t.nation.groupBy("n_regionkey").agg(
        F.concat_ws("|", F.sort_array(F.collect_list("n_name"))).alias("names"),
        F.size(F.collect_set("n_name")).cast("long").alias("different"),
    )


@query(
    "D15_multi_level",
    "SELECT round(avg(mean), 4) AS mean_of_means, max(n) AS most FROM (SELECT user_id, avg(value) AS mean, count(*) AS n FROM events GROUP BY 1)",
)
def _(t):
    users = t.events.groupBy("user_id").agg(F.avg("value").alias("mean"), F.count("*").alias("n"))
    return users.agg(F.round(F.avg("mean"), 4).alias("mean_of_means"), F.max("n").alias("most"))


@query(
    "D16_aggregate_over_aggregate",
    "SELECT event_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM events GROUP BY 1",
)
def _(t):
    kinds = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(1))  # over the few groups
    return kinds.select("event_type", "n", F.round(F.col("n") / F.sum("n").over(everything), 6).alias("share"))


@query(
    "D17_guarded_ratio",
    """SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) / nullif(count(CASE WHEN event_type = 'purchase' THEN 1 END), 0) AS per_purchase
       FROM events GROUP BY 1""",
)
def _(t):
    bought = F.col("event_type") == "purchase"
    ratio = F.try_divide(exact(F.when(bought, F.col("value"))), F.count(F.when(bought, 1)))
    return t.events.groupBy("user_id").agg(ratio.alias("per_purchase"))


BY_USER = "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1"


@query("D19_two_stage_aggregation", BY_USER)
def _(t):
    return salted_aggregate(t.events, ["user_id"], "event_id", {"n": F.count("*"), "total": F.sum("value")}, 8).withColumn("total", F.round("total", 2))


@query("D20_salted_string_key", "SELECT CAST(user_id AS VARCHAR) AS user_key, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    # The key is salted as text and the salt stripped again; a salt column (D19) keeps the key's type.
    salted = t.events.withColumn("k", F.concat_ws("_", F.col("user_id").cast("string"), F.pmod(F.xxhash64("event_id"), F.lit(8)).cast("string")))
    part = salted.groupBy("k").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    key = F.regexp_replace("k", r"_\d+$", "").alias("user_key")
    return part.groupBy(key).agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("D21_skew_key_split", BY_USER)
def _(t):
    hot = skewed_keys(t.events, "user_id", times=1.2)
    return split_aggregate(t.events, "user_id", hot, "event_id", {"n": F.count("*"), "total": F.sum("value")}, 8).withColumn("total", F.round("total", 2))


@query(
    "D22_null_key_split",
    """SELECT k, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS k FROM events) GROUP BY 1""",
)
def _(t):
    keyed = t.events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("k"))
    known = keyed.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    lost = keyed.filter("k IS NULL").agg(F.lit(None).cast("long").alias("k"), F.count("*").alias("n")).filter("n > 0")
    return known.unionByName(lost)


@query(
    "D23_skew_diagnosis",
    """SELECT max(n) AS most, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS sd,
              CASE WHEN max(n) / avg(n) > 10 THEN 'severe' WHEN max(n) / avg(n) > 3 THEN 'light' ELSE 'none' END AS skew
       FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def _(t):
    sizes = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    times = F.max("n") / F.avg("n")
    return sizes.agg(
        F.max("n").alias("most"),
        F.round(F.avg("n"), 4).alias("mean"),
        F.round(F.stddev_samp("n"), 4).alias("sd"),
        F.when(times > 10, "severe").when(times > 3, "light").otherwise("none").alias("skew"),
    )


@query("D24_bucket_balance", "SELECT o_custkey % 32 AS bucket, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(F.pmod("o_custkey", F.lit(32)).alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "D25_atomic_derived_composite",
    """WITH atomic AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS gmv FROM orders GROUP BY 1),
       derived AS (SELECT *, CAST(gmv AS DOUBLE) / orders AS aov FROM atomic)
       SELECT CAST(month AS VARCHAR) AS month, orders, CAST(gmv AS DOUBLE) AS gmv, aov,
              round((aov - lag(aov) OVER (ORDER BY month)) / nullif(lag(aov) OVER (ORDER BY month), 0), 6) AS aov_growth FROM derived""",
)
def _(t):
    atomic = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("gmv")
    )
    derived = atomic.withColumn("gmv", F.col("gmv").cast("double")).withColumn("aov", F.col("gmv") / F.col("orders"))
    before = F.lag("aov").over(Window.orderBy("month"))  # a row for each month
    growth = F.round(F.try_divide(F.col("aov") - before, before), 6).alias("aov_growth")
    return derived.select("month", "orders", "gmv", "aov", growth)


@query("D26_bitmap_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    # Bitmaps by bucket of 32,768 ids merge like sums; the distinct count is their number of bits.
    buckets = t.events.groupBy("event_type", F.bitmap_bucket_number("user_id").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("bits")
    )
    return buckets.groupBy("event_type").agg(F.sum(F.bitmap_count("bits")).alias("users"))


@query(
    "D27_array_aggregate",
    """SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, list_aggregate(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey), 'string_agg', ',') AS orders
       FROM orders GROUP BY 1, 2""",
)
def _(t):
    """One array for each customer and month, so that no value grows with a customer's whole history."""
    keys = F.array_sort(F.collect_list("o_orderkey"))
    return t.orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.array_join(keys.cast("array<string>"), ",").alias("orders"))


@query(
    "D28_json_aggregate",
    """SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS nations
       FROM nation GROUP BY 1""",
)
def _(t):
    members = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    return t.nation.groupBy("n_regionkey").agg(F.to_json(members).alias("nations"))


@query("D29_string_aggregate", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _(t):
    t.register("nation")
    return t.spark.sql("SELECT n_regionkey, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")


CUT = "CAST(year(o_orderdate) AS INT) AS y, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice FROM orders"


def cuttable(t):
    return t.orders.select(F.year("o_orderdate").alias("y"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice")


@query(
    "D30_rollup",
    f"SELECT y, status, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM (SELECT {CUT}) GROUP BY ROLLUP (y, status)",
)
def _(t):
    return cuttable(t).rollup("y", "status").agg(F.count("*").alias("n"), total("o_totalprice", "amount"))


@query(
    "D31_drill_down",
    """SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(day(o_orderdate) AS INT) AS d, count(*) AS n FROM orders
       GROUP BY GROUPING SETS ((y), (y, m), (y, m, d))""",
)
def _(t):
    days = t.orders.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.day("o_orderdate").alias("d"))
    sets = [["y"], ["y", "m"], ["y", "m", "d"]]
    return days.groupingSets([[F.col(c) for c in s] for s in sets], "y", "m", "d").agg(F.count("*").alias("n")).select("y", "m", "d", "n")


@query(
    "D32_cube",
    f"SELECT y, status, priority, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM (SELECT {CUT}) GROUP BY CUBE (y, status, priority)",
)
def _(t):
    return cuttable(t).cube("y", "status", "priority").agg(F.count("*").alias("n"), total("o_totalprice", "amount"))


@query(
    "D33_slice_dice",
    f"""SELECT 'slice' AS cut, y, status, count(*) AS n FROM (SELECT {CUT}) WHERE status = 'F' GROUP BY y, status
        UNION ALL SELECT 'dice', y, status, count(*) FROM (SELECT {CUT}) WHERE status IN ('F', 'O') AND y BETWEEN 1996 AND 1997 GROUP BY y, status""",
)
def _(t):
    cells = cuttable(t).groupBy("y", "status").agg(F.count("*").alias("n"))
    cut = lambda name, rows: rows.select(F.lit(name).alias("cut"), "y", "status", "n")
    return cut("slice", cells.filter("status = 'F'")).unionByName(cut("dice", cells.filter("status IN ('F', 'O') AND y BETWEEN 1996 AND 1997")))
