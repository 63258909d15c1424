"""E: window functions. Windows are partitioned by a key, or run over a spine of at most one row per day or month."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ranks import value_ranks
from tidemark.plans.registry import query
from tidemark.plans.section_d import mean
from tidemark.plans.section_main import date_spine


def user_order():
    return Window.partitionBy("user_id").orderBy("ts", "event_id")


def customer_order():
    return Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")


BY_TIME = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
BY_DATE = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


@query("E1_row_number", f"SELECT event_id, row_number() {BY_TIME} AS n FROM events")
def _(t):
    return t.events.select("event_id", F.row_number().over(user_order()).alias("n"))


SIZES = "FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size DESC)"


@query("E2_rank", f"SELECT p_partkey, rank() OVER w AS rank {SIZES}")
def _(t):
    return value_ranks(t.part, "p_brand", "p_size").select("p_partkey", "rank")


@query("E3_dense_rank", f"SELECT p_partkey, dense_rank() OVER w AS rank {SIZES}")
def _(t):
    return value_ranks(t.part, "p_brand", "p_size").select("p_partkey", F.col("dense_rank").alias("rank"))


@query(
    "E4_rank_over_aggregate",
    """SELECT p_brand, p_type, n, rank() OVER (PARTITION BY p_brand ORDER BY n DESC) AS rank FROM
       (SELECT p_brand, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
)
def _(t):
    sold = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return sold.withColumn("rank", F.rank().over(Window.partitionBy("p_brand").orderBy(F.desc("n"))))


@query("E5_running_sum", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS spent FROM orders")
def _(t):
    frame = customer_order().rowsBetween(Window.unboundedPreceding, 0)
    return t.orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(frame), 2).alias("spent"))


@query(
    "E6_moving_average",
    "SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) AS mean FROM orders",
)
def _(t):
    return t.orders.select("o_orderkey", F.round(F.avg("o_totalprice").over(customer_order().rowsBetween(-2, 0)), 3).alias("mean"))


DAYS = """d AS (SELECT CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,4))) AS total FROM events GROUP BY 1),
          spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
          filled AS (SELECT spine.day, coalesce(total, 0) AS total FROM spine LEFT JOIN d USING (day))"""


def daily(t):
    """The total of each day, days without events too."""
    days = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return date_spine(days).join(days, "day", "left").withColumn("total", F.coalesce("total", F.lit(0).cast("decimal(28,4)")))


@query(
    "E7_rolling_7_days",
    f"WITH {DAYS} SELECT CAST(day AS VARCHAR) AS day, CAST(sum(total) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS total_7d FROM filled",
)
def _(t):
    return daily(t).select("day", F.sum("total").over(Window.orderBy("day").rowsBetween(-6, 0)).cast("double").alias("total_7d"))


@query(
    "E8_cumulative_total",
    f"WITH {DAYS} SELECT CAST(day AS VARCHAR) AS day, CAST(sum(total) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far FROM filled",
)
def _(t):
    frame = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily(t).select("day", F.sum("total").over(frame).cast("double").alias("so_far"))


@query(
    "E9_range_frame",
    """SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM events""",
)
def _(t):
    t.register("events")
    return t.spark.sql(
        """SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(ts AS TIMESTAMP)
                  RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW) AS n FROM events"""
    )


@query(
    "E10_lag",
    f"SELECT o_orderkey, CAST(lag(CAST(o_orderdate AS DATE)) {BY_DATE} AS VARCHAR) AS before, CAST(CAST(o_orderdate AS DATE) - lag(CAST(o_orderdate AS DATE)) {BY_DATE} AS INT) AS days FROM orders",
)
def _(t):
    day = F.to_date("o_orderdate")
    before = F.lag(day).over(customer_order())
    return t.orders.select("o_orderkey", before.alias("before"), F.datediff(day, before).alias("days"))


@query("E11_lead", f"SELECT event_id, lead(event_type) {BY_TIME} AS following FROM events")
def _(t):
    return t.events.select("event_id", F.lead("event_type").over(user_order()).alias("following"))


MONTHS = "m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS gmv FROM orders GROUP BY 1)"


def months(t):
    """GMV by month; the orders have every month."""
    by = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month"))
    return by.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("gmv"))


@query(
    "E12_year_on_year",
    f"""WITH {MONTHS}, s AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m)
        SELECT CAST(s.month AS VARCHAR) AS month, CAST(gmv AS DOUBLE) AS gmv, CAST(lag(gmv, 12) OVER (ORDER BY s.month) AS DOUBLE) AS last_year FROM s LEFT JOIN m USING (month)""",
)
def _(t):
    m = months(t)
    ends = m.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    dense = ends.select(F.explode(F.expr("sequence(a, b, INTERVAL 1 MONTH)")).alias("month")).join(m, "month", "left")
    return dense.select("month", F.col("gmv").cast("double").alias("gmv"), F.lag("gmv", 12).over(Window.orderBy("month")).cast("double").alias("last_year"))


@query(
    "E13_period_growth",
    f"WITH {MONTHS} SELECT CAST(month AS VARCHAR) AS month, round(CAST(gmv AS DOUBLE) / lag(CAST(gmv AS DOUBLE)) OVER (ORDER BY month) - 1, 6) AS growth FROM m",
)
def _(t):
    gmv = F.col("gmv").cast("double")
    return months(t).select("month", F.round(F.try_divide(gmv, F.lag(gmv).over(Window.orderBy("month"))) - 1, 6).alias("growth"))


@query(
    "E14_month_on_month_per_group",
    """WITH g AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT o_orderpriority, CAST(month AS VARCHAR) AS month, n - lag(n) OVER (PARTITION BY o_orderpriority ORDER BY month) AS more FROM g""",
)
def _(t):
    g = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy("o_orderpriority").orderBy("month"))
    return g.select("o_orderpriority", "month", (F.col("n") - before).alias("more"))


@query(
    "E15_top_n_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
)
def _(t):
    best = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.withColumn("n", F.row_number().over(best)).filter("n <= 3").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "E16_top_n_with_ties",
    """SELECT h, user_id, n, r FROM (SELECT *, rank() OVER (PARTITION BY h ORDER BY n DESC) AS r FROM
       (SELECT CAST(hour(ts) AS INT) AS h, user_id, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r <= 10""",
)
def _(t):
    hourly = t.events.groupBy(F.hour("ts").alias("h"), "user_id").agg(F.count("*").alias("n"))
    ranked = hourly.withColumn("r", F.rank().over(Window.partitionBy("h").orderBy(F.desc("n"))))
    return ranked.filter("r <= 10")


@query(
    "E17_best_variant_per_window",
    """SELECT CAST(day AS VARCHAR) AS day, event_type, mean FROM (SELECT CAST(ts AS DATE) AS day, event_type, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) + 1e-9, 4) AS mean FROM events GROUP BY 1, 2)
       QUALIFY row_number() OVER (PARTITION BY day ORDER BY mean DESC, event_type) = 1""",
)
def _(t):
    rates = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(mean("value").alias("mean"))
    best = Window.partitionBy("day").orderBy(F.desc("mean"), "event_type")
    return rates.withColumn("n", F.row_number().over(best)).filter("n = 1").drop("n")


@query(
    "E18_login_streak",
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
       i AS (SELECT user_id, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS island FROM d)
       SELECT user_id, max(n) AS longest FROM (SELECT user_id, island, count(*) AS n FROM i GROUP BY 1, 2) GROUP BY 1""",
)
def _(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("day"))
    islands = days.withColumn("island", F.date_sub("day", n)).groupBy("user_id", "island").agg(F.count("*").alias("n"))
    return islands.groupBy("user_id").agg(F.max("n").alias("longest"))


@query("E19_first_event", "SELECT user_id, arg_min(event_id, (ts, event_id)) AS first_event FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"))


@query("E20_order_sequence", f"SELECT o_orderkey, row_number() {BY_DATE} AS sequence FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.row_number().over(customer_order()).alias("sequence"))


@query(
    "E21_correlated_count_rank",
    "SELECT p_partkey, (SELECT count(*) FROM part q WHERE q.p_brand = p.p_brand AND q.p_size >= p.p_size) AS rank FROM part p",
)
def _(t):
    # All sizes not smaller than mine, counted by size first.
    return value_ranks(t.part.filter("p_size IS NOT NULL"), "p_brand", "p_size").select("p_partkey", F.col("reached").alias("rank"))


@query(
    "E22_first_last_value",
    """SELECT o_orderkey, first_value(o_orderkey) OVER w AS first, last_value(o_orderkey) OVER w AS last FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(t):
    whole = customer_order().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return t.orders.select("o_orderkey", F.first("o_orderkey").over(whole).alias("first"), F.last("o_orderkey").over(whole).alias("last"))


@query(
    "E23_count_avg_over",
    """SELECT s_suppkey, count(*) OVER w AS n, round(CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(s_acctbal) OVER w + 1e-9, 4) AS mean
       FROM supplier WINDOW w AS (PARTITION BY s_nationkey)""",
)
def _(t):
    """Aggregated by nation and joined back: a window would put a nation's rows into one task."""
    average = mean("s_acctbal").alias("mean")
    each = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n"), average)
    return t.supplier.join(each, F.col("s_nationkey").eqNullSafe(F.col("nation"))).select("s_suppkey", "n", "mean")


@query(
    "E24_range_value_frame",
    "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_totalprice RANGE BETWEEN 10000 PRECEDING AND 10000 FOLLOWING) AS near FROM orders",
)
def _(t):
    near = Window.partitionBy("o_custkey").orderBy("o_totalprice").rangeBetween(-10000, 10000)
    return t.orders.select("o_orderkey", F.count("*").over(near).alias("near"))
