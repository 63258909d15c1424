"""The flagship: daily net GMV."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query


def net_by_day(t):
    """Gross, refunded and net amount by order day; items are summed per order before the join."""
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    items = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(amount).alias("gross"),
        F.sum(F.when(F.col("l_returnflag") == "R", amount).otherwise(0)).alias("refunded"),
    )
    paid = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    joined = paid.join(items, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("day").agg(
        F.count("*").alias("orders"),
        F.sum("gross").alias("gross"),
        F.sum("refunded").alias("refunded"),
        F.sum(F.col("gross") - F.col("refunded")).alias("net"),
    )


def date_spine(days, column="day"):
    """Every day from the first to the last of `days`."""
    ends = days.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return ends.select(F.explode(F.sequence("low", "high")).alias(column))


@query(
    "gmv_daily",
    """
    WITH items AS (
      SELECT l_orderkey, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS gross,
             sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) ELSE 0 END) AS refunded
      FROM lineitem GROUP BY 1
    ), d AS (
      SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, sum(gross) AS gross, sum(refunded) AS refunded,
             sum(gross - refunded) AS net
      FROM orders JOIN items ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1
    ), spine AS (
      SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d
    ), filled AS (
      SELECT spine.day, coalesce(orders, 0) AS orders, coalesce(gross, 0) AS gross, coalesce(refunded, 0) AS refunded,
             coalesce(net, 0) AS net FROM spine LEFT JOIN d USING (day)
    )
    SELECT CAST(day AS VARCHAR) AS day, orders, CAST(gross AS DOUBLE) AS gross, CAST(refunded AS DOUBLE) AS refunded,
           CAST(net AS DOUBLE) AS net,
           CAST(sum(net) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) AS net_7d,
           round((CAST(net AS DOUBLE) - lag(CAST(net AS DOUBLE)) OVER (ORDER BY day))
                 / nullif(lag(CAST(net AS DOUBLE)) OVER (ORDER BY day), 0), 6) AS growth
    FROM filled
    """,
)
def _(t):
    daily = net_by_day(t)
    filled = date_spine(daily).join(daily, "day", "left").fillna(0, ["orders"])
    for c in ("gross", "refunded", "net"):
        filled = filled.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast("decimal(28,4)")))
    # One row per day is left: the window over all of them is small at any scale.
    order = Window.orderBy("day")
    before = F.lag(F.col("net").cast("double")).over(order)
    return filled.select(
        "day",
        "orders",
        *(F.col(c).cast("double").alias(c) for c in ("gross", "refunded", "net")),
        F.sum("net").over(order.rowsBetween(-6, 0)).cast("double").alias("net_7d"),
        F.round(F.try_divide(F.col("net").cast("double") - before, before), 6).alias("growth"),
    )
