"""I: business metrics. Distinct counts per day go through (day, user) first, so a hot day or user is combined early."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans import derived
from tidemark.plans.registry import query
from tidemark.plans.section_d import exact

DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day"
PAID = "o_orderstatus <> 'P' AND o_totalprice > 0"
RETURNED = "(SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"


def paid(t):
    return t.orders.filter(PAID)


def returned(t):
    return t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()


def gmv(rows, *by):
    return rows.groupBy(*by).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("gmv"))


GMV = "count(*) AS orders, round(sum(o_totalprice), 2) AS gmv"


def order_day():
    return F.to_date("o_orderdate").alias("day")


@query("I1_gmv_by_day", f"SELECT {DAY}, {GMV} FROM orders WHERE {PAID} GROUP BY 1")
def _(t):
    return gmv(paid(t), order_day())


@query("I2_gmv_without_refunded", f"SELECT {DAY}, {GMV} FROM orders WHERE {PAID} AND o_orderkey NOT IN {RETURNED} GROUP BY 1")
def _(t):
    return gmv(paid(t).join(returned(t), "o_orderkey", "left_anti"), order_day())


@query(
    "I3_gross_refund_net",
    f"""WITH g AS (SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS gross FROM orders WHERE {PAID} GROUP BY 1),
        r AS (SELECT CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS refund FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
        SELECT CAST(coalesce(g.d, r.d) AS VARCHAR) AS day, coalesce(gross, 0.0) AS gross, coalesce(refund, 0.0) AS refund,
               round(coalesce(gross, 0.0) - coalesce(refund, 0.0), 2) AS net FROM g FULL JOIN r ON g.d = r.d""",
)
def _(t):
    g = paid(t).groupBy(order_day()).agg(F.round(F.sum("o_totalprice"), 2).alias("gross"))
    r = t.lineitem.filter("l_returnflag = 'R'").groupBy(F.to_date("l_shipdate").alias("day"))
    both = g.join(r.agg(F.round(F.sum("l_extendedprice"), 2).alias("refund")), "day", "full").fillna(0.0)
    return both.withColumn("net", F.round(F.col("gross") - F.col("refund"), 2))


BLACKLIST = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"


@query(
    "I4_cleaned_gmv",
    f"""SELECT {DAY}, {GMV} FROM orders WHERE {PAID} AND o_orderpriority <> '4-NOT SPECIFIED' AND o_custkey NOT IN {BLACKLIST}
        AND o_orderkey NOT IN {RETURNED} GROUP BY 1""",
)
def _(t):
    barred = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    rows = paid(t).filter("o_orderpriority <> '4-NOT SPECIFIED'").join(barred, "o_custkey", "left_anti")
    return gmv(rows.join(returned(t), "o_orderkey", "left_anti"), order_day())


ACTIVE = "a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)"
FIRST = "f AS (SELECT user_id, min(CAST(ts AS DATE)) AS day FROM events GROUP BY 1)"


def active(t):
    return t.events.select("user_id", F.to_date("ts").alias("day")).distinct()


def first_days(t):
    return t.events.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("day"))


@query("I5_dau", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS dau FROM events GROUP BY 1")
def _(t):
    return active(t).groupBy("day").agg(F.count("user_id").alias("dau"))


REGISTERED = "reg AS (SELECT o_custkey AS user_id, min(CAST(o_orderdate AS DATE)) AS day FROM orders GROUP BY 1)"


def registered(t):
    """The user table: a customer registers with the first order."""
    return t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.min(F.to_date("o_orderdate")).alias("day"))


@query("I6_new_registered", f"WITH {REGISTERED} SELECT CAST(day AS VARCHAR) AS day, count(*) AS users FROM reg GROUP BY 1")
def _(t):
    return registered(t).groupBy("day").agg(F.count("*").alias("users"))


@query("I7_new_first_active", f"WITH {FIRST} SELECT CAST(day AS VARCHAR) AS day, count(*) AS users FROM f GROUP BY 1")
def _(t):
    return first_days(t).groupBy("day").agg(F.count("*").alias("users"))


@query(
    "I8_next_day_retention",
    f"""WITH {ACTIVE} SELECT CAST(x.day AS VARCHAR) AS day, count(*) AS users, count(y.user_id) AS back, round(count(y.user_id) / count(*), 6) AS rate
        FROM a x LEFT JOIN a y ON y.user_id = x.user_id AND y.day = x.day + 1 GROUP BY 1""",
)
def _(t):
    came = active(t).select("user_id", F.date_sub("day", 1).alias("day"), F.lit(1).alias("back"))
    rows = active(t).join(came, ["user_id", "day"], "left").groupBy("day")
    return rows.agg(F.count("*").alias("users"), F.count("back").alias("back"), F.round(F.count("back") / F.count("*"), 6).alias("rate"))


def retention(first, activity, days: dict[str, str]):
    """Users by first day and how many of them were active at the given distances of days (SQL conditions on `n`)."""
    moves = first.alias("f").join(activity.alias("a"), F.expr("a.user_id = f.user_id AND a.day > f.day"), "left")
    moves = moves.select("f.user_id", "f.day", F.expr("datediff(a.day, f.day)").alias("n"))
    users = moves.groupBy("day", "user_id").agg(*(F.max(F.expr(f"CASE WHEN {c} THEN 1 ELSE 0 END")).alias(k) for k, c in days.items()))
    return users.groupBy("day").agg(F.count("*").alias("users"), *(F.sum(k).alias(k) for k in days))


RETAINED = """SELECT CAST(f.day AS VARCHAR) AS day, count(DISTINCT f.user_id) AS users, {} FROM f LEFT JOIN a ON a.user_id = f.user_id AND a.day > f.day GROUP BY 1"""


@query("I9_seven_day_retention", f"WITH {ACTIVE}, {FIRST} " + RETAINED.format("count(DISTINCT CASE WHEN a.day - f.day <= 7 THEN f.user_id END) AS week"))
def _(t):
    return retention(first_days(t), active(t), {"week": "n <= 7"})


@query(
    "I10_cohort_retention",
    f"WITH {ACTIVE}, {FIRST} " + RETAINED.format(", ".join(f"count(DISTINCT CASE WHEN a.day - f.day = {n} THEN f.user_id END) AS d{n}" for n in (1, 7, 30))),
)
def _(t):
    return retention(first_days(t), active(t), {f"d{n}": f"n = {n}" for n in (1, 7, 30)})


@query(
    "I11_lag_retention",
    f"""WITH {ACTIVE}, g AS (SELECT day, day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap FROM a), n AS (SELECT day, count(*) AS users FROM a GROUP BY 1)
        SELECT CAST(n.day AS VARCHAR) AS day, count(g.day) AS back, round(count(g.day) / n.users, 6) AS rate FROM n LEFT JOIN g ON g.day = n.day + 1 AND gap = 1 GROUP BY n.day, n.users""",
)
def _(t):
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("user_id").orderBy("day")))
    back = active(t).withColumn("gap", gap).filter("gap = 1").groupBy(F.date_sub("day", 1).alias("day")).agg(F.count("*").alias("back"))
    users = active(t).groupBy("day").agg(F.count("*").alias("users"))
    rows = users.join(back, "day", "left").fillna(0, ["back"])
    return rows.select("day", "back", F.round(F.col("back") / F.col("users"), 6).alias("rate"))


@query(
    "I12_active_days",
    f"""WITH {ACTIVE}, {FIRST}, d AS (SELECT f.day, f.user_id, count(a.day) AS n FROM f LEFT JOIN a ON a.user_id = f.user_id AND a.day BETWEEN f.day AND f.day + 29 GROUP BY 1, 2)
        SELECT CAST(day AS VARCHAR) AS day, count(*) AS users, count(*) FILTER (WHERE n >= 1) AS a1, count(*) FILTER (WHERE n >= 7) AS a7, count(*) FILTER (WHERE n >= 30) AS a30 FROM d GROUP BY 1""",
)
def _(t):
    near = F.expr("a.user_id = f.user_id AND a.day BETWEEN f.day AND date_add(f.day, 29)")
    d = first_days(t).alias("f").join(active(t).alias("a"), near, "left").groupBy("f.day", "f.user_id").agg(F.count("a.day").alias("n"))
    return d.groupBy("day").agg(F.count("*").alias("users"), *(F.count_if(F.col("n") >= k).alias(f"a{k}") for k in (1, 7, 30)))


@query(
    "I13_weekly_cohorts",
    f"""WITH {FIRST}, w AS (SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events),
        c AS (SELECT user_id, CAST(date_trunc('week', day) AS DATE) AS cohort FROM f), s AS (SELECT cohort, count(*) AS size FROM c GROUP BY 1)
        SELECT CAST(cohort AS VARCHAR) AS cohort, size, CAST((week - cohort) // 7 AS INT) AS n, count(*) AS users FROM c JOIN w USING (user_id) JOIN s USING (cohort) GROUP BY 1, 2, 3""",
)
def _(t):
    week = lambda c: F.date_trunc("week", c).cast("date")
    c = first_days(t).select("user_id", week("day").alias("cohort"))
    w = t.events.select("user_id", week("ts").alias("week")).distinct()
    sizes = c.groupBy("cohort").agg(F.count("*").alias("size"))
    n = F.floor(F.datediff("week", "cohort") / 7).cast("int").alias("n")
    return c.join(w, "user_id").groupBy("cohort", n).agg(F.count("*").alias("users")).join(sizes, "cohort").select("cohort", "size", "n", "users")


def month_moves(t):
    """Of each paid order the customer's cohort month and the distance to it in months."""
    first = t.orders.groupBy("o_custkey").agg(F.trunc(F.min("o_orderdate"), "month").alias("cohort"))
    month = F.trunc("o_orderdate", "month")
    return paid(t).join(first, "o_custkey").select("o_custkey", "cohort", F.months_between(month, "cohort").cast("int").alias("n"), "o_totalprice")


MOVES = f"""first AS (SELECT o_custkey, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS cohort FROM orders GROUP BY 1),
            m AS (SELECT o_custkey, cohort, CAST((year(o_orderdate) - year(cohort)) * 12 + month(o_orderdate) - month(cohort) AS INT) AS n, o_totalprice
                  FROM orders JOIN first USING (o_custkey) WHERE {PAID})"""


@query("I14_monthly_cohorts", f"WITH {MOVES} SELECT CAST(cohort AS VARCHAR) AS cohort, n, count(DISTINCT o_custkey) AS users FROM m GROUP BY 1, 2")
def _(t):
    users = month_moves(t).select("cohort", "n", "o_custkey").distinct()
    return users.groupBy("cohort", "n").agg(F.count("*").alias("users"))


@query(
    "I15_cohort_spend",
    f"""WITH {MOVES}, u AS (SELECT cohort, n, o_custkey, count(*) AS k, sum(o_totalprice) AS s FROM m GROUP BY 1, 2, 3)
        SELECT CAST(cohort AS VARCHAR) AS cohort, n, round(avg(k), 4) AS orders, round(avg(s), 6) AS spent FROM u GROUP BY 1, 2""",
)
def _(t):
    users = month_moves(t).groupBy("cohort", "n", "o_custkey").agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("s"))
    return users.groupBy("cohort", "n").agg(F.round(F.avg("k"), 4).alias("orders"), F.round(F.avg("s"), 6).alias("spent"))


STEPS = ("view", "click", "purchase")


@query(
    "I16_unordered_funnel",
    "SELECT " + ", ".join(f"count(DISTINCT CASE WHEN event_type = '{s}' THEN user_id END) AS {s}" for s in STEPS)
    + """, round(count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) / nullif(count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END), 0), 6) AS bought
       FROM events""",
)
def _(t):
    by_user = t.events.groupBy("user_id").agg(*(F.max((F.col("event_type") == s).cast("int")).alias(s) for s in STEPS))
    return by_user.agg(*(F.sum(s).alias(s) for s in STEPS), F.round(F.try_divide(F.sum("purchase"), F.sum("click")), 6).alias("bought"))


@query(
    "I17_step_funnel",
    """WITH u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS c, count(*) FILTER (WHERE event_type = 'purchase') AS p FROM events GROUP BY 1)
       SELECT count(*) AS users, count(*) FILTER (WHERE c > 0) AS clicked, count(*) FILTER (WHERE c > 0 AND p > 0) AS bought FROM u""",
)
def _(t):
    kind = F.col("event_type")
    users = t.events.groupBy("user_id").agg(F.count_if(kind == "click").alias("c"), F.count_if(kind == "purchase").alias("p"))
    return users.agg(F.count("*").alias("users"), F.count_if(F.col("c") > 0).alias("clicked"), F.count_if((F.col("c") > 0) & (F.col("p") > 0)).alias("bought"))


@query("I18_long_funnel", "SELECT event_type AS step, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(t):
    return t.events.select("event_type", "user_id").distinct().groupBy(F.col("event_type").alias("step")).agg(F.count("user_id").alias("users"))


@query("I19_aov", f"SELECT {DAY}, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS aov FROM orders WHERE {PAID} GROUP BY 1")
def _(t):
    return paid(t).groupBy(order_day()).agg((exact("o_totalprice") / F.count("*")).alias("aov"))


@query("I20_top_spenders", f"SELECT o_custkey, {GMV} FROM orders WHERE {PAID} GROUP BY 1 ORDER BY gmv DESC, 1 LIMIT 100")
def _(t):
    """A top list; the limit is the feature."""
    return gmv(paid(t), "o_custkey").orderBy(F.desc("gmv"), "o_custkey").limit(100)


@query(
    "I21_repeat_rate",
    f"SELECT count(*) AS buyers, count(*) FILTER (WHERE n >= 2) AS again, round(count(*) FILTER (WHERE n >= 2) / count(*), 6) AS rate FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE {PAID} GROUP BY 1)",
)
def _(t):
    buyers = paid(t).groupBy("o_custkey").agg(F.count("*").alias("n"))
    again = F.count_if(F.col("n") >= 2)
    return buyers.agg(F.count("*").alias("buyers"), again.alias("again"), F.round(F.try_divide(again, F.count("*")), 6).alias("rate"))


@query(
    "I22_new_user_repeat",
    f"""WITH f AS (SELECT o_custkey, min(o_orderdate) AS first FROM orders WHERE {PAID} GROUP BY 1),
        r AS (SELECT DISTINCT o.o_custkey FROM orders o JOIN f USING (o_custkey) WHERE {PAID} AND o_orderdate > first AND o_orderdate <= first + INTERVAL 30 DAY)
        SELECT count(*) AS customers, count(f.o_custkey) AS buyers, count(r.o_custkey) AS again FROM customer LEFT JOIN f ON f.o_custkey = c_custkey LEFT JOIN r ON r.o_custkey = c_custkey""",
)
def _(t):
    f = paid(t).groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    soon = F.expr("o_orderdate > first AND o_orderdate <= first + INTERVAL 30 DAYS")
    buyers = paid(t).join(f, "o_custkey").groupBy("o_custkey").agg(F.max(soon).alias("again"))
    rows = t.customer.join(buyers, F.expr("o_custkey = c_custkey"), "left")
    return rows.agg(F.count("*").alias("customers"), F.count("o_custkey").alias("buyers"), F.count_if("again").alias("again"))


@query("I23_repeat_day_rate", "SELECT user_id, round((count(*) - count(DISTINCT CAST(ts AS DATE))) / count(*), 6) AS rate FROM events GROUP BY 1")
def _(t):
    days = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n")).groupBy("user_id")
    return days.agg(F.round((F.sum("n") - F.count("*")) / F.sum("n"), 6).alias("rate"))


@query(
    "I24_first_order_category",
    f"""WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders WHERE {PAID}),
        b AS (SELECT DISTINCT o_custkey FROM o WHERE k > 1),
        i AS (SELECT DISTINCT o_custkey, p_brand FROM o JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey WHERE k = 1)
        SELECT p_brand, count(*) AS users, count(b.o_custkey) AS again FROM i LEFT JOIN b ON b.o_custkey = i.o_custkey GROUP BY 1""",
)
def _(t):
    k = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    o = paid(t).withColumn("k", k).select("o_custkey", "o_orderkey", "k")
    again = o.filter("k = 2").select("o_custkey", F.lit(1).alias("again"))
    items = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_brand"), F.expr("l_partkey = p_partkey"))
    bought = o.filter("k = 1").join(items, F.expr("l_orderkey = o_orderkey")).select("o_custkey", "p_brand").distinct()
    return bought.join(again, "o_custkey", "left").groupBy("p_brand").agg(F.count("*").alias("users"), F.count("again").alias("again"))


@query(
    "I25_product_rank",
    "SELECT l_partkey, sum(l_quantity) AS sold, rank() OVER (ORDER BY sum(l_quantity) DESC) AS place FROM lineitem GROUP BY 1 QUALIFY place <= 100",
)
def _(t):
    """The best hundred, ties included: a top list first, so that the window sees few rows."""
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"))
    last = sold.orderBy(F.desc("sold")).limit(100).agg(F.min("sold").alias("least"))
    best = sold.crossJoin(F.broadcast(last)).filter("sold >= least").drop("least")
    return best.withColumn("place", F.rank().over(Window.orderBy(F.desc("sold"))))


@query(
    "I26_category_share",
    "SELECT p_brand, round(sum(l_extendedprice), 2) AS sales, round(100 * sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (), 4) AS share FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
)
def _(t):
    sales = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).groupBy("p_brand").agg(F.sum("l_extendedprice").alias("s"))
    share = 100 * F.col("s") / F.sum("s").over(Window.partitionBy(F.lit(1)))  # a row for each brand
    return sales.select("p_brand", F.round("s", 2).alias("sales"), F.round(share, 4).alias("share"))


@query(
    "I27_campaign_roi",
    """WITH c AS (SELECT s_nationkey AS campaign, round(sum(greatest(s_acctbal, 0) * 100), 2) AS cost FROM supplier GROUP BY 1),
       r AS (SELECT c_nationkey AS campaign, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
       SELECT coalesce(c.campaign, r.campaign) AS campaign, coalesce(revenue, 0.0) AS revenue, coalesce(cost, 0.0) AS cost,
              round((coalesce(revenue, 0.0) - coalesce(cost, 0.0)) / nullif(coalesce(cost, 0.0), 0), 6) AS roi FROM c FULL JOIN r ON c.campaign = r.campaign""",
)
def _(t):
    cost = t.supplier.groupBy(F.col("s_nationkey").alias("campaign")).agg(F.round(F.sum(F.greatest("s_acctbal", F.lit(0.0)) * 100), 2).alias("cost"))
    revenue = t.orders.join(t.customer, F.expr("c_custkey = o_custkey")).groupBy(F.col("c_nationkey").alias("campaign"))
    both = cost.join(revenue.agg(F.round(F.sum("o_totalprice"), 2).alias("revenue")), "campaign", "full").fillna(0.0, ["cost", "revenue"])
    return both.select("campaign", "revenue", "cost", F.round(F.try_divide(F.col("revenue") - F.col("cost"), "cost"), 6).alias("roi"))


@query(
    "I28_value_segments",
    f"""SELECT c_custkey, CASE WHEN s >= 2000000 THEN 'vip' WHEN s >= 1000000 THEN 'high' WHEN s >= 200000 THEN 'normal' ELSE 'low' END AS segment
        FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders WHERE {PAID} GROUP BY 1) ON o_custkey = c_custkey""",
)
def _(t):
    spent = paid(t).groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    s = F.col("s")
    segment = F.when(s >= 2000000, "vip").when(s >= 1000000, "high").when(s >= 200000, "normal").otherwise("low")
    return t.customer.join(spent, F.expr("o_custkey = c_custkey"), "left").select("c_custkey", segment.alias("segment"))


def parsed_log(t):
    pattern = r'^(\S+) \S+ \S+ \[([^ ]+) [^\]]+\] "([^"]*)" (\d{3}) (\d+)$'
    part = lambda i: F.regexp_extract("value", pattern, i)
    return derived.access_log(t).select(
        part(1).alias("ip"),
        F.try_to_timestamp(part(2), F.lit("dd/MMM/yyyy:HH:mm:ss")).alias("ts"),
        part(4).try_cast("int").alias("status"),
        part(5).try_cast("long").alias("size"),
    )


@query(
    "I29_hourly_pv_uv",
    f"SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS h, count(*) AS pv, count(DISTINCT ip) AS uv, CAST(sum(size) AS BIGINT) AS bytes FROM ({derived.LOG_SQL}) GROUP BY 1",
)
def _(t):
    by = parsed_log(t).groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("h"), "ip").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    return by.groupBy("h").agg(F.sum("n").alias("pv"), F.count("ip").alias("uv"), F.sum("b").alias("bytes"))


@query("I30_status_share", f"SELECT status, count(*) AS n, round(count(*) * 100 / sum(count(*)) OVER (), 4) AS share FROM ({derived.LOG_SQL}) GROUP BY 1")
def _(t):
    n = parsed_log(t).groupBy("status").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy(F.lit(1))), 4))


@query(
    "I31_delivery",
    """SELECT o_orderpriority, round(avg(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE)), 4) AS days,
              round(100 * avg(CASE WHEN CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) <= 60 THEN 1 ELSE 0 END), 4) AS on_time
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _(t):
    days = F.datediff("l_shipdate", "o_orderdate")
    rows = t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey")).groupBy("o_orderpriority")
    return rows.agg(F.round(F.avg(days), 4).alias("days"), F.round(100 * F.avg((days <= 60).cast("int")), 4).alias("on_time"))


LAST30 = "CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - 30"


@query(
    "I32_fraud_by_account",
    f"SELECT user_id, count(*) AS n, round(sum(value), 2) AS amount, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean FROM events WHERE event_type = 'purchase' AND {LAST30} GROUP BY 1",
)
def _(t):
    last = t.events.agg(F.max(F.to_date("ts")).alias("last"))  # one row
    rows = t.events.filter("event_type = 'purchase'").crossJoin(F.broadcast(last)).filter("to_date(ts) > date_sub(last, 30)")
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("amount"), (exact("value") / F.count("*")).alias("mean"))


@query(
    "I33_monthly_by_type",
    "SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n, round(sum(value), 2) AS amount, count(DISTINCT user_id) AS accounts FROM events GROUP BY 1, 2",
)
def _(t):
    part = t.events.groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "event_type", "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("s"))
    return part.groupBy("month", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("s"), 2).alias("amount"), F.count("user_id").alias("accounts"))


@query(
    "I34_turnover_inputs",
    "SELECT strftime(l_shipdate, '%Y-%m') AS month, l_partkey, sum(l_quantity) AS sold, round(avg(p_size), 4) AS stock FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
)
def _(t):
    rows = t.lineitem.join(t.part, F.expr("l_partkey = p_partkey")).groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_partkey")
    return rows.agg(F.sum("l_quantity").alias("sold"), F.round(F.avg("p_size"), 4).alias("stock"))


@query("I35_attendance", "SELECT user_id, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS days FROM events GROUP BY 1")
def _(t):
    return active(t).groupBy("user_id").agg(F.count("day").alias("days"))


@query(
    "I36_experiment",
    """WITH u AS (SELECT user_id, user_id % 2 AS variant, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS hit FROM events GROUP BY 1, 2),
       v AS (SELECT variant, count(*) AS n, CAST(sum(hit) AS BIGINT) AS hits, avg(hit) AS rate FROM u GROUP BY 1),
       p AS (SELECT sum(hits) / sum(n) AS p, sqrt((sum(hits) / sum(n)) * (1 - sum(hits) / sum(n)) * sum(1.0 / n)) AS se FROM v)
       SELECT variant, n, hits, round(rate, 6) AS rate, rate = max(rate) OVER () AS winner,
              round((max(rate) OVER () - min(rate) OVER ()) / nullif(se, 0), 4) AS z FROM v, p""",
)
def _(t):
    hit = F.max((F.col("event_type") == "purchase").cast("int")).alias("hit")
    users = t.events.groupBy("user_id", F.pmod("user_id", F.lit(2)).alias("variant")).agg(hit)
    v = users.groupBy("variant").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"), F.avg("hit").alias("rate"))
    w = Window.partitionBy(F.lit(1))  # over the variants
    p = F.sum("hits").over(w) / F.sum("n").over(w)
    se = F.sqrt(p * (1 - p) * F.sum(1 / F.col("n")).over(w))
    best, worst = F.max("rate").over(w), F.min("rate").over(w)
    return v.select(
        "variant", "n", "hits", F.round("rate", 6).alias("rate"), (F.col("rate") == best).alias("winner"), F.round(F.try_divide(best - worst, se), 4).alias("z")
    )


@query(
    "I37_churn_risk",
    f"WITH {ACTIVE} SELECT user_id, max(gap) AS gap FROM (SELECT user_id, CAST(day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS INT) AS gap FROM a) GROUP BY 1 HAVING max(gap) > 7",
)
def _(t):
    """Users with more than seven days between two visits; every event is a visit."""
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("user_id").orderBy("day"))).alias("gap")
    return active(t).select("user_id", gap).groupBy("user_id").agg(F.max("gap").alias("gap")).filter("gap > 7")


@query(
    "I38_wau_mau",
    """SELECT 'week' AS grain, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS start, count(DISTINCT user_id) AS users FROM events GROUP BY 2
       UNION ALL SELECT 'month', CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR), count(DISTINCT user_id) FROM events GROUP BY 2""",
)
def _(t):
    def grain(name):
        rows = active(t).select(F.lit(name).alias("grain"), F.date_trunc(name, "day").cast("date").alias("start"), "user_id").distinct()
        return rows.groupBy("grain", "start").agg(F.count("user_id").alias("users"))

    return grain("week").unionByName(grain("month"))


@query(
    "I39_path_pairs",
    """SELECT a AS step, b AS following, count(*) AS n FROM (SELECT event_type AS a, lead(event_type) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS b FROM events)
       WHERE b IS NOT NULL GROUP BY 1, 2""",
)
def _(t):
    session = Window.partitionBy("user_id", F.to_date("ts")).orderBy("ts", "event_id")
    pairs = t.events.select(F.col("event_type").alias("step"), F.lead("event_type").over(session).alias("following"))
    return pairs.filter("following IS NOT NULL").groupBy("step", "following").agg(F.count("*").alias("n"))


@query(
    "I40_strict_day_7",
    f"WITH {ACTIVE}, {FIRST} SELECT CAST(f.day AS VARCHAR) AS day, count(*) AS users, count(a.user_id) AS back FROM f LEFT JOIN a ON a.user_id = f.user_id AND a.day = f.day + 7 GROUP BY 1",
)
def _(t):
    came = active(t).select("user_id", F.date_sub("day", 7).alias("day"), F.lit(1).alias("back"))
    return first_days(t).join(came, ["user_id", "day"], "left").groupBy("day").agg(F.count("*").alias("users"), F.count("back").alias("back"))


@query(
    "I41_word_count",
    r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\r\f\v]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1",
)
def _(t):
    words = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[ \t\n\r\f\x0B]+")).alias("word")
    return t.documents.select(words).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
