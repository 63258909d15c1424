"""J: warehouse modelling and ETL jobs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import changes, layout
from tidemark.plans import derived
from tidemark.plans.registry import query
from tidemark.plans.section_d import mean
from tidemark.plans.section_main import date_spine, net_by_day
from tidemark.runtime import scratch_path
from tidemark.sources import external, files, publish

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query("J1_full_reload", ORDERS)
def _(t):
    path = scratch_path(t.spark, "full")
    rows = t.orders.select(*COLUMNS)
    for _ in range(2):  # the second load replaces the first
        rows.write.mode("overwrite").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


def loaded_in_two(t, early):
    """A first extract up to a mark, then what lies beyond the mark that is stored."""
    path = scratch_path(t.spark, "incremental")
    rows = t.orders.select(*COLUMNS, "o_orderdate")
    rows.filter(early).write.parquet(path)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return path, rows, stored


@query("J2_incremental_by_watermark", ORDERS)
def _(t):
    path, rows, stored = loaded_in_two(t, F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ '1998-01-01'"))
    mark = stored.agg(F.max("o_orderdate").alias("mark"))  # one row
    late = rows.crossJoin(F.broadcast(mark)).filter("mark IS NULL OR o_orderdate > mark OR o_orderdate IS NULL").drop("mark")
    late.write.mode("append").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path).select(*COLUMNS)


@query("J3_incremental_by_id", ORDERS)
def _(t):
    path, rows, stored = loaded_in_two(t, F.col("o_orderkey") % 2 == 0)
    rows.join(stored.select("o_orderkey"), "o_orderkey", "left_anti").select(rows.columns).write.mode("append").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path).select(*COLUMNS)


@query("J4_cdc_apply", derived.ORDER_STATE_SQL)
def _(t):
    empty = t.spark.createDataFrame([], "order_id long, status string, amount double")
    return changes.apply_changes(empty, derived.order_changes(t), ["order_id"])


@query(
    "J5_cdc_envelope",
    """SELECT 'c' AS op, count(*) AS n FROM orders UNION ALL SELECT 'u', count(*) FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 'd', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'""",
)
def _(t):
    parsed = external.parse_json_value(derived.message_text(derived.order_changes(t)), derived.CHANGE_SCHEMA)
    return parsed.filter("rejected IS NULL").groupBy("op").agg(F.count("*").alias("n"))


@query(
    "J6_upsert",
    """SELECT c_custkey, CASE WHEN s IS NULL THEN c_acctbal ELSE s END AS balance FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS s FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey""",
)
def _(t):
    target = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"))
    new = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.sum("o_totalprice"), 2).alias("balance"))
    return changes.upsert(target, new, ["c_custkey"])


BY_DAY = "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS n FROM orders GROUP BY 1"


@query("J7_idempotent_day_reload", BY_DAY)
def _(t):
    path = scratch_path(t.spark, "days")
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    files.write_partitioned(rows, path, ["month"])
    for _ in range(2):  # the same late month twice changes nothing
        files.overwrite_touched(rows.filter("month = '1997-05'"), path, ["month"])
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("day").agg(F.count("*").alias("n"))


@query("J8_partition_reload", "SELECT strftime(o_orderdate, '%Y') AS y, round(sum(CASE WHEN year(o_orderdate) = 1998 THEN 2 ELSE 1 END * o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "years")
    rows = t.orders.select("o_totalprice", F.date_format("o_orderdate", "yyyy").alias("y"))
    files.write_partitioned(rows, path, ["y"])
    files.overwrite_touched(rows.filter("y = '1998'").withColumn("o_totalprice", 2 * F.col("o_totalprice")), path, ["y"])
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("y").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("J10_keep_latest", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return changes.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("J11_dedup_any", "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)")
def _(t):
    return t.lineitem.dropDuplicates(["l_orderkey", "l_suppkey"]).agg(F.count("*").alias("n"))


@query("J12_distinct_on", "SELECT DISTINCT ON (user_id) user_id, event_id FROM events ORDER BY user_id, value DESC, event_id")
def _(t):
    best = F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("event_id")
    return t.events.groupBy("user_id").agg(best)


@query("J13_event_dedup", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)")
def _(t):
    return t.events.groupBy("user_id", "event_type", F.to_date("ts").alias("d")).agg(F.min("event_id").alias("event_id")).drop("d")


@query("J14_clean_filter", "SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE user_id IS NOT NULL AND event_type <> 'error' AND value > 0")
def _(t):
    clean = t.events.filter("user_id IS NOT NULL AND event_type <> 'error' AND value > 0")
    return clean.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query(
    "J15_wide_table",
    """SELECT o_orderkey, c_mktsegment, n_name, round(coalesce(items, 0), 2) AS items FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS items FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def _(t):
    items = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("items"))
    wide = t.orders.join(t.customer, F.expr("c_custkey = o_custkey"), "left").join(t.nation, F.expr("n_nationkey = c_nationkey"), "left")
    wide = wide.join(items, F.expr("l_orderkey = o_orderkey"), "left")
    return wide.select("o_orderkey", "c_mktsegment", "n_name", F.round(F.coalesce("items", F.lit(0.0)), 2).alias("items"))


@query("J16_scd1", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def _(t):
    target = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    updates = t.customer.filter("c_acctbal < 0").select("c_custkey", F.lit(None).cast("string").alias("segment"))
    return changes.update_columns(target, updates, ["c_custkey"], ["segment"])


def versions(t):
    """Type 2 history of the last order's priority of each customer: a row for each stretch of days with one value."""
    day = F.to_date("o_orderdate")
    daily = t.orders.groupBy("o_custkey", day.alias("day")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("level"))
    order = Window.partitionBy("o_custkey").orderBy("day")
    changed = daily.withColumn("before", F.lag("level").over(order)).filter("before IS NULL OR before <> level")
    return changed.select(
        "o_custkey", "level", F.col("day").alias("effective"), F.date_sub(F.lead("day").over(order), 1).alias("expiry"), F.row_number().over(order).alias("version")
    )


SCD2 = """d AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderpriority, o_orderkey) AS level FROM orders GROUP BY 1, 2),
          c AS (SELECT *, lag(level) OVER (PARTITION BY o_custkey ORDER BY day) AS before FROM d),
          v AS (SELECT o_custkey, level, day AS effective, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) - 1 AS expiry,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY day) AS version FROM c WHERE before IS NULL OR before <> level)"""


@query(
    "J17_scd2",
    f"WITH {SCD2} SELECT o_custkey, level, CAST(effective AS VARCHAR) AS effective, CAST(expiry AS VARCHAR) AS expiry, expiry IS NULL AS is_current, version FROM v",
)
def _(t):
    return versions(t).withColumn("is_current", F.col("expiry").isNull())


@query("J19_history_table", f"WITH {SCD2} SELECT o_custkey, max(version) AS versions, arg_max(level, version) AS level FROM v GROUP BY 1")
def _(t):
    return versions(t).groupBy("o_custkey").agg(F.max("version").alias("versions"), F.max_by("level", "version").alias("level"))


STATE = "SELECT o_orderkey AS order_id, o_orderstatus AS status FROM orders"


@query("J21_read_time_merge", STATE)
def _(t):
    """A base and later updates, merged when they are read."""
    base = t.orders.select(F.col("o_orderkey").alias("order_id"), F.lit("P").alias("status"), F.lit(0).alias("v"))
    later = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("v"))
    return changes.latest_per_key(base.unionByName(later), ["order_id"], ["v"]).drop("v")


@query("J22_latest_version", STATE)
def _(t):
    log = derived.order_changes(t).filter("after IS NOT NULL").select("after.order_id", "after.status", "ts_ms")
    return changes.latest_per_key(log, ["order_id"], ["ts_ms"]).drop("ts_ms")


@query("J23_soft_delete", "SELECT o_orderkey, o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AS is_deleted FROM orders")
def _(t):
    log = derived.order_changes(t)
    last = changes.latest_per_key(log.select(F.coalesce("after.order_id", "before.order_id").alias("o_orderkey"), "op", "ts_ms"), ["o_orderkey"], ["ts_ms"])
    return last.select("o_orderkey", (F.col("op") == "d").alias("is_deleted"))


@query(
    "J24_date_dimension",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(year(d) AS INT) AS y, CAST(quarter(d) AS INT) AS q, CAST(month(d) AS INT) AS m, CAST(day(d) AS INT) AS d,
              CAST(isodow(d) AS INT) AS weekday, isodow(d) > 5 AS weekend, CAST(week(d) AS INT) AS week
       FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def _(t):
    days = date_spine(t.orders.select(F.to_date("o_orderdate").alias("day")))
    weekday = F.weekday("day") + 1
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"), F.year("day").alias("y"), F.quarter("day").alias("q"), F.month("day").alias("m"),
        F.day("day").alias("d"), weekday.alias("weekday"), (weekday > 5).alias("weekend"), F.weekofyear("day").alias("week"),
    )


@query("J25_junk_dimension_build", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    flags = t.lineitem.select("l_returnflag", "l_linestatus").distinct().withColumn("junk_key", F.xxhash64("l_returnflag", "l_linestatus"))
    facts = t.lineitem.select(F.xxhash64("l_returnflag", "l_linestatus").alias("junk_key")).groupBy("junk_key").agg(F.count("*").alias("n"))
    return facts.join(flags, "junk_key").drop("junk_key")


@query("J26_shrunken_dimension", "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m FROM orders")
def _(t):
    return t.orders.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).distinct()


@query(
    "J27_periodic_snapshot",
    """WITH m AS (SELECT CAST(unnest(generate_series(min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month FROM orders),
       b AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1, 2), p AS (SELECT DISTINCT o_orderpriority FROM orders)
       SELECT o_orderpriority, CAST(month AS VARCHAR) AS month, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY o_orderpriority ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far
       FROM m CROSS JOIN p LEFT JOIN b USING (month, o_orderpriority)""",
)
def _(t):
    b = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(F.count("*").alias("n"))
    ends = t.orders.agg(F.trunc(F.min("o_orderdate"), "month").alias("x"), F.trunc(F.max("o_orderdate"), "month").alias("y"))
    # The months of each group: a spine per priority, not a product of two tables.
    groups = b.select("o_orderpriority").distinct().join(F.broadcast(ends))
    spine = groups.select("o_orderpriority", F.explode(F.expr("sequence(x, y, INTERVAL 1 MONTH)")).alias("month"))
    frame = Window.partitionBy("o_orderpriority").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    filled = spine.join(b, ["o_orderpriority", "month"], "left").fillna(0, ["n"])
    return filled.select("o_orderpriority", "month", F.sum("n").over(frame).alias("so_far"))


@query(
    "J28_accumulating_snapshot",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered, CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first_shipped, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_shipped,
              CAST(CAST(max(l_shipdate) AS DATE) - CAST(o_orderdate AS DATE) AS INT) AS days FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate""",
)
def _(t):
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.to_date(F.min("l_shipdate")).alias("first_shipped"), F.to_date(F.max("l_shipdate")).alias("last_shipped"))
    ordered = F.to_date("o_orderdate")
    rows = t.orders.join(shipped, F.expr("l_orderkey = o_orderkey"), "left")
    return rows.select("o_orderkey", ordered.alias("ordered"), "first_shipped", "last_shipped", F.datediff("last_shipped", ordered).alias("days"))


@query(
    "J30_layer_pipeline",
    """SELECT c_mktsegment, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, count(*) AS orders, round(sum(o_totalprice), 2) AS gmv FROM orders JOIN customer ON c_custkey = o_custkey
       WHERE o_totalprice > 0 GROUP BY 1, 2""",
)
def _(t):
    root = scratch_path(t.spark, "layers")

    def layer(df, name):
        df.write.parquet(f"{root}/{name}")
        return t.spark.read.schema(df.schema).parquet(f"{root}/{name}")

    ods = layer(t.orders, "ods")
    dwd = layer(ods.filter("o_totalprice > 0").join(t.customer, F.expr("c_custkey = o_custkey")).select("o_orderkey", "o_totalprice", "c_mktsegment", F.to_date("o_orderdate").alias("day")), "dwd")
    dws = layer(dwd.groupBy("c_mktsegment", "day").agg(F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("gmv")), "dws")
    ads = dws.groupBy("c_mktsegment", F.trunc("day", "month").alias("month"))
    return layer(ads.agg(F.sum("orders").alias("orders"), F.round(F.sum("gmv").cast("double"), 2).alias("gmv")), "ads")


@query("J32_user_metrics", "SELECT o_custkey, count(*) AS orders, CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1")
def _(t):
    day = lambda c: F.to_date(c)
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), day(F.min("o_orderdate")).alias("first"), day(F.max("o_orderdate")).alias("last"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )


@query(
    "J33_gmv_on_spine",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
       SELECT CAST(s.day AS VARCHAR) AS day, coalesce(orders, 0) AS orders FROM (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d) s LEFT JOIN d USING (day)""",
)
def _(t):
    days = net_by_day(t).select("day", "orders")
    return date_spine(days).join(days, "day", "left").fillna(0, ["orders"])


@query(
    "J34_user_features",
    """SELECT user_id, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT event_type) AS kinds, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) + 1e-9, 4) AS mean, max(value) AS most,
              round(count(*) FILTER (WHERE event_type = 'purchase') / count(*), 6) AS buys FROM events GROUP BY 1""",
)
def _(t):
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("n"), F.countDistinct(F.to_date("ts")).alias("days"), F.countDistinct("event_type").alias("kinds"), mean("value").alias("mean"),
        F.max("value").alias("most"), F.round(F.count_if(F.col("event_type") == "purchase") / F.count("*"), 6).alias("buys"),
    )


@query("J35_batch_and_speed", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """A batch view of the closed days and a live view of the open day; a row is in one of them."""
    last = t.events.agg(F.max(F.to_date("ts")).alias("open"))
    marked = t.events.crossJoin(F.broadcast(last)).withColumn("live", F.to_date("ts") >= F.col("open"))
    view = lambda live: marked.filter(F.coalesce("live", F.lit(False)) == live).groupBy("event_type").agg(F.count("*").alias("n"))
    return view(False).unionByName(view(True)).groupBy("event_type").agg(F.sum("n").alias("n"))


@query(
    "J38_model_errors",
    """WITH e AS (SELECT o_totalprice AS y, avg(o_totalprice) OVER (PARTITION BY o_orderpriority) AS p FROM orders)
       SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2 FROM e, (SELECT avg(y) AS m FROM e)""",
)
def _(t):
    means = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("p"))
    e = t.orders.join(means, "o_orderpriority").select(F.col("o_totalprice").alias("y"), "p")
    off = F.col("y") - F.col("p")
    # The squares about the mean are n times the population variance.
    r2 = 1 - F.sum(off * off) / (F.var_pop("y") * F.count("*"))
    return e.agg(F.round(F.sqrt(F.avg(off * off)), 4).alias("rmse"), F.round(F.avg(F.abs(off)), 4).alias("mae"), F.round(r2, 6).alias("r2"))


@query(
    "J39_three_sigma",
    "SELECT event_id FROM events JOIN (SELECT event_type AS k, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1) ON k = event_type WHERE abs(value - m) > 3 * s",
)
def _(t):
    stats = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    return t.events.join(stats, "event_type").filter("abs(value - m) > 3 * s").select("event_id")


@query("J42_compaction", "SELECT 'before' AS stage, 32 AS files, count(*) AS n FROM lineitem UNION ALL SELECT 'after', 1, count(*) FROM lineitem")
def _(t):
    """Many small files made into as few as their bytes need. The check knows that these tables need one."""
    rows, path = t.lineitem.select("l_returnflag", "l_orderkey"), scratch_path(t.spark, "small")
    rows.repartition(32).write.parquet(path)
    compacted = layout.compact(t.spark, path, scratch_path(t.spark, "large"), rows.schema)
    return layout.file_counts(t.spark, {"before": path, "after": compacted}, rows.schema)


@query("J44_sorted_layout", "SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey BETWEEN 10 AND 60")
def _(t):
    path = scratch_path(t.spark, "sorted")
    rows = t.orders.select("o_custkey", "o_totalprice")
    rows.repartitionByRange("o_custkey").sortWithinPartitions("o_custkey").write.parquet(path)
    kept = t.spark.read.schema(rows.schema).parquet(path).filter("o_custkey BETWEEN 10 AND 60")
    return kept.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("J45_schema_evolution", "SELECT count(*) AS n, count(CASE WHEN o_orderkey % 2 = 1 THEN 1 END) AS with_status FROM orders")
def _(t):
    root = scratch_path(t.spark, "evolved")
    old, new = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 2 != 0
    t.orders.filter(old).select("o_orderkey").write.parquet(f"{root}/old")
    t.orders.filter(new).select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/new")
    both = files.read_evolved(t.spark, f"{root}/old", f"{root}/new")
    return both.agg(F.count("*").alias("n"), F.count("o_orderstatus").alias("with_status"))


@query("J46_key_tables", "SELECT user_id, count(*) AS duplicate_rows, round(sum(value), 2) AS aggregate_total, max(event_id) AS unique_event FROM events GROUP BY 1")
def _(t):
    rows = t.events.select("user_id", "event_id", "value")
    duplicate = rows.groupBy("user_id").agg(F.count("*").alias("duplicate_rows"))
    partials = rows.groupBy("user_id", F.pmod("event_id", F.lit(4)).alias("load")).agg(F.sum("value").alias("total"))
    aggregate = publish.merge_partials(partials, ["user_id"], ["total"]).select("user_id", F.round("total", 2).alias("aggregate_total"))
    unique = changes.latest_per_key(rows, ["user_id"], ["event_id"]).select("user_id", F.col("event_id").alias("unique_event"))
    return duplicate.join(aggregate, "user_id").join(unique, "user_id")
