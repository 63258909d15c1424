"""H: date, string, array, JSON, range and geo expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import derived
from tidemark.plans.registry import query
from tidemark.plans.section_main import date_spine

#: "Now" of the relative windows, so that a run can be repeated.
ANCHOR = "2000-01-01"


def one(name: str, sql: str, table: str, *columns: str):
    """A query that evaluates Spark expressions over a whole table."""
    query(name, f"SELECT {sql} FROM {table}")(lambda t: getattr(t, table).selectExpr(*columns))


one("H1_to_date", "o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day", "orders", "o_orderkey", "to_date(o_orderdate) AS day")
one(
    "H2_date_trunc",
    "event_id, CAST(date_trunc('month', ts) AS DATE)::VARCHAR AS month, CAST(CAST(date_trunc('day', ts) AS DATE) AS VARCHAR) AS day, CAST(hour(date_trunc('hour', ts)) AS INT) AS h",
    "events",
    "event_id",
    "CAST(date_trunc('month', ts) AS DATE) AS month",
    "CAST(date_trunc('day', ts) AS DATE) AS day",
    "hour(date_trunc('hour', ts)) AS h",
)
one("H3_month_start", "o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month", "orders", "o_orderkey", "trunc(o_orderdate, 'month') AS month")
one(
    "H4_minute_and_month_bucket",
    "event_id, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute, strftime(ts, '%Y%m') AS month",
    "events",
    "event_id",
    "unix_timestamp(date_trunc('minute', ts)) AS minute",
    "date_format(ts, 'yyyyMM') AS month",
)
one("H5_integer_date_key", "o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key", "orders", "o_orderkey", "CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) AS date_key")
one(
    "H6_parse_date_key",
    "o_orderkey, CAST(CAST(strptime(CAST(CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS VARCHAR), '%Y%m%d') AS DATE) AS VARCHAR) AS day",
    "orders",
    "o_orderkey",
    "to_date(CAST(CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) AS STRING), 'yyyyMMdd') AS day",
)
one(
    "H7_extract",
    "o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q, CAST(month(o_orderdate) AS INT) AS m, CAST(week(o_orderdate) AS INT) AS w, CAST(isodow(o_orderdate) AS INT) AS d",
    "orders",
    "o_orderkey",
    "year(o_orderdate) AS y",
    "quarter(o_orderdate) AS q",
    "month(o_orderdate) AS m",
    "weekofyear(o_orderdate) AS w",
    "weekday(o_orderdate) + 1 AS d",
)


@query(
    "H8_month_distance",
    """WITH f AS (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY 1)
       SELECT o_orderkey, CAST((year(o_orderdate) - year(first)) * 12 + month(o_orderdate) - month(first) AS INT) AS months FROM orders JOIN f USING (o_custkey)""",
)
def _(t):
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    months = F.months_between(F.trunc("o_orderdate", "month"), F.trunc("first", "month")).cast("int").alias("months")
    return t.orders.join(first, "o_custkey").select("o_orderkey", months)


@query(
    "H9_datediff",
    "SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS INT) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def _(t):
    return t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey")).select("l_orderkey", "l_linenumber", F.datediff("l_shipdate", "o_orderdate").alias("days"))


one(
    "H10_interval_arithmetic",
    "o_orderkey, CAST(CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS VARCHAR) AS due, CAST(CAST(o_orderdate - INTERVAL 2 MONTH AS DATE) AS VARCHAR) AS before",
    "orders",
    "o_orderkey",
    "CAST(o_orderdate + INTERVAL 30 DAYS AS DATE) AS due",
    "CAST(o_orderdate - INTERVAL 2 MONTHS AS DATE) AS before",
)


@query(
    "H11_relative_window",
    f"""SELECT count(*) FILTER (WHERE o_orderdate >= DATE '{ANCHOR}' - INTERVAL 7 DAY) AS week, count(*) FILTER (WHERE o_orderdate >= DATE '{ANCHOR}' - INTERVAL 30 DAY) AS month
        FROM orders WHERE o_orderdate < DATE '{ANCHOR}'""",
)
def _(t):
    since = lambda days: F.count_if(F.col("o_orderdate") >= F.expr(f"CAST(date_sub(DATE'{ANCHOR}', {days}) AS TIMESTAMP_NTZ)"))
    before = t.orders.filter(f"o_orderdate < CAST(DATE'{ANCHOR}' AS TIMESTAMP_NTZ)")
    return before.agg(since(7).alias("week"), since(30).alias("month"))


@query("H12_hour", "SELECT CAST(hour(ts) AS INT) AS h, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(F.hour("ts").alias("h")).agg(F.count("*").alias("n"))


@query("H13_to_timestamp_pattern", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM ({derived.LOG_SQL}) GROUP BY 1")
def _(t):
    stamp = F.regexp_extract("value", r"\[([^ ]+) \+0000\]", 1)
    day = F.to_date(F.try_to_timestamp(stamp, F.lit("dd/MMM/yyyy:HH:mm:ss"))).alias("day")
    return derived.access_log(t).groupBy(day).agg(F.count("*").alias("n"))


one(
    "H14_epoch_hours",
    f"event_id, round((epoch(TIMESTAMP '{ANCHOR}') - floor(epoch(ts))) / 3600, 4) AS hours",
    "events",
    "event_id",
    f"round((unix_timestamp(TIMESTAMP'{ANCHOR}') - unix_timestamp(ts)) / 3600, 4) AS hours",
)


@query(
    "H15_date_spine",
    """WITH s AS (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)
       SELECT CAST(day AS VARCHAR) AS day, count(o_orderkey) AS n FROM s LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1""",
)
def _(t):
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return date_spine(days).join(days, "day", "left").fillna(0, ["n"])


@query("H16_regex_extract", f"SELECT ip, request, status, size, count(*) AS n FROM ({derived.LOG_SQL}) GROUP BY 1, 2, 3, 4")
def _(t):
    pattern = r'^(\S+) \S+ \S+ \[[^\]]+\] "([^"]*)" (\d{3}) (\d+)$'
    part = lambda i: F.regexp_extract("value", pattern, i)
    rows = derived.access_log(t).select(
        part(1).alias("ip"), part(2).alias("request"), part(3).try_cast("int").alias("status"), part(4).try_cast("long").alias("size")
    )
    return rows.groupBy("ip", "request", "status", "size").agg(F.count("*").alias("n"))


one("H17_regex_replace", "p_partkey, regexp_replace(p_brand, '#[0-9]+$', '') AS maker", "part", "p_partkey", "regexp_replace(p_brand, '#[0-9]+$', '') AS maker")
one(
    "H18_concat_literal",
    "o_orderkey, o_custkey || '_' || (o_orderkey % 10) AS salted",
    "orders",
    "o_orderkey",
    "concat(CAST(o_custkey AS STRING), '_', CAST(o_orderkey % 10 AS STRING)) AS salted",
)
one(
    "H19_abs_ratio",
    "c_custkey, abs(c_acctbal) AS size, round(abs(c_acctbal - 5000) / 5000, 6) AS off",
    "customer",
    "c_custkey",
    "abs(c_acctbal) AS size",
    "round(abs(c_acctbal - 5000) / 5000, 6) AS off",
)


@query("H20_modulo_bucket", "SELECT user_id % 32 AS bucket, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(F.pmod("user_id", F.lit(32)).alias("bucket")).agg(F.count("*").alias("n"))


one("H21_clamp", "s_suppkey, greatest(0.0, least(1.0, s_acctbal / 10000)) AS score", "supplier", "s_suppkey", "greatest(0D, least(1D, s_acctbal / 10000)) AS score")
one(
    "H22_array_contains_all",
    "p_partkey, list_has_all(string_split(p_type, ' '), ['STEEL']) AND list_has_all(string_split(upper(p_name), ' '), [upper(string_split(p_name, ' ')[1])]) AS hit",
    "part",
    "p_partkey",
    "size(array_except(array('STEEL'), split(p_type, ' '))) = 0 AND size(array_except(array(upper(split(p_name, ' ')[0])), split(upper(p_name), ' '))) = 0 AS hit",
)
one(
    "H23_array_overlap",
    "p_partkey, list_has_any(string_split(p_type, ' '), ['STEEL', 'BRASS']) AS hit",
    "part",
    "p_partkey",
    "arrays_overlap(split(p_type, ' '), array('STEEL', 'BRASS')) AS hit",
)


@query("H24_json_containment", "SELECT event_id FROM events WHERE CAST(props ->> '$.k' AS INT) = 3")
def _(t):
    return t.events.filter(F.get_json_object("props", "$.k").cast("int") == 3).select("event_id")


@query("H25_json_parse", "SELECT CAST(props ->> '$.k' AS INT) AS k, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    k = F.from_json("props", "k int")["k"].alias("k")
    return t.events.groupBy(k).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


one(
    "H26_json_build",
    """s_suppkey, '{"name":"' || s_name || '","nation":' || s_nationkey || '}' AS doc""",
    "supplier",
    "s_suppkey",
    "to_json(struct(s_name AS name, s_nationkey AS nation)) AS doc",
)

SPAN = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2"""


def spans(t):
    """Of each order the half-open range from the order to its last shipment."""
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    joined = t.orders.join(last, F.expr("o_orderkey = l_orderkey"))
    return joined.select("o_orderkey", F.to_date("o_orderdate").alias("s"), F.to_date("last").alias("e"))


@query("H27_range_overlap", f"SELECT o_orderkey FROM ({SPAN}) WHERE s < DATE '1997-07-01' AND e > DATE '1997-06-01'")
def _(t):
    return spans(t).filter("s < DATE'1997-07-01' AND e > DATE'1997-06-01'").select("o_orderkey")


@query("H28_range_containment", f"SELECT o_orderkey FROM ({SPAN}) WHERE s <= DATE '1997-06-01' AND e >= DATE '1997-06-05'")
def _(t):
    return spans(t).filter("s <= DATE'1997-06-01' AND e >= DATE'1997-06-05'").select("o_orderkey")


LON, LAT = "(s_suppkey * 37 % 3600) / 10.0 - 180", "(s_suppkey * 53 % 1600) / 10.0 - 80"
DISTANCE = "2 * 6371.0 * asin(sqrt(pow(sin(radians(lat + 60.0) / 2), 2) + cos(radians(-60.0)) * cos(radians(lat)) * pow(sin(radians(lon + 160.0) / 2), 2)))"


@query(
    "H29_geo_radius",
    f"""SELECT s_suppkey, round(d, 3) AS km FROM (SELECT s_suppkey, {DISTANCE} AS d FROM (SELECT s_suppkey, {LON} AS lon, {LAT} AS lat FROM supplier)) WHERE d <= 9000""",
)
def _(t):
    places = t.supplier.selectExpr("s_suppkey", f"CAST({LON} AS DOUBLE) AS lon", f"CAST({LAT} AS DOUBLE) AS lat")
    # A box of latitudes first: one degree is 111 km.
    near = places.filter("lat BETWEEN -60 - 9000 / 111.0 AND -60 + 9000 / 111.0").withColumn("d", F.expr(DISTANCE))
    return near.filter("d <= 9000").select("s_suppkey", F.round("d", 3).alias("km"))


@query(
    "H30_full_text_match",
    r"""SELECT doc_id FROM documents WHERE list_has_all(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), ['license', 'version'])""",
)
def _(t):
    tokens = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+")
    return t.documents.filter(F.array_contains(tokens, "license") & F.array_contains(tokens, "version")).select("doc_id")


one(
    "H31_masking",
    "c_custkey, substr(c_name, 1, 3) || '****' || substr(c_name, 8) AS name, sha256(c_name) AS digest",
    "customer",
    "c_custkey",
    "overlay(c_name PLACING '****' FROM 4 FOR 4) AS name",
    "sha2(c_name, 256) AS digest",
)


@query(
    "H32_additive_measures",
    "SELECT l_suppkey, round(sum(l_extendedprice * l_discount) / sum(l_extendedprice), 6) AS discount_rate FROM lineitem GROUP BY 1",
)
def _(t):
    parts = t.lineitem.groupBy("l_suppkey").agg(F.sum(F.expr("l_extendedprice * l_discount")).alias("given"), F.sum("l_extendedprice").alias("gross"))
    return parts.select("l_suppkey", F.round(F.try_divide("given", "gross"), 6).alias("discount_rate"))


one("H33_string_concat", "n_nationkey, n_name || '-' || n_regionkey AS label", "nation", "n_nationkey", "n_name || '-' || n_regionkey AS label")
one("H34_string_length", "doc_id, length(text) AS n", "documents", "doc_id", "CAST(length(text) AS BIGINT) AS n")
one("H35_substring", "doc_id, substr(text, 1, 2) AS head", "documents", "doc_id", "substring(text, 1, 2) AS head")
one(
    "H36_current_time",
    "o_orderkey, CAST(current_date - CAST(o_orderdate AS DATE) AS INT) AS age",
    "orders",
    "o_orderkey",
    "datediff(current_date(), o_orderdate) AS age",
)
one("H37_add_days", "o_orderkey, CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS due", "orders", "o_orderkey", "date_add(to_date(o_orderdate), 10) AS due")
one(
    "H38_day_difference",
    f"o_orderkey, CAST(DATE '{ANCHOR}' - CAST(o_orderdate AS DATE) AS INT) AS age",
    "orders",
    "o_orderkey",
    f"datediff(DATE'{ANCHOR}', o_orderdate) AS age",
)
