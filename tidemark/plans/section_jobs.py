"""J and M: jobs that keep state in stored tables, and functions of one's own."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from tidemark.operators import changes, jobs, layout, search
from tidemark.plans.registry import query
from tidemark.runtime import materialise, scratch_path
from tidemark.sources.tables import SCHEMAS
from tidemark.streaming.run import appended, event_stream

CENTS = "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT)"


def cents(column="o_totalprice"):
    return F.sum(F.round(F.col(column) * 100).cast("long"))


@query("J9_incremental_model", f"SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, {CENTS} AS cents FROM orders GROUP BY 1")
def _(t):
    """Yearly sums from what had come by mid 1998, brought up to date with the later orders, and run once more in vain."""
    source = t.orders.select("o_orderdate", "o_totalprice", F.year("o_orderdate").alias("year"))
    model = jobs.IncrementalModel(t.spark, scratch_path(t.spark, "model"), "year", "o_orderdate", lambda rows: rows.groupBy("year").agg(F.count("*").alias("n"), cents().alias("cents")))
    for seen in (source.filter("o_orderdate < DATE'1998-06-01'"), source, source):
        model.run(seen)
    return model.read("year int, n long, cents long")


LEVELS = "CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END"


@query(
    "J18_scd2_load",
    f"""SELECT c_custkey, c_mktsegment AS segment, {LEVELS} AS level, DATE '2024-01-01'::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to, 1 AS version, true AS is_current
        FROM customer WHERE c_nationkey % 2 = 1 AND c_acctbal >= 0
        UNION ALL SELECT c_custkey, c_mktsegment, {LEVELS}, '2024-01-01', '2024-02-01', 1, false FROM customer WHERE c_nationkey % 2 = 1 AND c_acctbal < 0
        UNION ALL SELECT c_custkey, c_mktsegment, 'mid', '2024-02-01', NULL, 2, true FROM customer WHERE c_nationkey % 2 = 1 AND c_acctbal < 0
        UNION ALL SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'mid' ELSE {LEVELS} END, '2024-02-01', NULL, 1, true FROM customer WHERE c_nationkey % 2 = 0""",
)
def _(t):
    """Half of the customers, then all with the low level lifted: changed rows get version 2, new ones version 1, others stay."""
    first = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.expr(LEVELS).alias("level"), "c_nationkey")
    empty = t.spark.createDataFrame([], "c_custkey long, segment string, level string, valid_from string, valid_to string, version int, is_current boolean")
    load = lambda target, rows, day: jobs.load_versions(target, rows, ["c_custkey"], ["segment", "level"], F.lit(day))
    once = load(empty, first.filter("c_nationkey % 2 = 1"), "2024-01-01")
    return load(once, first.withColumn("level", F.when(F.col("level") == "low", "mid").otherwise(F.col("level"))), "2024-02-01")


@query(
    "J20_versioned_update",
    """WITH c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
       SELECT user_id, event_type, ts::VARCHAR[1:19] AS valid_from, (lead(ts) OVER w)::VARCHAR[1:19] AS valid_to, lead(ts) OVER w IS NULL AS is_current
       FROM c WHERE before IS NULL OR before <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""".replace("ts::VARCHAR[1:19]", "strftime(ts, '%Y-%m-%d %H:%M:%S')").replace("(lead(ts) OVER w)::VARCHAR[1:19]", "strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S')"),
)
def _(t):
    """The kind of each user's last event, as rows that are valid from one change to the next."""
    rows = jobs.validity(t.events, "user_id", "event_type", "ts", "event_id")
    second = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return rows.select("user_id", "event_type", second("valid_from"), second("valid_to"), "is_current")


@query(
    "J29_status_snapshots",
    "SELECT o_orderkey, 3 AS snapshots, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 2, 'P' FROM orders WHERE o_orderstatus = 'P'",
)
def _(t):
    """Each change is appended and none rewritten; the newest row of an order is its state."""
    path = scratch_path(t.spark, "snapshots")
    steps = (F.lit("created"), F.lit("P"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")))
    for n, status in enumerate(steps):
        t.orders.select("o_orderkey", status.alias("status"), F.lit(n).alias("at")).filter("status IS NOT NULL").write.mode("append").parquet(path)
    rows = t.spark.read.schema("o_orderkey long, status string, at int").parquet(path)
    newest = jobs.latest_status(rows, "o_orderkey", "at").select("o_orderkey", "status")
    return rows.groupBy("o_orderkey").agg(F.count("*").cast("int").alias("snapshots")).join(newest, "o_orderkey")


@query(
    "J31_daily_metric_job",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, * FROM orders), days AS (SELECT DISTINCT d FROM o ORDER BY d DESC LIMIT 2),
        m AS (SELECT CAST(d AS VARCHAR) AS day, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS c, count(DISTINCT o_custkey) AS u,
              CASE WHEN d = (SELECT max(d) FROM days) THEN 2 ELSE 1 END AS runs FROM o WHERE d IN (SELECT d FROM days) GROUP BY d)
        SELECT day, 'orders' AS metric, n::DOUBLE AS value, runs FROM m UNION ALL SELECT day, 'cents', c::DOUBLE, runs FROM m
        UNION ALL SELECT day, 'buyers', u::DOUBLE, runs FROM m UNION ALL SELECT day, 'cents_per_order', c::DOUBLE / n, runs FROM m""",
)
def _(t):
    """The last two days and the last one again: its partition is replaced, and the log tells of both runs."""

    def atomic(rows):
        wide = rows.agg(F.count("*").alias("orders"), cents().alias("cents"), F.countDistinct("o_custkey").alias("buyers"))
        return wide.unpivot([], ["orders", "cents", "buyers"], "metric", "value")

    job = jobs.DailyMetrics(t.spark, scratch_path(t.spark, "daily"), atomic, {"cents_per_order": ("cents", "orders")})
    last = t.orders.select(F.to_date("o_orderdate").cast("string").alias("day")).distinct().orderBy(F.desc("day")).limit(2).collect()
    days = [r["day"] for r in last]
    for day in [*days, *days[:1]]:
        job.run(t.orders, day, "o_orderdate")
    runs = job.runs().groupBy("day").agg(F.count("*").cast("int").alias("runs"))
    return job.metrics().join(runs, "day").select("day", "metric", "value", "runs")


def large_purchases(events):
    """The logic of J36: columns in, columns out, whatever brings the rows."""
    return events.filter("event_type = 'purchase' AND value > 50").select("event_id", "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))


@query(
    "J36_one_logic",
    "SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) AS cents, b.origin FROM events, (VALUES ('batch'), ('stream')) b(origin) WHERE event_type = 'purchase' AND value > 50",
)
def _(t):
    """One function over a batch read and over a stream."""
    batch = large_purchases(t.events).withColumn("origin", F.lit("batch"))
    stream = appended(large_purchases(event_stream(t.spark, t.path("events"), SCHEMAS["events"], "ts")), "one_logic")
    return batch.union(stream.withColumn("origin", F.lit("stream")))


@query("J37_als_recommender")
def _(t):
    """Three parts for each customer by alternating least squares over what was bought, as implicit ratings."""
    bought = t.orders.join(t.lineitem, F.expr("l_orderkey = o_orderkey")).groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    ids = bought.select(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item"), F.col("quantity").cast("float").alias("rating"))
    model = ALS(rank=8, maxIter=4, implicitPrefs=True, seed=3).fit(ids)
    users, items = (materialise(search.vectors(f, "id", "features"), "factors") for f in (model.userFactors, model.itemFactors))
    found = search.largest_products(items, users, 3)
    return found.select(F.col("query_id").cast("int").alias("user"), "rank", F.col("id").cast("int").alias("item"))


@query("J40_partition_expiry", "SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 2 FROM orders) GROUP BY 1")
def _(t):
    """The table as published without the years before the last three."""
    newest = t.orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    return jobs.without_expired(rows, "year", F.lit((newest or 0) - 2)).groupBy("year").agg(F.count("*").alias("n"))


@query(
    "J41_tiered_archive",
    """WITH a AS (SELECT CAST((SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - CAST(o_orderdate AS DATE) AS INT) AS age FROM orders)
       SELECT CASE WHEN age < 365 THEN 'hot' WHEN age < 1460 THEN 'warm' ELSE 'cold' END AS tier, count(*) AS n, min(age) AS youngest, max(age) AS oldest FROM a GROUP BY 1""",
)
def _(t):
    """Orders by age into three folders with a codec each, read back from them."""
    last = t.orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]
    rows = t.orders.select("o_orderkey", F.datediff(F.lit(last), F.to_date("o_orderdate")).alias("age"))
    folders = jobs.archive(rows, scratch_path(t.spark, "tiers"), F.col("age"))
    found = [t.spark.read.schema(rows.schema).parquet(path).withColumn("tier", F.lit(tier)) for tier, path in folders.items()]
    whole = found[0].union(found[1]).union(found[2])
    return whole.groupBy("tier").agg(F.count("*").alias("n"), F.min("age").alias("youngest"), F.max("age").alias("oldest"))


@query("J43_z_order", "SELECT l_partkey, l_suppkey, l_orderkey FROM lineitem WHERE l_partkey BETWEEN 20 AND 40 UNION ALL SELECT l_partkey, l_suppkey, l_orderkey FROM lineitem WHERE l_suppkey = 3")
def _(t):
    """Rows by either of two columns from files that hold a box of both."""
    rows, path = t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey"), scratch_path(t.spark, "z_order")
    layout.write_z_ordered(rows, path, ["l_partkey", "l_suppkey"], 16)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.filter("l_partkey BETWEEN 20 AND 40").union(stored.filter("l_suppkey = 3"))


@query("M1_scalar_function", "SELECT doc_id, strip_accents(substr(lower(coalesce(text, '')), 1, 40)) AS plain FROM documents WHERE lang IN ('es', 'de', 'fr', 'en')")
def _(t):
    """Letters without their accents, which no built-in function gives, in Arrow batches."""

    @F.pandas_udf("string")
    def plain(text: pd.Series) -> pd.Series:
        return text.map(lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if not unicodedata.combining(c)))

    head = F.substring(F.lower(F.coalesce("text", F.lit(""))), 1, 40)
    return t.documents.filter("lang IN ('es', 'de', 'fr', 'en')").select("doc_id", plain(head).alias("plain"))


@query("M2_filter_function", "SELECT event_id FROM events WHERE value > 0 AND event_type <> 'error'")
def _(t):
    """A predicate as a function of columns, used where a filter is."""

    def good(value, kind):
        return (F.col(value) > 0) & (F.col(kind) != "error")

    return t.events.filter(good("value", "event_type")).select("event_id")


@query(
    "M3_aggregate_class",
    """WITH r AS (SELECT l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem)
       SELECT l_suppkey, round(CAST(sum(c) AS DOUBLE) / count(*), 4) AS trimmed FROM r WHERE i > n // 10 AND i <= n - n // 10 GROUP BY 1""",
)
def _(t):
    """A mean without the tenth at either end, which no built-in aggregate gives: counts by value first, then the function
    sees each different value of a supplier once."""

    @F.pandas_udf("double")
    def trimmed(value: pd.Series, n: pd.Series) -> float:
        order = value.argsort(kind="stable")
        value, n = value.iloc[order].to_numpy(), n.iloc[order].to_numpy()
        total, cut = int(n.sum()), int(n.sum()) // 10
        upto = n.cumsum()
        kept = upto.clip(cut, total - cut) - (upto - n).clip(cut, total - cut)
        return float(sum(int(v) * int(k) for v, k in zip(value, kept)) / kept.sum())

    counts = t.lineitem.groupBy("l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("c")).agg(F.count("*").alias("n"))
    return counts.groupBy("l_suppkey").agg(F.round(trimmed("c", "n"), 4).alias("trimmed"))


@query(
    "M4_table_function",
    """SELECT o_orderkey, CAST(k AS INT) AS part, o_cents // 3 + CASE WHEN k <= o_cents % 3 THEN 1 ELSE 0 END AS cents
       FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS o_cents, unnest(range(1, 4)) AS k FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(t):
    """A function that returns a table: an order's price in three instalments that add up to it."""

    @F.udtf(returnType="part int, cents long")
    class Instalments:
        def eval(self, total: int, n: int):
            for k in range(1, n + 1):
                yield k, total // n + (1 if k <= total % n else 0)

    t.spark.udtf.register("instalments", Instalments)
    t.register("orders")
    return t.spark.sql(
        """SELECT o_orderkey, part, cents FROM orders, LATERAL instalments(CAST(round(o_totalprice * 100) AS LONG), 3)
           WHERE o_orderpriority = '1-URGENT'"""
    )


@query("M5_partition_function", "SELECT l_suppkey, count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY 1")
def _(t):
    """A function over whole partitions: each sends one row a supplier, and the sums are made from these."""

    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for key, rows in batch.groupby("l_suppkey")["l_quantity"]:
                one = held.setdefault(int(key), [0, float("-inf")])
                one[0], one[1] = one[0] + len(rows), max(one[1], float(rows.max()))
        yield pd.DataFrame([(k, n, m) for k, (n, m) in held.items()], columns=["l_suppkey", "n", "most"])

    some = t.lineitem.select("l_suppkey", "l_quantity").mapInPandas(partials, "l_suppkey long, n long, most double")
    return some.groupBy("l_suppkey").agg(F.sum("n").alias("n"), F.max("most").alias("most"))


@query(
    "M6_row_trigger",
    "SELECT l_orderkey, l_linenumber, CASE WHEN p_retailprice > 1500 THEN upper(p_name) ELSE p_name END AS name FROM lineitem JOIN part ON p_partkey = l_partkey",
)
def _(t):
    """A changed name goes to all the lines that copied it: as a join job over the changed parts."""
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("name")), "l_partkey")
    renamed = t.part.filter("p_retailprice > 1500").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_name").alias("name"))
    return changes.update_columns(lines, renamed, ["l_partkey"], ["name"]).select("l_orderkey", "l_linenumber", "name")
