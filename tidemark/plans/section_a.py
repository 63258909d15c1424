"""A: sources, sinks and table publication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.changes import apply_changes
from tidemark.plans import derived
from tidemark.plans.registry import query
from tidemark.runtime import scratch_path
from tidemark.sources import external, files, publish
from tidemark.sources.tables import SCHEMAS
from tidemark.streaming.run import append_files, appended, each_batch, file_stream


@query(
    "A1_parquet_scan",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'""",
)
def _(t):
    year = (F.col("l_shipdate") >= "1997-01-01") & (F.col("l_shipdate") < "1998-01-01")
    return t.lineitem.filter(year).select("l_orderkey", "l_partkey", "l_quantity")


@query("A1_parquet_scan_whole", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "A2_parquet_by_sql_path",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1",
)
def _(t):
    return t.spark.sql(
        f"SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS amount "
        f"FROM parquet.`{t.path('orders')}` GROUP BY o_orderstatus"
    )


@query("A3_csv_scan", "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS top FROM customer GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "csv")
    files.export_csv(t.customer, path)
    rows = files.read_csv(t.spark, path, SCHEMAS["customer"])
    return rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.max("c_acctbal").alias("top"))


@query("A4_delimited_load", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(t):
    path = scratch_path(t.spark, "bar")
    files.export_csv(t.supplier, path, sep="|")
    return files.read_csv(t.spark, path, SCHEMAS["supplier"], sep="|")


@query(
    "A5_load_with_rejects",
    """SELECT CASE WHEN o_orderstatus = 'P' OR o_orderkey % 7 = 0 THEN 'rejected' ELSE 'loaded' END AS verdict, count(*) AS n,
              min(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END) AS first_key
       FROM orders GROUP BY 1""",
)
def _(t):
    path = scratch_path(t.spark, "dirty")
    # Amounts that are no number, and every seventh key with a letter in it.
    amount = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    key = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    files.export_csv(t.orders.select(key.alias("o_orderkey"), amount.alias("o_totalprice")), path)
    rows = files.read_with_rejects(t.spark, path, "o_orderkey long, o_totalprice double")
    verdict = F.when(F.col(files.CORRUPT).isNull(), "loaded").otherwise("rejected").alias("verdict")
    lost = F.split_part(F.col(files.CORRUPT), F.lit(","), F.lit(1)).try_cast("long")
    both = rows.select(verdict, F.when(F.col(files.CORRUPT).isNull(), F.col("o_orderkey")).otherwise(lost).alias("key"))
    return both.groupBy("verdict").agg(F.count("*").alias("n"), F.min("key").alias("first_key"))


@query(
    "A6_stage_cast_load",
    """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'rejected' ELSE 'loaded' END AS verdict, count(*) AS n
       FROM orders GROUP BY 1""",
)
def _(t):
    # Low-priority rows carry a day that no calendar has.
    day = F.when(F.col("o_orderpriority") == "5-LOW", "1997-02-30").otherwise(F.col("o_orderdate").cast("string"))
    staged = t.orders.select(F.col("o_orderkey").cast("string"), day.alias("o_orderdate"))
    checked = files.cast_staged(staged, {"o_orderkey": "long", "o_orderdate": "timestamp"})
    verdict = F.when(F.col("failed"), "rejected").otherwise("loaded").alias("verdict")
    return checked.groupBy(verdict).agg(F.count("*").alias("n"))


@query(
    "A7_export_csv",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, round(sum(o_totalprice), 2) AS gmv
       FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def _(t):
    path = scratch_path(t.spark, "export")
    daily = t.orders.filter("o_orderstatus = 'F'").groupBy(F.to_date("o_orderdate").alias("day"))
    files.export_csv(daily.agg(F.round(F.sum("o_totalprice"), 2).alias("gmv")), path)
    return files.read_csv(t.spark, path, "day date, gmv double")


@query(
    "A9_text_log_scan",
    f"""SELECT status, count(*) AS lines, CAST(sum(size) AS BIGINT) AS bytes FROM ({derived.LOG_SQL}) GROUP BY 1
        UNION ALL SELECT NULL, count(*), NULL FROM events WHERE event_type = 'error'""",
)
def _(t):
    path = scratch_path(t.spark, "log")
    # Each error also leaves a line that is no access record.
    noise = t.events.filter("event_type = 'error'").select(F.concat(F.lit("worker died: "), "event_id").alias("value"))
    derived.access_log(t).unionByName(noise).write.text(path)
    tail = r'" (\d{3}) (\d+)$'
    rows = files.read_lines(t.spark, path).select(
        F.regexp_extract("value", tail, 1).try_cast("int").alias("status"),
        F.regexp_extract("value", tail, 2).try_cast("long").alias("size"),
    )
    return rows.groupBy("status").agg(F.count("*").alias("lines"), F.sum("size").alias("bytes"))


@query(
    "A10_federated_join",
    """SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def _(t):
    csv, orc = scratch_path(t.spark, "customers"), scratch_path(t.spark, "nations")
    files.export_csv(t.customer, csv)
    files.write_columnar(t.nation, orc, "orc")
    people = files.read_csv(t.spark, csv, SCHEMAS["customer"]).select("c_custkey", "c_nationkey")
    nations = t.spark.read.schema(SCHEMAS["nation"]).orc(orc).select("n_nationkey", "n_name")
    joined = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("orders"))


@query(
    "A11_json_stream_source",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1
       UNION ALL SELECT 'rejected', count(*), NULL FROM events WHERE event_type = 'error'""",
)
def _(t):
    inbox = scratch_path(t.spark, "topic")
    sent = external.to_message(t.events.drop("props"), F.col("user_id")).select("value")
    torn = t.events.filter("event_type = 'error'").select(F.concat(F.lit('{"ts": "'), "event_id").alias("value"))
    sent.unionByName(torn).repartition(4).write.text(inbox)
    topic = file_stream(t.spark, inbox, "value string", "text", files_per_trigger=1)
    # No watermark: nothing is aggregated in the stream.
    stored = appended(external.parse_json_value(topic, "ts timestamp, event_type string, value double"), "topic_rows")
    kind = F.when(F.col("rejected").isNull(), F.col("event_type")).otherwise("rejected").alias("event_type")
    return stored.groupBy(kind).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("A12_change_stream_created", "SELECT o_orderkey AS order_id, 'P' AS status, o_totalprice AS amount FROM orders")
def _(t):
    inbox = scratch_path(t.spark, "changes")
    derived.message_text(derived.order_changes(t)).write.text(inbox)
    changes = external.parse_json_value(file_stream(t.spark, inbox, "value string", "text"), derived.CHANGE_SCHEMA)
    return appended(changes.filter("rejected IS NULL AND op = 'c'").select("after.*"), "created")


@query("A13_message_sink", "SELECT user_id AS key, count(*) AS messages, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t):
    stream = file_stream(t.spark, t.path("events"), SCHEMAS["events"])
    sent = appended(external.to_message(stream.select("user_id", "value"), F.col("user_id")), "sink")
    value = F.get_json_object("value", "$.value").cast("double")
    return sent.groupBy(F.col("key").cast("long").alias("key")).agg(
        F.count("*").alias("messages"), F.round(F.sum(value), 2).alias("total")
    )


@query("A14_serving_store_sink", derived.ORDER_STATE_SQL)
def _(t):
    inbox, root = scratch_path(t.spark, "changes"), scratch_path(t.spark, "serving")
    derived.order_changes(t).repartition(4).write.parquet(inbox)
    empty = t.spark.createDataFrame([], "order_id long, status string, amount double")
    store = publish.DeltaStore(
        t.spark, f"{root}/table", derived.CHANGE_SCHEMA, lambda log: apply_changes(empty, log, ["order_id"])
    )
    stream = file_stream(t.spark, inbox, derived.CHANGE_SCHEMA, files_per_trigger=1)
    each_batch(stream, store.add, f"{root}/checkpoint")
    return store.read()


@query(
    "A15_stream_parquet_sink",
    "SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n FROM events GROUP BY 1, 2",
)
def _(t):
    root = scratch_path(t.spark, "lake")
    rows = file_stream(t.spark, t.path("events"), SCHEMAS["events"]).withColumn("dt", F.to_date("ts"))
    stored = append_files(rows, f"{root}/events", f"{root}/checkpoint", ["dt"])
    return stored.groupBy("event_type", "dt").agg(F.count("*").alias("n"))


@query(
    "A16_partitioned_overwrite",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt, count(*) AS n,
              sum(CASE WHEN year(o_orderdate) % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS rewritten FROM orders GROUP BY 1""",
)
def _(t):
    path = scratch_path(t.spark, "by_year")
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("dt"), F.year("o_orderdate").alias("y"))
    files.write_partitioned(dated.withColumn("rewritten", F.lit(0)), path, ["y"])
    even = dated.filter("y % 2 = 0").withColumn("rewritten", F.lit(1))
    files.overwrite_touched(even, path, ["y"])
    kept = t.spark.read.schema("o_orderkey long, dt date, rewritten int, y int").parquet(path)
    return kept.groupBy("dt").agg(F.count("*").alias("n"), F.sum("rewritten").alias("rewritten"))


@query("A17_append_write", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "append")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    first = F.coalesce(F.col("o_orderkey") % 2 == 0, F.lit(False))  # two extracts that make up the whole
    for extract in (first, ~first):
        rows.filter(extract).write.mode("append").parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "A18_orc_and_codecs",
    """SELECT c.codec, count(*) AS n, round(sum(p_retailprice), 2) AS total
       FROM part, (VALUES ('orc_zlib'), ('parquet_snappy'), ('parquet_zstd')) c(codec) GROUP BY 1""",
)
def _(t):
    parts = None
    for fmt, codec in (("orc", "zlib"), ("parquet", "snappy"), ("parquet", "zstd")):
        path = scratch_path(t.spark, codec)
        files.write_columnar(t.part, path, fmt, codec)
        rows = t.spark.read.format(fmt).load(path).withColumn("codec", F.lit(f"{fmt}_{codec}"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.groupBy("codec").agg(F.count("*").alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total"))


@query(
    "A20_insert_select",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 0",
)
def _(t):
    name = publish.unique_name("paid_orders")
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE) "
        f"USING parquet LOCATION '{scratch_path(t.spark, name)}'"
    )
    t.spark.sql(
        f"INSERT INTO {name} SELECT o_orderkey, o_custkey, o_totalprice FROM {{src}} "
        "WHERE o_orderstatus = 'F' AND o_totalprice > 0",
        src=t.orders,
    )
    return t.spark.table(name)


@query(
    "A21_partitioned_table_load",
    "SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n FROM orders GROUP BY 1",
)
def _(t):
    name = publish.unique_name("orders_by_year")
    t.spark.sql(
        f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE, y INT) "
        f"USING orc PARTITIONED BY (y) LOCATION '{scratch_path(t.spark, name)}'"
    )
    t.spark.sql(
        f"INSERT INTO {name} PARTITION (y) SELECT /*+ REBALANCE(y) */ o_orderkey, o_totalprice, y FROM {{src}}",
        src=t.orders.withColumn("y", F.year("o_orderdate")),
    )
    return t.spark.table(name).groupBy("y").agg(F.count("*").alias("n"))


@query(
    "A22_create_table_as_select",
    """SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS spent
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def _(t):
    summary = t.orders.filter("o_orderstatus <> 'P'").groupBy("o_custkey")
    built = summary.agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return publish.save_table(built, publish.unique_name("customer_spend"))


@query("A23_view", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def _(t):
    name = publish.unique_name("solvent")
    t.customer.filter("c_acctbal > 0").createOrReplaceTempView(name)
    return t.spark.table(name).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "A24_temp_view_sql",
    "SELECT p_brand, count(*) AS n, max(p_retailprice) AS top FROM part GROUP BY p_brand HAVING count(*) > 10",
)
def _(t):
    t.register("part")
    return t.spark.sql(
        "SELECT p_brand, count(*) AS n, max(p_retailprice) AS top FROM part GROUP BY p_brand HAVING count(*) > 10"
    )


def monthly(rows):
    """GMV by month; the year is the period that is rewritten together."""
    by = rows.groupBy("year", "day")
    return by.agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("gmv"))


def summary_of(t) -> publish.StoredSummary:
    schema = "year int, day date, orders long, gmv double"
    return publish.StoredSummary(t.spark, scratch_path(t.spark, "summary"), "year", schema, monthly)


MONTHLY_SQL = """SELECT CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS day, count(*) AS orders,
                        round(sum(o_totalprice), 2) AS gmv FROM orders GROUP BY 1"""


@query("A25_summary_full_refresh", MONTHLY_SQL)
def _(t):
    year = F.coalesce(F.year("o_orderdate"), F.lit(0))
    source = t.orders.withColumns({"day": F.trunc("o_orderdate", "month"), "year": year})
    summary = summary_of(t)
    summary.refresh(source)
    return summary.read().select("day", "orders", "gmv")


@query("A26_summary_incremental_refresh", MONTHLY_SQL)
def _(t):
    year = F.coalesce(F.year("o_orderdate"), F.lit(0))
    rows = t.orders.select("o_orderstatus", "o_totalprice", F.trunc("o_orderdate", "month").alias("day"), year.alias("year"))
    path = scratch_path(t.spark, "orders_by_year")
    files.write_partitioned(rows, path, ["year"])  # so that a late batch reads the years it touches
    source = t.spark.read.schema(rows.schema).parquet(path)
    late = F.coalesce(F.col("o_orderstatus") == "P", F.lit(False))
    summary = summary_of(t)
    summary.refresh(source.filter(~late))
    summary.refresh_touched(source, source.filter(late))
    return summary.read().select("day", "orders", "gmv")


@query(
    "A27_summing_rollup_on_arrival",
    "SELECT user_id, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2",
)
def _(t):
    root, inbox = scratch_path(t.spark, "rollup"), scratch_path(t.spark, "arrivals")
    t.events.repartition(4).write.parquet(inbox)
    keys = ["user_id", "event_type"]
    store = publish.DeltaStore(
        t.spark,
        f"{root}/table",
        "user_id long, event_type string, n long, total double",
        lambda rows: publish.merge_partials(rows, keys, ["n", "total"]),
    )

    def add(rows, batch_id):
        store.add(rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")), batch_id)
        if batch_id == 1:
            store.compact(batch_id)

    each_batch(file_stream(t.spark, inbox, SCHEMAS["events"], files_per_trigger=1), add, f"{root}/checkpoint")
    return store.read().withColumn("total", F.round("total", 2))


@query("A28_layered_namespace", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    lake = publish.LayerPaths(scratch_path(t.spark, "layers"))
    raw = lake.write(t.orders, "raw", "orders")
    silver = lake.write(raw.select("o_orderkey", "o_orderpriority", "o_orderstatus"), "silver", "orders")
    by = silver.groupBy("o_orderpriority", "o_orderstatus")
    return lake.write(by.agg(F.count("*").alias("n")), "gold", "by_priority")
