"""Inputs the star schema lacks, derived row by row from its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.registry import Tables

LOG_STATUS = {"error": 500, "signup": 201, "purchase": 302}  # any other event type answers 200

CHANGE_SCHEMA = (
    "before struct<order_id: long, status: string, amount: double>, "
    "after struct<order_id: long, status: string, amount: double>, op string, ts_ms long, offset long"
)


def access_log(t: Tables) -> DataFrame:
    """One web-server log line per event."""
    status = F.lit(200)
    for kind, code in LOG_STATUS.items():
        status = F.when(F.col("event_type") == kind, code).otherwise(status)
    line = F.format_string(
        '10.0.%d.%d - - [%s +0000] "GET /%s/%s HTTP/1.1" %d %d',
        F.floor(F.col("user_id") / 256),
        F.pmod("user_id", F.lit(256)),
        F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss"),
        F.col("event_type"),
        F.get_json_object("props", "$.k"),
        status,
        F.floor(F.col("value") * 100 + 0.5),
    )
    return t.events.select(line.alias("value"))


LOG_SQL = """
    SELECT '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
           date_trunc('second', ts) AS ts, 'GET /' || event_type || '/' || (props ->> '$.k') || ' HTTP/1.1' AS request,
           CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 WHEN 'purchase' THEN 302 ELSE 200 END AS status,
           CAST(floor(value * 100 + 0.5) AS BIGINT) AS size
    FROM events
"""


def order_changes(t: Tables) -> DataFrame:
    """A change log of the orders: created as P, settled later, some deleted at the end."""
    o = t.orders.withColumn("ms", F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    image = "struct<order_id: long, status: string, amount: double>"
    created = F.struct(F.col("o_orderkey"), F.lit("P"), F.col("o_totalprice")).cast(image)
    settled = F.struct(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")).cast(image)
    none = F.lit(None).cast(image)

    def change(before, after, op: str, days: int):
        ms = F.col("ms") + days * 86_400_000
        return F.struct(before.alias("before"), after.alias("after"), F.lit(op).alias("op"), ms.alias("ts_ms"))

    steps = F.array(change(none, created, "c", 0), change(created, settled, "u", 1), change(settled, none, "d", 2))
    happened = F.array_compact(
        F.transform(
            steps,
            lambda s: F.when(
                (s.op == "c")
                | ((s.op == "u") & (F.col("o_orderstatus") != "P"))
                | ((s.op == "d") & (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")),
                s,
            ),
        )
    )
    rows = o.select("o_orderkey", F.posexplode(happened).alias("n", "c"))
    return rows.select("c.*", (F.col("o_orderkey") * 3 + F.col("n")).alias("offset"))


ORDER_STATE_SQL = """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount
    FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
"""


def message_text(changes: DataFrame) -> DataFrame:
    """Change rows as JSON text, the way a topic carries them."""
    return changes.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
