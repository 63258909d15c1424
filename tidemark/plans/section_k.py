"""K: data quality checks, catalogue and policy jobs. Each check is one pass over its table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.plans.section_d import mean
from tidemark.plans.section_main import date_spine
from tidemark.sources.tables import SCHEMAS

#: Orders with faults put in: every eleventh amount and every thirteenth status is missing, every seventeenth amount negative.
DIRTY = """(SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS status,
            CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
            CAST(o_orderdate AS DATE) AS day FROM orders)"""


def dirty(t):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return t.orders.select(
        key,
        "o_custkey",
        F.when(key % 13 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 11 == 0, None).when(key % 17 == 0, -price).otherwise(price).alias("amount"),
        F.to_date("o_orderdate").alias("day"),
    )


@query("K1_null_counts", f"SELECT count(*) AS n, count(*) - count(status) AS status, count(*) - count(amount) AS amount FROM {DIRTY}")
def _(t):
    return dirty(t).agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in ("status", "amount")))


@query(
    "K2_null_ratio_gate",
    f"""SELECT c AS name, round(r, 6) AS ratio, r <= 0.08 AS passed FROM (SELECT 'status' AS c, 1 - count(status) / count(*) AS r FROM {DIRTY}
        UNION ALL SELECT 'amount', 1 - count(amount) / count(*) FROM {DIRTY})""",
)
def _(t):
    ratio = lambda c: (1 - F.count(c) / F.count("*")).alias(c)
    wide = dirty(t).agg(ratio("status"), ratio("amount"))
    return wide.unpivot([], ["status", "amount"], "name", "r").select("name", F.round("r", 6).alias("ratio"), (F.col("r") <= 0.08).alias("passed"))


@query("K3_row_count_range", "SELECT count(*) AS n, count(*) BETWEEN 100 AND 100000000 AS passed FROM orders")
def _(t):
    return t.orders.agg(F.count("*").alias("n"), F.count("*").between(100, 100000000).alias("passed"))


@query("K4_rows_by_day", f"SELECT CAST(day AS VARCHAR) AS day, count(*) AS n FROM {DIRTY} GROUP BY 1")
def _(t):
    return dirty(t).groupBy("day").agg(F.count("*").alias("n"))


@query(
    "K5_missing_days",
    f"""WITH d AS (SELECT DISTINCT status, day FROM {DIRTY} WHERE status IS NOT NULL AND day IS NOT NULL),
        s AS (SELECT status, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY 1)
        SELECT status, CAST(day AS VARCHAR) AS day FROM s ANTI JOIN d USING (status, day)""",
)
def _(t):
    """Days between the first and the last of a status on which it has no order."""
    days = dirty(t).select("status", "day").filter("status IS NOT NULL AND day IS NOT NULL").distinct()
    spine = days.groupBy("status").agg(F.explode(F.sequence(F.min("day"), F.max("day"))).alias("day"))
    return spine.join(days, ["status", "day"], "left_anti")


@query(
    "K6_value_ranges",
    f"SELECT count(*) FILTER (WHERE amount < 0) AS negative, count(*) FILTER (WHERE amount > 400000) AS huge, count(*) FILTER (WHERE amount IS NULL) AS missing FROM {DIRTY}",
)
def _(t):
    a = F.col("amount")
    return dirty(t).agg(F.count_if(a < 0).alias("negative"), F.count_if(a > 400000).alias("huge"), F.count_if(a.isNull()).alias("missing"))


@query("K7_key_format", "SELECT count(*) AS n, count(*) FILTER (WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]{2}')) AS bad FROM part")
def _(t):
    return t.part.agg(F.count("*").alias("n"), F.count_if(~F.col("p_brand").rlike("^Brand#[0-9]{2}$")).alias("bad"))


@query(
    "K8_cross_column",
    "SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate OR (l_returnflag = 'N' AND l_linestatus = 'F')",
)
def _(t):
    wrong = F.expr("l_shipdate < o_orderdate OR (l_returnflag = 'N' AND l_linestatus = 'F')")
    return t.lineitem.join(t.orders, F.expr("l_orderkey = o_orderkey")).filter(wrong).agg(F.count("*").alias("n"))


@query(
    "K9_detail_vs_summary",
    """WITH d AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS items FROM lineitem GROUP BY 1)
       SELECT count(*) AS orders, count(*) FILTER (WHERE items IS NULL) AS no_items, count(*) FILTER (WHERE abs(items - o_totalprice) > 0.01) AS off FROM orders LEFT JOIN d ON l_orderkey = o_orderkey""",
)
def _(t):
    d = t.lineitem.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("items"))
    both = t.orders.join(d, F.expr("l_orderkey = o_orderkey"), "left")
    return both.agg(
        F.count("*").alias("orders"), F.count_if(F.col("items").isNull()).alias("no_items"), F.count_if(F.abs(F.col("items") - F.col("o_totalprice")) > 0.01).alias("off")
    )


@query("K10_duplicate_keys", "SELECT user_id, ts, count(*) AS n FROM (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS ts FROM events) GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("ts")).agg(F.count("*").alias("n")).filter("n > 1")


@query("K11_duplicate_ratio", "SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_partkey)) AS keys, round(1 - count(DISTINCT (l_orderkey, l_partkey)) / count(*), 6) AS ratio FROM lineitem")
def _(t):
    keys = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count("*").alias("n"))
    return keys.agg(F.sum("n").alias("n"), F.count("*").alias("keys"), F.round(1 - F.count("*") / F.sum("n"), 6).alias("ratio"))


@query("K12_freshness", "SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last, CAST(DATE '2000-01-01' - max(CAST(ts AS DATE)) AS INT) AS age FROM events")
def _(t):
    last = F.max(F.to_date("ts"))
    return t.events.agg(last.alias("last"), F.datediff(F.lit("2000-01-01").cast("date"), last).alias("age"))


#: (name, severity, condition that a good row meets); all are evaluated in one pass.
RULES = (
    ("status_set", "high", "status IS NOT NULL"),
    ("amount_set", "high", "amount IS NOT NULL"),
    ("amount_positive", "medium", "coalesce(amount >= 0, true)"),
    ("amount_plausible", "low", "coalesce(amount <= 400000, true)"),
)


def rule_counts(t):
    """A row per rule: rows checked and rows that break it."""
    wide = dirty(t).agg(F.count("*").alias("n"), *(F.count_if(~F.expr(c)).alias(name) for name, _, c in RULES))
    long = wide.unpivot(["n"], [name for name, _, _ in RULES], "rule", "bad")
    severity = F.create_map(*(F.lit(x) for name, s, _ in RULES for x in (name, s)))
    return long.select("rule", severity[F.col("rule")].alias("severity"), "n", "bad")


RULE_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, '{s}' AS severity, count(*) AS n, count(*) FILTER (WHERE NOT ({c})) AS bad FROM {DIRTY}" for name, s, c in RULES
)


@query("K13_quality_score", f"SELECT round(100 * (1 - sum(bad) / sum(n)), 4) AS score FROM ({RULE_SQL})")
def _(t):
    return rule_counts(t).agg(F.round(100 * (1 - F.sum("bad") / F.sum("n")), 4).alias("score"))


@query("K14_rule_runner", RULE_SQL)
def _(t):
    return rule_counts(t)


@query(
    "K15_report_rollup",
    f"SELECT severity, count(*) AS rules, CAST(sum(bad) AS BIGINT) AS bad, count(*) FILTER (WHERE bad > 0) AS failing FROM ({RULE_SQL}) GROUP BY ROLLUP (severity)",
)
def _(t):
    by = rule_counts(t).rollup("severity")
    return by.agg(F.count("*").alias("rules"), F.sum("bad").alias("bad"), F.count_if(F.col("bad") > 0).alias("failing"))


@query("K16_top_failing_rules", f"SELECT rule, bad FROM ({RULE_SQL}) ORDER BY bad DESC, rule LIMIT 3")
def _(t):
    """A top list; the limit is the feature."""
    return rule_counts(t).orderBy(F.desc("bad"), "rule").limit(3).select("rule", "bad")


@query("K17_not_null_test", f"SELECT o_orderkey FROM {DIRTY} WHERE status IS NULL OR amount IS NULL")
def _(t):
    return dirty(t).filter("status IS NULL OR amount IS NULL").select("o_orderkey")


@query(
    "K18_drop_against_week",
    f"""WITH d AS (SELECT day, count(*) AS n FROM {DIRTY} GROUP BY 1), s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d),
        f AS (SELECT s.day, coalesce(n, 0) AS n FROM s LEFT JOIN d USING (day)), w AS (SELECT day, n, avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean FROM f)
        SELECT CAST(day AS VARCHAR) AS day, n, round(mean, 4) AS mean FROM w WHERE n < 0.5 * mean""",
)
def _(t):
    days = dirty(t).groupBy("day").agg(F.count("*").alias("n"))
    week = Window.orderBy("day").rowsBetween(-7, -1)  # over a row for each day
    rows = date_spine(days).join(days, "day", "left").fillna(0, ["n"]).withColumn("mean", F.avg("n").over(week))
    return rows.filter("n < 0.5 * mean").select("day", "n", F.round("mean", 4).alias("mean"))


@query(
    "K19_source_vs_target",
    f"""SELECT s.status, s.n AS source, coalesce(t.n, 0) AS target, s.n - coalesce(t.n, 0) AS lost FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1) s
        LEFT JOIN (SELECT status, count(*) AS n FROM {DIRTY} WHERE amount IS NOT NULL GROUP BY 1) t ON t.status = s.status""",
)
def _(t):
    source = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("source"))
    target = dirty(t).filter("amount IS NOT NULL").groupBy("status").agg(F.count("*").alias("target"))
    both = source.join(target, "status", "left").fillna(0, ["target"])
    return both.withColumn("lost", F.col("source") - F.col("target"))


REASON = "CASE WHEN status IS NULL THEN 'no status' WHEN amount IS NULL THEN 'no amount' WHEN amount < 0 THEN 'negative' END"


def judged(t):
    a = F.col("amount")
    reason = F.when(F.col("status").isNull(), "no status").when(a.isNull(), "no amount").when(a < 0, "negative")
    return dirty(t).withColumn("reason", reason)


@query("K20_validation_with_rejects", f"SELECT coalesce({REASON}, 'good') AS verdict, count(*) AS n FROM {DIRTY} GROUP BY 1")
def _(t):
    return judged(t).groupBy(F.coalesce("reason", F.lit("good")).alias("verdict")).agg(F.count("*").alias("n"))


@query("K21_error_statistics", f"SELECT strftime(day, '%Y-%m') AS month, {REASON} AS reason, count(*) AS n FROM {DIRTY} WHERE {REASON} IS NOT NULL GROUP BY 1, 2")
def _(t):
    return judged(t).filter("reason IS NOT NULL").groupBy(F.date_format("day", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("n"))


@query(
    "K22_run_time_trend",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS job, round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) + 1e-9, 4) AS mean, max(value) AS slowest FROM events GROUP BY 1, 2""",
)
def _(t):
    by = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("job"))
    return by.agg(mean("value").alias("mean"), F.max("value").alias("slowest"))


@query(
    "K23_query_log",
    "SELECT user_id, count(*) AS n, count(*) FILTER (WHERE value > 100) AS slow, round(quantile_cont(value, 0.95), 4) AS p95 FROM events GROUP BY 1",
)
def _(t):
    v = F.col("value")
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(v > 100).alias("slow"), F.round(F.percentile(v, 0.95), 4).alias("p95"))


@query(
    "K26_field_catalogue",
    " UNION ALL ".join(
        f"SELECT '{table}' AS name, '{f.split()[0]}' AS field, count(*) AS n, count({f.split()[0]}) AS filled FROM {table}"
        for table in SCHEMAS
        for f in SCHEMAS[table].split(", ")
    ),
)
def _(t):
    def fields(name):
        df = getattr(t, name)
        wide = df.agg(F.count("*").alias("n"), *(F.count(c).alias(c) for c in df.columns))
        return wide.unpivot(["n"], df.columns, "field", "filled").select(F.lit(name).alias("name"), "field", "n", "filled")

    found = fields("region")
    for name in [n for n in SCHEMAS if n != "region"]:
        found = found.unionByName(fields(name))
    return found


@query("K29_row_policy", "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def _(t):
    granted = t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("c_nationkey"))  # the user's nations
    allowed = t.customer.join(granted, "c_nationkey", "left_semi").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(allowed, "o_custkey", "left_semi").select("o_orderkey")


@query(
    "K30_column_mask",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE left(c_name, 2) || '***' END AS name, sha256(c_name) AS token FROM customer",
)
def _(t):
    shown = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.concat(F.left("c_name", F.lit(2)), F.lit("***")))
    return t.customer.select("c_custkey", shown.alias("name"), F.sha2("c_name", 256).alias("token"))


EMAIL, PHONE = r"[A-Za-z0-9._]+@[A-Za-z0-9]+\.[A-Za-z.]+", r"\+?[0-9][0-9 ()-]{8,}[0-9]"


@query(
    "K31_sensitivity_scan",
    f"""SELECT lang, count(*) FILTER (WHERE regexp_matches(text, '{EMAIL}')) AS mail, count(*) FILTER (WHERE regexp_matches(text, '{PHONE}')) AS phone, count(*) AS n FROM documents GROUP BY 1""",
)
def _(t):
    hit = lambda pattern: F.count_if(F.col("text").rlike(pattern))
    return t.documents.groupBy("lang").agg(hit(EMAIL).alias("mail"), hit(PHONE).alias("phone"), F.count("*").alias("n"))


@query("K32_chunk_acl", "SELECT doc_id FROM documents WHERE source IN (SELECT DISTINCT 'src' || s_nationkey FROM supplier WHERE s_acctbal > 0)")
def _(t):
    scopes = t.supplier.filter("s_acctbal > 0").select(F.concat(F.lit("src"), F.col("s_nationkey").cast("string")).alias("source"))
    return t.documents.join(scopes, "source", "left_semi").select("doc_id")
