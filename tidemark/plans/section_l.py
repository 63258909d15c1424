"""L: event-time streams.

`replayed` brings a table as a stream in several micro-batches with a closing row, so that in append mode the watermark
closes every window and clears its state. Each stream is run to the end of its input and its result table read.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.runtime import scratch_path
from tidemark.sources.tables import SCHEMAS
from tidemark.streaming import state
from tidemark.streaming.run import append_files, appended, each_batch, event_stream, file_stream, final_state, replay, replayed, routed

HOUR, DAY = 3_600_000, 86_400_000
#: The closing rows pass every filter of this module.
CLOSING = tuple({"event_type": kind, "value": 1e9, "user_id": -1, "event_id": -1} for kind in ("click", "error", "purchase"))


def whole(t, delay="1 hour"):
    """The events in one micro-batch."""
    return event_stream(t.spark, t.path("events"), SCHEMAS["events"], "ts", delay)


def events(t, delay="1 hour", **how):
    return replayed(t.events, "events", "ts", delay, closing=CLOSING, **how)


def windowed(t, width, slide=None, *by, delay="1 hour", **how):
    rows = events(t, delay, **how).filter("ts IS NOT NULL")
    return rows.groupBy(F.window("ts", width, slide) if slide else F.window("ts", width), *by)


def start(df, *columns):
    """The start of a window as text, beside other columns."""
    return df.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), *columns)


#: Sums of whole cents do not depend on the order of the rows.
def cents():
    return F.sum(F.round(F.col("value") * 100).cast("long"))


SQL_CENTS = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)"
TUMBLE = "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, {} FROM events GROUP BY 1"


@query("L3_tumbling_window", TUMBLE.format(f"user_id, count(*) AS n, {SQL_CENTS} AS cents") + ", user_id")
def _(t):
    rows = windowed(t, "1 day", None, "user_id").agg(F.count("*").alias("n"), cents().alias("cents"))
    return start(appended(rows, "tumbling"), "user_id", "n", "cents")


@query("L4_tumbling_api", TUMBLE.format(f"event_type, max(value) - min(value) AS spread, count(DISTINCT user_id) AS users") + ", event_type")
def _(t):
    """Key, window and an aggregate of one's own making from built-in ones; users are counted over finished windows."""
    rows = windowed(t, "1 day", None, "event_type", "user_id").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    done = start(appended(rows, "tumbling_api"), "event_type", "user_id", "a", "b")
    return done.groupBy("start", "event_type").agg((F.max("b") - F.min("a")).alias("spread"), F.count("user_id").alias("users"))


@query(
    "L5_hop_window",
    """SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts) - INTERVAL 1 DAY, date_trunc('day', ts)]) AS s FROM events) GROUP BY 1""",
)
def _(t):
    return start(appended(windowed(t, "2 days", "1 day").agg(F.count("*").alias("n")), "hop"), "n")


SESSIONS = """g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL {} OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
       s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)"""


@query("L6_session_window", f"WITH {SESSIONS.format('12 HOUR')} SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M') AS start FROM s GROUP BY user_id, k")
def _(t):
    rows = events(t).groupBy("user_id", F.session_window("ts", "12 hours")).agg(F.count("*").alias("n"))
    done = appended(rows, "sessions")
    return done.select("user_id", "n", F.date_format("session_window.start", "yyyy-MM-dd HH:mm").alias("start"))


@query("L9_windowed_pv_uv", TUMBLE.format("count(*) AS pv, count(DISTINCT user_id) AS uv"))
def _(t):
    """Distinct users by (window, user) first, whose state ends with the window; the second step is on the finished windows."""
    rows = appended(windowed(t, "1 day", None, "user_id").agg(F.count("*").alias("n")), "pv_uv")
    return start(rows, "user_id", "n").groupBy("start").agg(F.sum("n").alias("pv"), F.count("user_id").alias("uv"))


@query("L10_windowed_error_rate", TUMBLE.format("round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS rate"))
def _(t):
    rate = F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 6).alias("rate")
    return start(appended(windowed(t, "1 day").agg(rate), "errors"), "rate")


@query("L11_threshold_alert", TUMBLE.format("max(value) AS most") + " HAVING max(value) > 150")
def _(t):
    return start(appended(windowed(t, "1 day").agg(F.max("value").alias("most")).filter("most > 150"), "alerts"), "most")


@query(
    "L12_experiment_rate",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, user_id % 2 AS variant, count(*) FILTER (event_type = 'view') AS views,
       round(count(*) FILTER (event_type = 'purchase') / nullif(count(*) FILTER (event_type = 'view'), 0), 6) AS rate FROM events GROUP BY 1, 2""",
)
def _(t):
    """Purchases per view in each window, by the variant that a user is dealt."""
    views, bought = F.count_if(F.col("event_type") == "view"), F.count_if(F.col("event_type") == "purchase")
    rows = windowed(t, "1 day", None, (F.col("user_id") % 2).alias("variant")).agg(views.alias("views"), F.round(F.try_divide(bought, views), 6).alias("rate"))
    return start(appended(rows, "experiment"), "variant", "views", "rate")


@query(
    "L13_many_large_payments",
    f"""SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n, {SQL_CENTS} AS cents FROM events WHERE value > 50
        GROUP BY 1, 2 HAVING count(*) >= 2 AND {SQL_CENTS} > 20000""",
)
def _(t):
    large = events(t).filter("value > 50").groupBy(F.window("ts", "1 day"), "user_id").agg(F.count("*").alias("n"), cents().alias("cents"))
    return start(appended(large.filter("n >= 2 AND cents > 20000"), "large"), "user_id", "n", "cents")


@query(
    "L14_many_places",
    """SELECT user_id, strftime(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start, count(DISTINCT event_type) AS kinds FROM events
       GROUP BY 1, 2 HAVING count(DISTINCT event_type) >= 4""",
)
def _(t):
    """Users with four kinds and more in a window; the set that a key holds is as small as the number of kinds."""
    rows = windowed(t, "7 days", None, "user_id").agg(F.size(F.collect_set("event_type")).alias("kinds")).filter("kinds >= 4")
    return start(appended(rows, "places"), "user_id", F.col("kinds").cast("long").alias("kinds"))


@query(
    "L15_high_rate",
    """SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) >= 4""",
)
def _(t):
    return start(appended(windowed(t, "1 day", None, "user_id").agg(F.count("*").alias("n")).filter("n >= 4"), "rate"), "user_id", "n")


# Keyed state


def keyed(t, label, processor):
    rows = events(t).withColumn("kind", F.col("event_type"))
    return appended(state.keyed(rows, "user_id", processor), label)


ORDERED = "ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@query(
    "L7_count_trigger",
    f"""SELECT user_id, CAST((rn - 1) // 10 + 1 AS BIGINT) AS round, {SQL_CENTS.replace('value', 'coalesce(value, 0)')} AS total
        FROM (SELECT *, {ORDERED} AS rn FROM events) GROUP BY 1, 2 HAVING count(*) = 10""",
)
def _(t):
    return keyed(t, "count_trigger", state.CountTrigger(60 * DAY, 10))


@query("L22_keyed_counter", f"WITH {SESSIONS.format('5 DAY')} SELECT user_id, count(*) AS n FROM s GROUP BY user_id, k")
def _(t):
    """Rows of a user until five days without one; then the counter is given out and cleared."""
    return keyed(t, "counter", state.Counter(5 * DAY))


@query(
    "L23_list_and_map_state",
    f"""WITH r AS (SELECT *, {ORDERED.replace('ts, event_id', 'ts DESC, event_id DESC')} AS back FROM events),
        c AS (SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1)
        SELECT user_id, string_agg(event_type, ',' ORDER BY back DESC) AS recent, any_value(counts) AS counts FROM r JOIN c USING (user_id) WHERE back <= 3 GROUP BY 1""",
)
def _(t):
    return keyed(t, "profile", state.Profile(60 * DAY, 3))


@query(
    "L16_burst_pattern",
    """WITH e AS (SELECT user_id, event_id, count(*) OVER w AS n, CAST(sum(CAST(round(100 * coalesce(value, 0)) AS BIGINT)) OVER w AS BIGINT) AS total FROM events
         WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 12 HOUR PRECEDING AND CURRENT ROW))
       SELECT * FROM e WHERE n >= 3 AND total > 15000""",
)
def _(t):
    """The rows with which a user has three events and over 150 within twelve hours. Partial matches end with the span."""
    return keyed(t, "burst", state.Burst(12 * HOUR, 3, 15000))


FINE = "event_type || '-' || (CAST(json_extract_string(props, '$.k') AS INT) // 10)"


@query(
    "L26_interest_recommender",
    f"""WITH e AS (SELECT user_id, {FINE} AS kind FROM events), n AS (SELECT kind, count(*) AS n FROM e WHERE kind IS NOT NULL GROUP BY 1), u AS (SELECT DISTINCT user_id FROM e)
       SELECT user_id, kind, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, kind) AS INT) AS rank FROM u, n
       WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = u.user_id AND e.kind = n.kind)
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, kind) <= 10""",
)
def _(t):
    """The most frequent kinds that a user has not seen; what was seen comes from keyed state."""
    fine = F.concat("event_type", F.lit("-"), F.expr("CAST(get_json_object(props, '$.k') AS INT) DIV 10").cast("string"))
    seen = appended(state.keyed(events(t).withColumn("kind", fine), "user_id", state.Interests(60 * DAY)), "interests")
    kinds = t.events.select(fine.alias("kind")).filter("kind IS NOT NULL").groupBy("kind").agg(F.count("*").alias("n"))
    all_kinds = kinds.agg(F.collect_list(F.struct("kind", "n")).alias("all"))  # one short list of kinds
    users = seen.groupBy("user_id").agg(F.collect_set("kind").alias("had")).join(F.broadcast(all_kinds))
    fresh = users.select("user_id", F.inline(F.filter("all", lambda k: ~F.array_contains("had", k["kind"]))))
    ranked = fresh.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "kind")))
    return ranked.filter("rank <= 10").select("user_id", "kind", "rank")


@query(
    "L17_cart_abandonment",
    """SELECT event_id, user_id FROM events c WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase'
       AND p.user_id = c.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 2 DAY)""",
)
def _(t):
    """Clicks that no purchase of the user follows within two days: a left outer join of two streams, each with a watermark."""
    path = replay(t.events.coalesce(1), "carts", "ts", closing=CLOSING)

    def side(kind, at):
        rows = file_stream(t.spark, path, SCHEMAS["events"], files_per_trigger=1).filter(F.col("event_type") == kind)
        return rows.withColumn(at, F.col("ts").cast("timestamp")).withWatermark(at, "1 hour")

    clicks = side("click", "clicked").select("event_id", "user_id", "clicked")
    bought = side("purchase", "bought").select(F.col("user_id").alias("buyer"), "bought")
    on = F.expr("user_id = buyer AND bought BETWEEN clicked AND clicked + INTERVAL 2 DAYS")
    return appended(clicks.join(bought, on, "left").filter("buyer IS NULL").select("event_id", "user_id"), "abandoned")


# Late rows. A tenth of the events comes three days after it happened, in six stretches of arrival.

PIECES = 6
LATE = "event_id % 10 = 3"
ARRIVAL = f"CASE WHEN {LATE} THEN ts + INTERVAL 3 DAY ELSE ts END"
ARRIVED = f"""a AS (SELECT *, {ARRIVAL} AS came FROM events), m AS (SELECT min(came) AS first, (max(came) - min(came)) / {PIECES} AS step FROM a),
  b AS (SELECT a.*, CAST(greatest(0, least({PIECES - 1}, ceil(epoch_us(came - first) / epoch_us(step)) - 1)) AS INT) AS piece FROM a, m),
  p AS (SELECT piece, max(ts) AS upto FROM b GROUP BY 1),
  w AS (SELECT piece, max(upto) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark_1,
        max(upto) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS mark_2 FROM p)"""


def late_events(t, delay):
    return events(t, delay, n_pieces=PIECES, arrival=F.expr(f"CASE WHEN {LATE} THEN ts + INTERVAL 3 DAYS ELSE ts END"))


def daily(rows):
    return rows.groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n"))


@query(
    "L1_watermark",
    f"""WITH {ARRIVED} SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM b JOIN w USING (piece)
        WHERE mark_2 IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark_2 - INTERVAL 1 DAY GROUP BY 1""",
)
def _(t):
    """Days as a watermark of one day leaves them: a row whose day had closed before is left out."""
    return start(appended(daily(late_events(t, "1 day")), "watermark"), "n")


@query("L2_bounded_out_of_orderness", TUMBLE.format("count(*) AS n"))
def _(t):
    """A delay above the greatest lateness loses no row."""
    return start(appended(daily(late_events(t, "4 days")), "bounded"), "n")


def divided(t, delay="1 day"):
    """The folders of on-time and late rows."""
    root = scratch_path(t.spark, "routes")

    def into(route):
        return lambda rows, batch: rows.write.mode("overwrite").parquet(f"{root}/{route}/batch={batch}")

    routed(late_events(t, delay).filter("event_id >= 0"), "routed", "ts", delay, into("on_time"), into("late"))
    kind = f"{SCHEMAS['events'].replace('timestamp_ntz', 'timestamp')}, batch long"
    return tuple(t.spark.read.schema(kind).parquet(f"{root}/{route}") for route in ("on_time", "late"))


@query("L8_late_rows", f"WITH {ARRIVED} SELECT event_id, coalesce(ts < mark_1 - INTERVAL 1 DAY, false) AS late FROM b JOIN w USING (piece)")
def _(t):
    """Every event once: in time, or on the route of late rows."""
    on_time, late = divided(t)
    return on_time.select("event_id", F.lit(False).alias("late")).union(late.select("event_id", F.lit(True)))


@query("L36_late_correction", TUMBLE.format("count(*) AS n"))
def _(t):
    """Days counted from what came in time; the days that late rows touch are then computed anew from all rows."""
    on_time, late = divided(t)
    day = F.date_trunc("day", "ts").alias("day")
    first = on_time.select(day).groupBy("day").agg(F.count("*").alias("n"))
    touched = late.select(day).distinct()
    again = on_time.unionByName(late).select(day).join(touched, "day", "left_semi").groupBy("day").agg(F.count("*").alias("n"))
    result = first.join(touched, "day", "left_anti").unionByName(again)
    return result.select(F.date_format("day", "yyyy-MM-dd HH:mm").alias("start"), "n")


# Steps and sinks


@query("L19_map_filter", "SELECT event_id, upper(event_type) AS kind FROM events WHERE value > 10")
def _(t):
    return appended(whole(t).filter("value > 10").select("event_id", F.upper("event_type").alias("kind")), "mapped")


@query("L18_running_daily_gmv", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {SQL_CENTS} AS cents FROM events WHERE event_type = 'purchase' GROUP BY 1")
def _(t):
    """A total for each day without window: update mode, the last row of a day is kept by key. State grows by one row a day."""
    rows = events(t).filter("event_type = 'purchase' AND user_id >= 0").groupBy(F.to_date("ts").cast("string").alias("day")).agg(cents().alias("cents"))
    return final_state(rows, "running", ["day"])


@query(
    "L20_reduce",
    f"SELECT user_id, strftime(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start, {SQL_CENTS} AS cents FROM events GROUP BY 1, 2",
)
def _(t):
    """Sums by user, row by row; state ends with the week."""
    return start(appended(windowed(t, "7 days", None, "user_id").agg(cents().alias("cents")), "reduced"), "user_id", "cents")


@query(
    "L21_full_window",
    """SELECT user_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M') AS start, strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M') AS stop,
       round(sum(CAST(round(value * 100) AS BIGINT)) / count(value) / 100, 4) AS mean FROM events GROUP BY 1, 2, 3""",
)
def _(t):
    """The mean of a finished window with its bounds."""
    mean = F.round(cents() / F.count("value") / 100, 4).alias("mean")
    done = appended(windowed(t, "1 day", None, "user_id").agg(mean), "full_window")
    return start(done, "user_id", F.date_format("window.end", "yyyy-MM-dd HH:mm").alias("stop"), "mean")


@query(
    "L24_broadcast_rules",
    """WITH rules AS (SELECT event_type, avg_cents FROM (SELECT event_type, sum(CAST(round(value * 100) AS BIGINT)) / count(value) AS avg_cents FROM events GROUP BY 1))
       SELECT event_id FROM events JOIN rules USING (event_type) WHERE value * 100 > 4 * avg_cents""",
)
def _(t):
    """A rule for each kind of event, sent to all tasks: values of over four times the kind's mean."""
    rules = t.events.groupBy("event_type").agg((F.sum(F.round(F.col("value") * 100).cast("long")) / F.count("value")).alias("avg_cents"))
    rows = whole(t).join(F.broadcast(rules), "event_type").filter("value * 100 > 4 * avg_cents")  # as many rules as kinds
    return appended(rows.select("event_id"), "ruled")


@query("L27_stream_enrichment", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id")
def _(t):
    rows = whole(t).join(t.customer, F.expr("c_custkey = user_id"), "left").select("event_id", "c_mktsegment")
    return appended(rows, "enriched")


@query(
    "L28_fan_out",
    "SELECT 'errors' AS sink, count(*) AS n FROM events WHERE event_type = 'error' UNION ALL SELECT 'large', count(*) FROM events WHERE value > 100",
)
def _(t):
    """One source, two sinks fed by the same micro-batches."""
    root = scratch_path(t.spark, "fan_out")
    sinks = {"errors": "event_type = 'error'", "large": "value > 100"}

    def handle(rows, batch):
        rows = rows.filter("user_id >= 0").persist()
        for name, wanted in sinks.items():
            rows.filter(wanted).select("event_id").write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
        rows.unpersist()

    each_batch(events(t), handle, f"{root}/checkpoint")
    counted = [t.spark.read.schema("event_id long, batch long").parquet(f"{root}/{n}").agg(F.lit(n).alias("sink"), F.count("*").alias("n")) for n in sinks]
    return functools.reduce(DataFrame.union, counted)


@query("L29_fan_in", "SELECT kind, count(*) AS n FROM (SELECT event_type AS kind FROM events UNION ALL SELECT 'order ' || o_orderstatus FROM orders) GROUP BY 1")
def _(t):
    """Two sources, events and orders, as one flow."""
    orders = event_stream(t.spark, t.path("orders"), SCHEMAS["orders"], "o_orderdate").select(F.concat(F.lit("order "), "o_orderstatus").alias("kind"))
    both = whole(t).select(F.col("event_type").alias("kind")).unionByName(orders)
    return final_state(both.groupBy("kind").agg(F.count("*").alias("n")), "fan_in", ["kind"])


@query("L30_cascade", f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {SQL_CENTS} AS cents, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1")
def _(t):
    """One stream's files are the next stream's source."""
    root = scratch_path(t.spark, "cascade")
    clean = events(t).filter("event_type = 'purchase' AND user_id >= 0").select(F.to_date("ts").cast("string").alias("day"), F.round(F.col("value") * 100).cast("long").alias("c"))
    append_files(clean, f"{root}/clean", f"{root}/checkpoint")
    rows = file_stream(t.spark, f"{root}/clean", "day string, c long").groupBy("day").agg(F.sum("c").alias("cents"), F.count("*").alias("n"))
    return final_state(rows, "cascade_days", ["day"])


@query("L31_checkpoint_restart", TUMBLE.format("count(*) AS n"))
def _(t):
    """A query that stops when half of its input is there and later goes on from its checkpoint, its windows kept in state."""
    root = scratch_path(t.spark, "restart")
    middle = t.events.agg(F.percentile_approx(F.col("ts").cast("timestamp").cast("double"), 0.5).cast("timestamp")).first()[0]
    early = F.col("ts").cast("timestamp") <= F.lit(middle)
    closing = t.spark.read.schema(SCHEMAS["events"]).parquet(replay(t.events, "ending", "ts", 0, closing=CLOSING[:1]))
    for part in (t.events.filter(early), t.events.filter(~early), closing):
        part.write.mode("append").parquet(f"{root}/in")
        rows = file_stream(t.spark, f"{root}/in", SCHEMAS["events"]).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
        done = append_files(daily(rows), f"{root}/out", f"{root}/checkpoint")
    return start(done, "n")


@query("L32_exactly_once_sink", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t):
    """Batches are written under their number: the same batch, handed over twice as after a failure, is stored once."""
    root = scratch_path(t.spark, "once")

    def handle(rows, batch):
        for _ in range(2):
            rows.filter("user_id >= 0").select("user_id", "event_id").write.mode("overwrite").parquet(f"{root}/out/batch={batch}")

    each_batch(events(t), handle, f"{root}/checkpoint")
    return t.spark.read.schema("user_id long, event_id long, batch long").parquet(f"{root}/out").groupBy("user_id").agg(F.count("*").alias("n"))


@query("L33_stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    """Every third event is delivered again up to two days later; ids are remembered as long as the watermark allows."""
    again = t.events.filter("event_id % 3 = 0").withColumn("came", F.col("ts").cast("timestamp") + F.expr("INTERVAL 2 DAYS"))
    twice = t.events.withColumn("came", F.col("ts").cast("timestamp")).unionByName(again)
    rows = replayed(twice, "twice", "ts", "3 days", arrival=F.col("came"), closing=CLOSING[:1])
    kept = rows.dropDuplicatesWithinWatermark(["event_id"]).filter("event_id >= 0").select("user_id", "event_type")
    return appended(kept, "deduped").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query(
    "L34_last_window_top_5",
    f"""WITH d AS (SELECT user_id, date_trunc('day', ts) AS d, {SQL_CENTS} AS cents FROM events GROUP BY 1, 2)
        SELECT user_id, cents FROM d WHERE d = (SELECT max(d) FROM d) ORDER BY cents DESC, user_id LIMIT 5""",
)
def _(t):
    """The five best of the newest finished window, read from the stream's sink table."""
    done = start(appended(windowed(t, "1 day", None, "user_id").agg(cents().alias("cents")), "sums"), "user_id", "cents")
    newest = done.agg(F.max("start").alias("start"))
    return done.join(F.broadcast(newest), "start").orderBy(F.desc("cents"), "user_id").limit(5).select("user_id", "cents")


@query(
    "L35_two_time_bases",
    """SELECT 'event' AS base, strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, count(*) AS n FROM events GROUP BY 2
       UNION ALL SELECT 'processing', NULL, count(*) FROM events""",
)
def _(t):
    """Windows by event time beside windows by the time of processing, which all fall within this run."""
    stamped = appended(whole(t).select("event_id", "ts", F.current_timestamp().alias("seen")), "stamped")
    by_event = stamped.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("start")).agg(F.count("*").alias("n"))
    by_clock = stamped.groupBy(F.window("seen", "365 days").alias("w")).agg(F.count("*").alias("n"))
    return by_event.select(F.lit("event").alias("base"), "start", "n").union(by_clock.select(F.lit("processing"), F.lit(None).cast("string"), "n"))
