import datetime as dt
import glob
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.plans import section_l
from tidemark.runtime import scratch_path
from tidemark.streaming import state
from tidemark.streaming.run import append_files, appended, file_stream, replay, replayed, routed

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"
DAY = 86_400_000


def at(day, second=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, seconds=second)


def case(n=300, users=6, seed=3):
    rng = random.Random(seed)
    rows = [(k, at(rng.uniform(0, 20)), rng.randrange(users), rng.choice("abc"), round(rng.uniform(0, 99), 2)) for k in range(n)]
    rows += [(900 + k, at(5.25), 1, "a", 10.0) for k in range(5)]  # equal times
    return [*rows, (990, None, 2, "a", 1.0), (991, at(6), None, "b", 1.0), (992, at(7), 3, None, None)]


def stream(spark, rows, delay="1 hour", **how):
    frame = spark.createDataFrame(rows, SCHEMA)
    return replayed(frame, "case", "ts", delay, closing=section_l.CLOSING, **how)


def by_user(rows):
    out = {}
    for r in sorted((r for r in rows if r[1] is not None and r[2] is not None), key=lambda r: (r[1], r[0])):
        out.setdefault(r[2], []).append(r)
    return out


def run(spark, rows, processor, **how):
    some = stream(spark, rows, **how).withColumn("kind", F.col("event_type"))
    return [tuple(r) for r in appended(state.keyed(some, "user_id", processor), "keyed").collect()]


@pytest.mark.parametrize("pieces", [1, 4])
def test_counters_end_after_an_idle_time(spark, pieces):
    rows = case(60)
    want = []
    for user, mine in by_user(rows).items():
        n = 0
        for k, r in enumerate(mine):
            if k and (r[1] - mine[k - 1][1]) > dt.timedelta(days=2):
                want.append((user, n))
                n = 0
            n += 1
        want.append((user, n))
    assert sorted(run(spark, rows, state.Counter(2 * DAY), n_pieces=pieces)) == sorted(want)


def test_bursts_by_time_and_id_with_equal_times(spark):
    rows = case()
    want = []
    for user, mine in by_user(rows).items():
        for k, r in enumerate(mine):
            near = [x for x in mine[: k + 1] if r[1] - x[1] <= dt.timedelta(hours=20)]
            total = sum(round(100 * (x[4] or 0)) for x in near)
            if len(near) >= 3 and total > 9000:
                want.append((user, r[0], len(near), total))
    got = run(spark, rows, state.Burst(20 * 3_600_000, 3, 9000), n_pieces=3)
    assert sorted(got) == sorted(want) and want


def test_the_last_kinds_and_counts(spark):
    rows = case(80)
    want = []
    for user, mine in by_user(rows).items():
        kinds = [str(r[3]) for r in mine]
        want.append((user, ",".join(kinds[-2:]), ",".join(f"{k}={kinds.count(k)}" for k in sorted(set(kinds)))))
    assert sorted(run(spark, rows, state.Profile(60 * DAY, 2))) == sorted(want)


class Calls:
    """A state of one key in memory that counts its calls."""

    def __init__(self):
        self.held, self.calls = None, 0

    def exists(self):
        self.calls += 1
        return self.held is not None

    def get(self):
        self.calls += 1
        return iter(self.held or []) if not isinstance(self.held, tuple) else self.held

    def put(self, value):
        self.calls += 1
        self.held = value

    update = put

    def appendList(self, value):
        self.put([*(self.held or []), *value])

    def clear(self):
        self.put(None)

    def iterator(self):
        self.calls += 1
        return iter((self.held or {}).items())

    def updateValue(self, key, value):
        self.put((self.held or {}) | {key: value})

    def containsKey(self, key):
        self.calls += 1
        return key in (self.held or {})

    def getValue(self, key):
        self.calls += 1
        return self.held[key]

    def registerTimer(self, at):
        self.calls += 1


@pytest.mark.parametrize("processor", [state.Counter(DAY), state.Profile(DAY, 2)])
def test_calls_of_the_store_do_not_grow_with_the_rows_of_a_key(processor):
    class Time:
        mark = 0

        def getCurrentWatermarkInMs(self):
            return self.mark

    def calls(n):
        states = []

        class Handle(Calls):
            def getListState(self, *_):
                states.append(Calls())
                return states[-1]

            getValueState = getMapState = getListState

        states.append(Handle())
        processor.init(states[0])
        time, out = Time(), []
        for begin in (0, n):  # in two batches, the second after a pause that ends the first
            rows = [SimpleNamespace(at=(k + (begin and 3 * 86_400)) * 1_000_000, event_id=k, kind="ab"[k % 2], value=1.0) for k in range(begin, begin + n)]
            out += processor.handleInputRows((7,), rows, time)
            time.mark = rows[-1].at // 1000 + 1
            out += processor.handleExpiredTimer((7,), time, None)
        time.mark += 2 * DAY
        out += processor.handleExpiredTimer((7,), time, None)
        assert all(not s.held for s in states)
        return sum(s.calls for s in states), [tuple(r)[1:] for r in out]

    few, many = calls(10), calls(200)
    assert few[0] == many[0] <= 60
    assert few[1] in ([(10,)] * 2, [("a,b", "a=5,b=5")] * 2) and many[1] in ([(200,)] * 2, [("a,b", "a=100,b=100")] * 2)


def test_streams_of_nothing(spark):
    assert run(spark, [], state.Counter(DAY)) == []
    assert run(spark, [(1, None, None, None, None)], state.CountTrigger(DAY, 1)) == []


def state_rows(query):
    return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_state_of_windows_falls_when_the_watermark_has_passed(spark):
    rows = spark.createDataFrame([(k, at(k / 10), k % 7, "a", 1.0) for k in range(200)], SCHEMA)
    path = replay(rows.coalesce(1), "falls", "ts", 4, closing=section_l.CLOSING)
    source = file_stream(spark, path, rows.schema, files_per_trigger=1).withWatermark("ts", "1 hour")
    counted = source.groupBy(F.window("ts", "1 day"), "user_id").count()
    root = scratch_path(spark, "falls_out")
    writer = counted.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(sizes) > 20 and sizes[-1] <= len(section_l.CLOSING)  # the closing rows alone are left
    assert spark.read.parquet(f"{root}/out").agg(F.sum("count")).first()[0] == 200


def test_late_rows_take_their_own_way_and_none_is_lost(spark):
    rows = [(k, at(k % 20), 1, "a", 1.0) for k in range(100)] + [(200, None, 1, "a", 1.0)]
    arrival = F.when(F.col("event_id") % 9 == 0, F.col("ts") + F.expr("INTERVAL 8 DAYS")).otherwise(F.col("ts"))
    source = stream(spark, rows, "2 days", n_pieces=5, arrival=arrival).filter("event_id >= 0")
    got = {"on_time": {}, "late": {}}

    def into(route):
        def keep(frame, batch):
            got[route][batch] = [(r.event_id, r.ts) for r in frame.collect()]

        return keep

    routed(source, "routes", "ts", "2 days", into("on_time"), into("late"))
    on_time, late = ([r for b in got[k].values() for r in b] for k in ("on_time", "late"))
    assert sorted(i for i, _ in on_time + late) == [*range(100), 200] and late
    seen = None
    for batch in sorted(got["on_time"]):
        mark = seen - dt.timedelta(days=2) if seen else None
        assert all(t is None or mark is None or t >= mark for _, t in got["on_time"][batch])
        assert all(t < mark for _, t in got["late"][batch])
        seen = max([t for _, t in got["on_time"][batch] + got["late"][batch] if t] + ([seen] if seen else []))


def test_a_restarted_stream_goes_on_and_repeats_nothing(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    for step in range(3):
        spark.createDataFrame([(step * 10 + k,) for k in range(5)], "k long").coalesce(1).write.mode("append").parquet(folder)
        append_files(file_stream(spark, folder, "k long"), out, checkpoint)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == sorted(s * 10 + k for s in range(3) for k in range(5))
    assert len(glob.glob(f"{checkpoint}/commits/[0-9]*")) == 3
