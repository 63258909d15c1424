"""Keyed state: processors whose state has an end.

Rows of a key are handled in the order of their event time once the watermark has passed it; until then they wait in list
state. An event-time timer clears what a key holds when nothing has come for long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Gives rows to `step` by (ts, event_id), each when the watermark has passed it, and ends a key after `idle` ms.

    Input rows have `at` (their event time in microseconds), event_id, kind (string) and value (double).
    """

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, event_id long, kind string, value double")
        self.last = handle.getValueState("last", "at long")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Declare the state of the processor."""

    def step(self, key, row) -> Iterator[Row]:
        raise NotImplementedError

    def finish(self, key) -> Iterator[Row]:
        """What is given out when a key ends; its state is cleared afterwards by `clear`."""
        return iter(())

    def clear(self) -> None:
        raise NotImplementedError

    def load(self) -> None:
        """Bring the state of a key to memory before its rows are handled; every call of the store costs as much as many rows."""

    def store(self) -> None:
        """Keep what `step` and `clear` made of it, once for all these rows."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        fresh = [(r.at, r.event_id, r.kind, r.value) for r in rows]
        if fresh:
            self.waiting.appendList(fresh)
            self.handle.registerTimer(max(min(r[0] for r in fresh) // 1000, mark) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: (r[0], r[1] is None, r[1]))
        due = [r for r in held if r[0] // 1000 < mark]
        rest = held[len(due) :]
        last = self.last.get()[0] if self.last.exists() else None
        self.load()
        for r in due:
            if last is not None and r[0] - last > 1000 * self.idle:
                yield from self.finish(key)
                self.clear()
            last = r[0]
            yield from self.step(key, Row("at", "event_id", "kind", "value")(*r))
        if due:
            self.last.update((last,))
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(max(rest[0][0] // 1000, mark) + 1)
        elif due:
            self.waiting.clear()
        if last is not None:
            ends = last // 1000 + self.idle
            if ends < mark and not rest:
                yield from self.finish(key)
                self.clear()
                self.last.clear()
            else:
                self.handle.registerTimer(max(ends, mark) + 1)
        self.store()

    def close(self) -> None:
        pass


class Counter(InOrder):
    """(user_id, n): how many rows a key had until it was idle for `idle` ms. Value state."""

    SCHEMA = "user_id long, n long"

    def open(self, handle):
        self.n = handle.getValueState("n", "n long")

    def load(self):
        self.count = self.n.get()[0] if self.n.exists() else 0

    def step(self, key, row):
        self.count += 1
        return iter(())

    def finish(self, key):
        if self.count:
            yield Row(user_id=key[0], n=self.count)

    def clear(self):
        self.count = 0

    def store(self):
        if self.count:
            self.n.update((self.count,))
        else:
            self.n.clear()


class Profile(InOrder):
    """(user_id, recent, counts): the last `keep` kinds and the number of rows of each kind. List and map state."""

    SCHEMA = "user_id long, recent string, counts string"

    def __init__(self, idle: int, keep: int):
        super().__init__(idle)
        self.keep = keep

    def open(self, handle):
        self.recent = handle.getListState("recent", "kind string")
        self.counts = handle.getMapState("counts", "kind string", "n long")

    def load(self):
        self.kinds = [r[0] for r in self.recent.get()]
        self.numbers = {k[0]: v[0] for k, v in self.counts.iterator()}
        self.known, self.ended = set(self.numbers), False

    def step(self, key, row):
        self.kinds = [*self.kinds, row.kind][-self.keep :]
        self.numbers[row.kind] = self.numbers.get(row.kind, 0) + 1
        return iter(())

    def finish(self, key):
        recent = ",".join(str(k) for k in self.kinds)
        counts = ",".join(f"{k}={n}" for k, n in sorted((str(k), n) for k, n in self.numbers.items()))
        if recent:
            yield Row(user_id=key[0], recent=recent, counts=counts)

    def clear(self):
        self.kinds, self.numbers, self.ended = [], {}, True

    def store(self):
        if self.ended and self.known:
            self.counts.clear()
        for kind, n in self.numbers.items():
            self.counts.updateValue((kind,), (n,))
        if self.kinds:
            self.recent.put([(k,) for k in self.kinds])
        else:
            self.recent.clear()


class CountTrigger(InOrder):
    """(user_id, round, total): fires at each `every`-th row of a key with the whole cents of its rows since the last time."""

    SCHEMA = "user_id long, round long, total long"

    def __init__(self, idle: int, every: int):
        super().__init__(idle)
        self.every = every

    def open(self, handle):
        self.held = handle.getValueState("held", "n long, total long")

    def step(self, key, row):
        n, total = self.held.get() if self.held.exists() else (0, 0)
        n, total = n + 1, total + round(100 * (row.value or 0))
        if n % self.every == 0:
            yield Row(user_id=key[0], round=n // self.every, total=total)
            total = 0
        self.held.update((n, total))

    def clear(self):
        self.held.clear()


class Burst(InOrder):
    """(user_id, event_id, n, total): a row with which a key has `least` rows and more than `above` cents within `span` ms."""

    SCHEMA = "user_id long, event_id long, n long, total long"

    def __init__(self, span: int, least: int, above: int):
        super().__init__(span)
        self.least, self.above = least, above

    def open(self, handle):
        self.partial = handle.getListState("partial", "at long, cents long")

    def step(self, key, row):
        begins = row.at - 1000 * self.idle
        held = [tuple(r) for r in self.partial.get() if r[0] >= begins] + [(row.at, round(100 * (row.value or 0)))]
        self.partial.put(held)
        total = sum(c for _, c in held)
        if len(held) >= self.least and total > self.above:
            yield Row(user_id=key[0], event_id=row.event_id, n=len(held), total=total)

    def clear(self):
        self.partial.clear()


class Interests(InOrder):
    """(user_id, kind): the kinds a key has seen, given out when it ends. Map state as a set."""

    SCHEMA = "user_id long, kind string"

    def open(self, handle):
        self.seen = handle.getMapState("seen", "kind string", "n long")

    def step(self, key, row):
        self.seen.updateValue((row.kind,), (1,))
        return iter(())

    def finish(self, key):
        for k in self.seen.keys():
            yield Row(user_id=key[0], kind=k[0])

    def clear(self):
        self.seen.clear()


def keyed(stream: DataFrame, key: str, processor: InOrder) -> DataFrame:
    """Run a processor over a stream with a watermark on `ts`. Rows without key or event time take no part."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    some = stream.filter(f"{key} IS NOT NULL AND ts IS NOT NULL").select(key, "ts", F.unix_micros("ts").alias("at"), "event_id", "kind", "value")
    return some.groupBy(key).transformWithState(processor, processor.SCHEMA, "append", "eventTime")
