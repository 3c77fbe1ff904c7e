"""Retry state and upserts on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from siltstone.functions.backoff import ATTEMPTS, CEILING

OUT = "kind string, url string, attempts int, next_attempt double, error string"
STATE = "attempts int"


def defer_stream(failures: DataFrame, base: int | None = None) -> DataFrame:
    """The schedule row after each batch of failures (kind, url, at, delay, error) of a key."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attempts, last = (state.get[0] if state.exists else 0), None
        for rows in batches:
            attempts += len(rows)
            top = rows.sort_values("at").iloc[-1]
            if last is None or top["at"] >= last["at"]:
                last = top
        if last is None:
            return
        state.update((attempts,))
        wait = max(last["delay"], min(CEILING, (base or last["delay"]) * 2 ** min(attempts - 1, 10)))
        due = float(last["at"] + wait) if attempts < ATTEMPTS else None
        yield pd.DataFrame({"kind": [key[0]], "url": [key[1]], "attempts": [attempts], "next_attempt": [due], "error": [(last["error"] or "")[:2000]]})

    return failures.groupBy("kind", "url").applyInPandasWithState(update, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


DUE = "kind string, url string, change string, attempts int, next_attempt double, error string"


class RetryTimers(StatefulProcessor):
    """Retry state of a key with a timer on its next attempt: a retry becomes due when its time comes, whether or not anything else happens.

    Failures count attempts and move the timer; a clearing takes it away with all that was counted. An event id counts once; ids are
    forgotten after a time, and so is a key to which nothing has happened for that long since its last failure.
    """

    def __init__(self, base: int | None, keep_ms: int):
        self.base, self.keep_ms = base, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.retry = handle.getValueState("retry", "attempts int, at double, next_attempt double, error string", self.keep_ms)
        self.seen = handle.getMapState("seen", "event_id long", "there boolean", self.keep_ms)

    def _stop_timers(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.retry.get() if self.retry.exists() else None
        attempts, last, due, error = held if held else (0, None, None, None)
        changed = cleared = False
        events = pd.concat(list(rows)).sort_values(["at", "event_id"])
        for e in events.itertuples(index=False):
            at = (int(e.event_id),)
            if self.seen.containsKey(at):
                continue
            self.seen.updateValue(at, (True,))
            changed = True
            if e.cleared:
                attempts, last, due, error, cleared = 0, None, None, None, True
                continue
            cleared = False
            attempts += 1
            if last is None or e.at >= last:
                last, error = float(e.at), (e.error or "")[:2000]
                wait = max(e.delay, min(CEILING, (self.base or e.delay) * 2 ** min(attempts - 1, 10)))
                due = last + wait
            if attempts >= ATTEMPTS:
                due = None
        if not changed:
            return
        self._stop_timers()
        if cleared:
            self.retry.clear()
        else:
            self.retry.update((attempts, last, due, error))
            if due is not None:
                self.handle.registerTimer(int(due * 1000))
        change = "cleared" if cleared else "suspended" if due is None else "retry"
        yield pd.DataFrame({"kind": [key[0]], "url": [key[1]], "change": [change], "attempts": [attempts], "next_attempt": pd.Series([due], dtype="float64"), "error": [error]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.retry.exists():
            attempts, _, due, error = self.retry.get()
            yield pd.DataFrame({"kind": [key[0]], "url": [key[1]], "change": ["due"], "attempts": [attempts], "next_attempt": pd.Series([due], dtype="float64"), "error": [error]})

    def close(self) -> None:
        pass


def due_stream(events: DataFrame, base: int | None = None, keep_ms: int = 7 * 86_400_000) -> DataFrame:
    """Changes of retry state of a stream of events (event_id, kind, url, at, cleared, delay, error), and ``due`` when a retry's time has come by the clock.

    State lies in RocksDB, on executors' disks and in the checkpoint, so that keys need not fit in memory.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return events.groupBy("kind", "url").transformWithStateInPandas(RetryTimers(base, keep_ms), DUE, "Update", "ProcessingTime")


def versioned_upsert(folder: str, keys: list[str], order: str):
    """For foreachBatch: keeps the table under folder/<batch id>, so that a replayed batch is written from the same version again."""
    from siltstone.operators.state import last_wins

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = spark.read.schema(batch.schema).parquet(f"{folder}/{batch_id - 1}") if batch_id else batch.limit(0)
        last_wins(old, batch, keys, order).write.mode("overwrite").parquet(f"{folder}/{batch_id}")

    return write


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by key and time window, late ones counted until the watermark passes."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("n")).select("w.start", "w.end", key, "n")
