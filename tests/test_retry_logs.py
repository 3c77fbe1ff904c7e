"""Retry logs with clearings, timers on streams, and redirects by doubling, against loops."""

import random
import time

import pytest

from siltstone.functions.urls import split_resolved
from siltstone.operators import classify, state

EVENTS = "event_id long, kind string, url string, at double, cleared boolean, delay long, error string"


def looped(events):
    """Of each key: failures since the last clearing, and the last failure's time and error, one event after another."""
    out = {}
    for e in sorted({e[0]: e for e in events}.values(), key=lambda e: (e[3], e[0])):
        key = e[1:3]
        n, at, error = out.get(key, (0, None, None))
        out[key] = (0, None, None) if e[4] else (n + 1, e[3], e[6])
    return out


def folded(spark, batches):
    log, seen = spark.createDataFrame([], state.LOG), spark.createDataFrame([], state.SEEN)
    for batch in batches:
        log, seen = state.fold_log(log, seen, spark.createDataFrame(batch, EVENTS))
    return log, seen


def test_logs_equal_a_loop(spark):
    rng = random.Random(31)
    events = [(i, rng.choice("ps"), f"u{rng.randrange(12)}", float(rng.randrange(60)), rng.random() < 0.3, 60, f"e{i}") for i in range(240)]
    events.sort(key=lambda e: (e[3], e[0]))
    want = looped(events)
    for batches in ([events], [events + events], [events[:90], events[60:150], events[:240]]):
        log, seen = folded(spark, batches)
        got = {(r.kind, r.url): (r.attempts, r.at, r.error) for r in log.collect()}
        assert got == want and seen.count() == 240
    schedule = {(r.kind, r.url): (r.attempts, r.next_attempt) for r in state.log_schedule(log).collect()}
    assert schedule == {k: (n, None if n >= 5 else at + 60 * 2 ** (n - 1)) for k, (n, at, _) in want.items() if n}
    history = {r.event_id: (r.segment, r.attempts) for r in state.attempts_history(spark.createDataFrame(events, EVENTS)).collect()}
    seen_so_far = {}
    for e in events:
        s, n = seen_so_far.get(e[1:3], (0, 0))
        seen_so_far[e[1:3]] = (s + 1, 0) if e[4] else (s, n + 1)
        assert history[e[0]] == seen_so_far[e[1:3]]


def test_late_and_empty_logs(spark):
    clear, fail, old = (5, "p", "u", 50.0, True, 60, None), (6, "p", "u", 60.0, False, 60, "later"), (1, "p", "u", 10.0, False, 60, "before the clearing")
    log, _ = folded(spark, [[clear], [fail], [old]])
    assert [(r.attempts, r.at, r.cleared_at) for r in log.collect()] == [(1, 60.0, 50.0)]
    log, seen = folded(spark, [[fail], [clear], []])  # a clearing that comes late forgets nothing that failed after it
    assert [(r.attempts, r.error) for r in log.collect()] == [(1, "later")] and seen.count() == 2
    log, seen = folded(spark, [[]])
    assert log.count() == 0 and seen.count() == 0


def test_a_retry_becomes_due_without_an_event(spark, tmp_path):
    """Of two failed keys, one is cleared; the other becomes due by the clock, while no new event comes."""
    from siltstone.streaming import retries

    soon = time.time() - 58
    rows = [(1, "page", "a", soon, False, 60, "x"), (1, "page", "a", soon, False, 60, "x"), (2, "page", "b", soon, False, 60, "y"), (3, "page", "b", soon + 1, True, 60, None), (4, "size", "c", soon, False, 3600, "z")]
    for k in range(5):
        rows.append((10 + k, "page", "s", soon + k, False, 60, "again"))
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in")
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        out = retries.due_stream(spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in"))
        keep = lambda batch, i: batch.write.mode("append").parquet(f"{tmp_path}/out")
        run = out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="1 second").start()
        try:
            got = set()
            for _ in range(90):
                time.sleep(1)
                if run.exception():
                    raise run.exception()
                if (tmp_path / "out").exists():
                    got = {(r.url, r.change, r.attempts, r.next_attempt) for r in spark.read.schema(retries.DUE).parquet(f"{tmp_path}/out").collect()}
                    if any(g[1] == "due" for g in got):
                        break
        finally:
            run.stop()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    assert got == {("a", "retry", 1, soon + 60), ("b", "cleared", 0, None), ("c", "retry", 1, soon + 3600), ("s", "suspended", 5, None), ("a", "due", 1, soon + 60)}


@pytest.mark.parametrize("most", [1, 2, 5, 9])
def test_redirects_equal_a_loop(spark, most):
    rng = random.Random(41)
    nodes, moves = [f"http://h/{i}" for i in range(60)], {}
    for k, u in enumerate(nodes):
        if k < 25:
            moves[u] = (302, f"/{k + 1}")  # a chain of 25 hops
        elif rng.random() < 0.7:
            moves[u] = (rng.choice([301, 303, 307, 308, 200, 404]), rng.choice([f"/{rng.randrange(60)}", f"http://h/{rng.randrange(60)}", None, "ftp://x/y", "//h/3"]))

    def walk(url):
        at = url
        for hops in range(most):
            status, to = moves.get(at, (200, None))
            if status not in (301, 302, 303, 307, 308):
                return at, hops, None
            if to is None:
                return None, hops, "no location"
            to = split_resolved(at, to)[0]
            if not to.startswith(("http://", "https://")):
                return None, hops, "not http"
            at = to
        return None, most, "too many redirects"

    asked = spark.createDataFrame([(u,) for u in [*nodes, "http://other/"]], "url string")
    table = spark.createDataFrame([(u, *m) for u, m in moves.items()], "url string, status int, location string")
    got = {r.url: (r.final_url, r.hops, r.error) for r in classify.follow_redirects(asked, table, most).collect()}
    assert got == {u: walk(u) for u in [*nodes, "http://other/"]}
    assert {e for _, _, e in got.values()} >= {None, "too many redirects"}
