"""Event streams that arrive in parts: late rows, rows out of order, restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from registra.streaming.events import (
    Sessions,
    UpdatesSink,
    closed_sessions,
    latest_updates,
    rocks_db,
    run_available,
    windowed_counts,
)

START = datetime(2024, 1, 1)
MINUTE = 60_000_000


@pytest.fixture()
def follow(spark, tmp_path):
    """Append rows (minute, key) to an inbox and bring the query up to date."""
    folders = {n: str(tmp_path / n) for n in ("in", "out", "progress")}

    def arrive(rows, query, mode):
        if rows:
            timed = [(None if m is None else START + timedelta(minutes=m), k) for m, k in rows]
            spark.createDataFrame(timed, "ts timestamp, k string").write.mode("append").parquet(folders["in"])
        stream = query(spark.readStream.schema("ts timestamp, k string").parquet(folders["in"]))
        run_available(stream, folders["progress"], folders["out"], mode)
        return folders["out"], stream.schema

    return arrive


def test_windows_count_late_rows_only_while_open(spark, follow):
    def counts(rows):
        folder, schema = follow(
            rows, lambda s: windowed_counts(s, "ts", ["k"], "1 hour", "30 minutes"), "update"
        )
        found = latest_updates(spark, folder, schema, ["k", "start"])
        return {(r["k"], (r["start"] - START) / timedelta(hours=1)): r["n"] for r in found.collect()}

    assert counts([(5, "a"), (59, "a"), (5, None), (None, "a")]) == {("a", 0): 2, (None, 0): 1}
    assert counts([(85, "a"), (10, "a")]) == {("a", 0): 3, (None, 0): 1, ("a", 1): 1}
    # The hour is still open at a watermark of 55 minutes, and closed at one of 150.
    assert counts([(20, "a"), (180, "b")]) == {("a", 0): 4, (None, 0): 1, ("a", 1): 1, ("b", 3): 1}
    after = counts([(30, "a"), (181, "b")])
    assert after == {("a", 0): 4, (None, 0): 1, ("a", 1): 1, ("b", 3): 2}
    assert counts([]) == after


def test_sessions_join_rows_out_of_order_and_close_once(spark, follow):
    def sessions(rows):
        with rocks_db(spark):
            folder, schema = follow(
                rows, lambda s: closed_sessions(s, "k", "ts", 10 * MINUTE, "1 hour"), "append"
            )
        base = int((START - datetime(1970, 1, 1)).total_seconds() * 1e6)
        found = spark.read.schema(schema).parquet(folder).collect()
        return sorted(
            ((r["k"], (r["first"] - base) // MINUTE, (r["last"] - base) // MINUTE, r["n"]) for r in found),
            key=str,
        )

    assert sessions([(0, "a"), (20, "a"), (40, "a"), (7, "b"), (None, "a")]) == []
    # Rows between them join three sessions into one.
    assert sessions([(10, "a"), (30, "a"), (20, "a"), (55, "b")]) == []
    closed = [("a", 0, 40, 6), ("b", 55, 55, 1), ("b", 7, 7, 1)]
    assert sessions([(200, "c")]) == closed
    # What comes for a closed session is late; a restart without rows adds nothing.
    assert sessions([(41, "a"), (300, "c")]) == closed + [("c", 200, 200, 1)]
    assert sessions([]) == closed + [("c", 200, 200, 1)]


class Held:
    """State and timers of one key, as a processor sees them."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def clear(self):
        self.value, self.calls = None, self.calls + 1

    def registerTimer(self, at):
        self.timers.add(at)
        self.calls += 1

    def deleteTimer(self, at):
        self.timers.remove(at)
        self.calls += 1


def test_a_key_has_one_timer_however_many_sessions(spark):
    held, sessions = Held(), Sessions("k", 10 * MINUTE)
    sessions.init(held)
    rows = [{"moment": m * MINUTE} for m in range(0, 30000, 30)]
    assert list(sessions.handleInputRows(("a",), iter(rows[1:]), None)) == []
    assert held.timers == {40 * 60_000}
    # An earlier session moves the timer, a later one does not.
    list(sessions.handleInputRows(("a",), iter(rows[:1]), None))
    list(sessions.handleInputRows(("a",), iter([{"moment": 40_000 * MINUTE}]), None))
    assert held.timers == {10 * 60_000} and held.calls < 10

    def fire(minute):
        at = min(held.timers)
        found = list(sessions.handleExpiredTimer(("a",), TimerValues(0, minute * 60_000), ExpiredTimerInfo(at)))
        held.timers.remove(at)
        return [(r["first"] // MINUTE, r["n"]) for r in found]

    # At the watermark itself a session is closed; a moment before, it is not.
    assert fire(70) == [(0, 1), (30, 1), (60, 1)] and held.timers == {100 * 60_000}
    assert len(fire(29_980)) == 997 and held.timers == {40_010 * 60_000} and held.calls < 15
    assert fire(40_010) == [(40_000, 1)]
    assert not held.timers and held.value is None


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    sink, folder = UpdatesSink(str(tmp_path / "out")), str(tmp_path / "out")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert latest_updates(spark, folder, rows.schema, ["k"]).count() == 0
    sink(rows, 0)
    sink(rows, 0)
    sink(rows.filter("k = 'a'").withColumn("n", F.lit(5)), 1)
    found = latest_updates(spark, folder, rows.schema, ["k"])
    assert sorted(map(tuple, found.collect())) == [("a", 5), ("b", 2)]
