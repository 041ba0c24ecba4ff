import time

import pytest
from pyspark.sql import functions as F

from textsignal.plans import replays
from textsignal.plans.views import Tables
from textsignal.streaming import jobs, memory
from textsignal.streaming.replay import PROVIDER, ROCKSDB, replay

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def t(spark):
    return Tables(spark, SF)


def test_late_rows_are_dropped_and_windows_leave_the_state(t):
    found = replays.late_windows(t)
    late = replays.events_by_step(t, True).join(
        replays.events_by_step(t, False).select("event_id", F.col("step").alias("own")), "event_id"
    )
    planted = late.filter("step <> own").count()
    assert planted > 0 and found.dropped == planted
    assert found.table.agg(F.sum("n")).first()[0] <= t.read("events").count() - planted
    assert len({b["run"] for b in found.batches}) == replays.STEPS
    assert found.kept_state < 20  # closed windows are evicted: only the last hours are left


def test_sessions_leave_the_state(t):
    found = replays.late_sessions(t)
    assert found.dropped > 0 and found.kept_state < 20
    assert found.table.groupBy("user_id", "start").count().filter("count > 1").isEmpty()


def test_idle_visits_close_by_a_timer(spark):
    """A user who never comes back is closed in a later run, and one whose visit goes on over runs stays one visit."""
    minute, hour = 60, 3600
    rows = [(1, 0, 1.0, 0), (1, 10 * minute, 2.0, 0), (2, 5 * minute, 4.0, 0), (2, 40 * minute, 8.0, 1), (3, 9 * hour, 1.0, 1), (3, 30 * hour, 1.0, 2)]
    rows = spark.createDataFrame(rows, "user_id long, s long, value double, step int")
    rows = rows.select("user_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("ts"), "value", "step")
    rows = rows.withColumn("us", F.unix_micros("ts"))
    found = replay(rows, "step", 3, lambda s: memory.visits(s, 60, "10 minutes"), "visits-test", provider=ROCKSDB)
    got = {(r.user_id, r.n, r.total, (r.end - r.start) // 60_000_000) for r in found.table.collect()}
    assert got == {(1, 2, 3.0, 10), (2, 2, 12.0, 35), (3, 1, 1.0, 0)}  # the last visit is still open
    assert spark.conf.get(PROVIDER, "") != ROCKSDB


def test_memory_over_runs_equals_one_run(spark):
    turns = [(c, n, (c + n) % 3, memory.TOOLS[n % 3], n // 3) for c in range(6) for n in range(9)]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, final int, tool string, step int")
    several = replay(rows, "step", 3, memory.session_memory, "memory-test", "update", ROCKSDB)
    once = replay(rows.withColumn("step", F.lit(0)), "step", 1, memory.session_memory, "memory-once", "update", ROCKSDB)
    table = lambda r: sorted(map(tuple, jobs.latest_state(r.table, "conv_id").collect()))
    assert table(several) == table(once)
    assert several.table.count() == 18 and several.kept_state > 0
    assert {tuple(r.turns) for r in several.table.filter("n = 9").collect()} == {(6, 7, 8)}


def test_state_is_forgotten_after_its_time(spark):
    rows = spark.createDataFrame([(1, n, 0, memory.TOOLS[0], n) for n in range(2)], "conv_id long, turn long, final int, tool string, step int")

    def slowly(stream):
        time.sleep(2)
        return memory.session_memory(stream, ttl_hours=1 / 3600)

    found = replay(rows, "step", 2, slowly, "memory-ttl", "update", ROCKSDB, clock_seconds=60).table
    assert [r.n for r in found.orderBy("batch_id").collect()] == [1, 1]
