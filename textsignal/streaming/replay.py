"""Feeding a stream in several runs: rows arrive in steps, and every run goes on from the checkpoint of the last.

Each step's rows are appended to an inbox folder of Parquet files and one query run consumes them.  Between two runs
the query is gone: what it knows comes back from offsets, watermark and state in the checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from textsignal.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass
class Replay:
    """What a replayed stream has put out, and the state operator's figures of every micro-batch, in order."""

    table: DataFrame
    batches: list[dict] = field(default_factory=list)

    @property
    def dropped(self) -> int:
        """Rows that came after the watermark."""
        return sum(b["dropped"] for b in self.batches)

    @property
    def kept_state(self) -> int:
        """State rows after the last micro-batch."""
        return self.batches[-1]["state_rows"] if self.batches else 0


@contextmanager
def state_store(spark: SparkSession, provider: str | None):
    """Queries started inside use this state store; typed state variables need the one on RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    if provider:
        spark.conf.set(PROVIDER, provider)
    try:
        yield
    finally:
        if provider and before:
            spark.conf.set(PROVIDER, before)
        elif provider:
            spark.conf.unset(PROVIDER)


def arrival_step(ts: Column, first: Column, last: Column, steps: int) -> Column:
    """Step 0 to ``steps`` - 1 of a time between ``first`` and ``last``, in whole microseconds."""
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.floor((us(ts) - us(first)) * steps / (us(last) - us(first) + 1)).cast("int")


def _stop_when_read(query: StreamingQuery, seconds: float) -> None:
    """Stops ``query`` after its first batch without rows that follows one with rows."""
    end = time.time() + seconds
    while time.time() < end:
        rows = [p["numInputRows"] for p in query.recentProgress]
        if any(rows) and rows[-1] == 0:
            query.stop()
            return
        query.awaitTermination(0.2)  # raises what the query has failed with
    query.stop()
    raise TimeoutError(f"the step was not read in {seconds} seconds")


def replay(
    rows: DataFrame,
    step: str,
    steps: int,
    job: Callable[[DataFrame], DataFrame],
    name: str,
    mode: str = "append",
    provider: str | None = None,
    clock_seconds: float | None = None,
) -> Replay:
    """``job`` over a stream of ``rows`` that arrive by their ``step`` column, one query run a step.

    Rows of a step are written by as many tasks as read them.  Append output goes to a file sink; updates are stored
    per micro-batch with its number in ``batch_id``, and a batch that is run again replaces its folder.  A step
    without rows still runs, so the watermark and timers go on.

    A job that follows the clock never runs out of batches; ``clock_seconds`` is how long each of its runs may take
    to read its step, after which it is stopped.
    """
    spark = rows.sparkSession
    inbox, out, check = (scratch_path(spark, f"{name}-{part}") for part in ("inbox", "out", "progress"))
    given = rows.drop(step)
    given.limit(0).write.parquet(inbox)
    batches, schema = [], None
    for n in range(steps):
        rows.filter(F.col(step) == n).drop(step).write.mode("append").parquet(inbox)
        stream = job(spark.readStream.schema(given.schema).parquet(inbox))
        schema = stream.schema
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", check)
        writer = writer.trigger(availableNow=True) if clock_seconds is None else writer.trigger(processingTime="1 second")
        with state_store(spark, provider):
            if mode == "append":
                query = writer.format("parquet").option("path", out).start()
            else:
                store = lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}")
                query = writer.foreachBatch(store).start()
            if clock_seconds is None:
                query.awaitTermination()
            else:
                _stop_when_read(query, clock_seconds)
        for progress in query.recentProgress:
            for op in progress["stateOperators"][:1]:
                batches.append({"run": n, "dropped": op["numRowsDroppedByWatermark"], "state_rows": op["numRowsTotal"]})
    read = spark.read.schema(schema if mode == "append" else schema.add("batch_id", "long"))
    return Replay(read.parquet(out), batches)
