"""Streams over files: stateless routing, keyed session state, windowed counts.

Each job runs until the files present are consumed and stores its output in the
shared scratch folder, where the checkpoint lives too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textsignal.constants import TOOLS
from textsignal.session import scratch_path


def read_stream(spark: SparkSession, folder: str, name: str, files: int = 64) -> DataFrame:
    """Stream of the files of table ``name``: one file, or a folder of part files; ``files`` per micro-batch."""
    path = f"{folder}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder)  # a stream starts from a folder


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Consume what is there into a parquet table and read it back.

    Append goes to the file sink; updates are stored per micro-batch with its
    number in ``batch_id``, and replaying a batch replaces its folder.
    """
    spark = stream.sparkSession
    out, check = scratch_path(spark, name), scratch_path(spark, f"{name}-progress")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", check).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:

        def store(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        query = writer.foreachBatch(store).start()
    query.awaitTermination()
    return spark.read.schema(_with_batch(stream.schema, mode)).parquet(out)


def _with_batch(schema: T.StructType, mode: str) -> T.StructType:
    return schema if mode == "append" else T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])


def transform_stream(spark: SparkSession, folder: str, name: str, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stateless batch transformation applied to a stream."""
    return run_to_table(fn(read_stream(spark, folder, name)), f"{name}-routed")


# --- keyed session state ------------------------------------------------------------
KEEP = 3
STATE = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("by_tool", T.ArrayType(T.LongType())),
        T.StructField("by_label", T.ArrayType(T.LongType())),
        T.StructField("turns", T.ArrayType(T.LongType())),
        T.StructField("finals", T.ArrayType(T.IntegerType())),
    ]
)


def _merge_session(state: tuple, chunks: Iterator[pd.DataFrame]) -> tuple:
    """Counters grow; the newest turns are kept by turn number, so late turns do no harm."""
    n, by_tool, by_label, turns, finals = state
    last = dict(zip(turns, finals))
    for pdf in chunks:
        n += len(pdf)
        by_tool = [c + int((pdf["tool"] == t).sum()) for c, t in zip(by_tool, TOOLS)]
        by_label = [c + int((pdf["final"] == k).sum()) for k, c in enumerate(by_label)]
        top = pdf.nlargest(KEEP, "turn")
        last.update({int(a): int(b) for a, b in zip(top["turn"], top["final"])})
        last = dict(sorted(last.items())[-KEEP:])
    return n, by_tool, by_label, list(last), list(last.values())


def session_state(routed: DataFrame, session: str, idle_hours: float | None = None) -> DataFrame:
    """Counters and the last turns of each session, emitted whenever it changes.

    ``routed`` is a stream with ``session, turn, final, tool``.  With ``idle_hours`` the state of a
    session that got nothing for so long is dropped; what it had emitted stays.  A clock keeps
    a query alive, so a run that ends with its input (``run_to_table``) takes no ``idle_hours``.
    """
    out = T.StructType([routed.schema[session], *STATE.fields])
    timeout = GroupStateTimeout.NoTimeout if idle_hours is None else GroupStateTimeout.ProcessingTimeTimeout

    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        old = state.get if state.exists else (0, [0] * len(TOOLS), [0] * 3, [], [])
        new = _merge_session(tuple(old), chunks)
        state.update(new)
        if idle_hours is not None:
            state.setTimeoutDuration(int(idle_hours * 3_600_000))
        yield pd.DataFrame([[key[0], *new]], columns=[f.name for f in out.fields])

    return (
        routed.select(session, "turn", "final", "tool")
        .groupBy(session)
        .applyInPandasWithState(update, out, STATE, "update", timeout)
    )


def latest_state(updates: DataFrame, session: str) -> DataFrame:
    """The newest emitted row of each session."""
    cols = [c for c in updates.columns if c not in (session, "batch_id")]
    newest = F.max_by(F.struct(*cols), "batch_id").alias("s")
    return updates.groupBy(session).agg(newest).select(session, "s.*")


# --- windowed counts ----------------------------------------------------------------
def windowed_counts(
    events: DataFrame, ts: str, key: str, window: str = "1 hour", lateness: str = "30 minutes"
) -> DataFrame:
    """Counts per tumbling window and key; windows close and drop their state once
    the watermark has passed."""
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, window).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "mean_value")
    )


def session_windows(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", lateness: str = "30 minutes") -> DataFrame:
    """Counts per session of ``key``: events less than ``gap`` apart; a session closes once the watermark has passed its end."""
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")
    )
