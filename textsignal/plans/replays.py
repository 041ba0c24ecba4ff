"""Registered queries: streams that arrive in several micro-batches, some rows late."""

from pyspark.sql import DataFrame, functions as F

from textsignal.constants import TOOLS
from textsignal.plans.registry import query
from textsignal.plans.streams import LAST3, STATS, routed_turns
from textsignal.streaming import jobs, memory
from textsignal.streaming.replay import ROCKSDB, Replay, arrival_step, replay

STEPS = 4
LATE = 20  # one event in so many arrives two steps late
GAP_MINUTES = 720


def remembered(t, steps: int = 3) -> Replay:
    """Every other pair of turns comes in a later run."""
    rows = t.read("conversations").withColumn("step", F.least(F.floor(F.col("turn") / 2), F.lit(steps - 1)).cast("int"))
    job = lambda stream: memory.session_memory(routed_turns(stream))
    return replay(rows, "step", steps, job, "session-memory", "update", ROCKSDB)


@query(
    "l06_typed_state",
    f"""SELECT s.*, newest FROM ({STATS.format(extra="")}) s JOIN (SELECT conv_id, string_agg(turn || ':' || final, ' ' ORDER BY turn) AS newest
    FROM ({LAST3}) GROUP BY conv_id) l USING (conv_id)""",
)
def l06c(t):
    """Session counters and the last three turns, kept in typed state over several runs of a query."""
    s = jobs.latest_state(remembered(t).table, "conv_id")
    counts = [F.col("by_tool")[i].alias(f"tool_{i}") for i in range(len(TOOLS))]
    counts += [F.col("by_label")[i].alias(f"label_{i}") for i in range(3)]
    newest = F.array_join(F.zip_with("turns", "finals", lambda a, b: F.concat_ws(":", a, b)), " ").alias("newest")
    return s.select("conv_id", "n", *counts, newest)


def events_by_step(t, late: bool) -> DataFrame:
    """Events in order of time in ``STEPS`` steps; with ``late``, one in ``LATE`` arrives two steps after its own."""
    events = t.read("events").withColumn("ts", F.col("ts").cast("timestamp"))
    span = events.agg(F.struct(F.min("ts").alias("first"), F.max("ts").alias("last")).alias("s"))
    rows = events.withColumn("_s", span.scalar())
    own = arrival_step(F.col("ts"), F.col("_s.first"), F.col("_s.last"), STEPS)
    behind = F.when((F.col("event_id") % LATE == 7) & (own + 2 < STEPS), own + 2).otherwise(own) if late else own
    return rows.withColumn("step", behind).drop("_s")


def sql_arrived(gap: str) -> str:
    """``arrived``: events with their step; ``kept``: those that no earlier run's watermark is past, ``gap`` after the event."""
    return f"""span AS (SELECT epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b, max(ts) AS last FROM events),
    own AS (SELECT e.*, CAST(floor((epoch_us(ts) - a) * {STEPS}::DOUBLE / (b - a + 1)) AS INT) AS s FROM events e, span),
    arrived AS (SELECT *, CASE WHEN event_id % {LATE} = 7 AND s + 2 < {STEPS} THEN s + 2 ELSE s END AS step FROM own),
    marks AS (SELECT step, max(max(ts)) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 MINUTE AS mark
      FROM arrived GROUP BY step),
    kept AS (SELECT * FROM arrived JOIN marks USING (step) WHERE mark IS NULL OR {gap} > date_trunc('milliseconds', mark))"""


def late_windows(t) -> Replay:
    return replay(events_by_step(t, True), "step", STEPS, lambda s: jobs.windowed_counts(s, "ts", "event_type"), "late-windows")


def late_sessions(t) -> Replay:
    return replay(events_by_step(t, True), "step", STEPS, lambda s: jobs.session_windows(s, "ts", "user_id", "30 minutes"), "late-sessions")


def idle_visits(t) -> Replay:
    rows = events_by_step(t, False).withColumn("us", F.unix_micros("ts"))
    return replay(rows, "step", STEPS, lambda s: memory.visits(s, GAP_MINUTES, "30 minutes"), "visits", provider=ROCKSDB)


@query(
    "l07_late_rows",
    f"""WITH {sql_arrived("time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR")}
    SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, n, mean_value FROM
      (SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM kept GROUP BY ALL)
    WHERE start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', last - INTERVAL 30 MINUTE) FROM span)""",
)
def l07b(t):
    """Hourly counts of a stream whose late rows the watermark drops."""
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return late_windows(t).table.select(ntz("start"), ntz("end"), "event_type", "n", F.round("mean_value", 6).alias("mean_value"))


SQL_VISITS = """cut AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= {gap} THEN 0 ELSE 1 END AS fresh FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS visit FROM cut),
    whole AS (SELECT user_id, visit, min(ts) AS start, max(ts) AS last, count(*) AS n, round(sum(value), 4) AS total FROM numbered GROUP BY ALL)"""


@query(
    "l07_late_sessions",
    f"""WITH {sql_arrived("ts + INTERVAL 30 MINUTE")}, {SQL_VISITS.format(gap="INTERVAL 30 MINUTE", source="kept")}
    SELECT user_id, start, last + INTERVAL 30 MINUTE AS "end", n, total FROM whole, (SELECT last AS t FROM span)
    WHERE last + INTERVAL 30 MINUTE <= date_trunc('milliseconds', t - INTERVAL 30 MINUTE)""",
)
def l07c(t):
    """Session windows of a stream whose late rows the watermark drops."""
    ntz = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return late_sessions(t).table.select("user_id", ntz("start"), ntz("end"), "n", F.round("total", 4).alias("total"))


@query(
    "l06_idle_visits",
    f"""WITH span AS (SELECT max(ts) AS t FROM events), {SQL_VISITS.format(gap=f"INTERVAL {GAP_MINUTES} MINUTE", source="events")}
    SELECT user_id, epoch_us(start) AS start, epoch_us(last) AS "end", n, total FROM whole, span
    WHERE visit < (SELECT max(visit) FROM whole w WHERE w.user_id = whole.user_id)
      OR epoch_ms(last) + {GAP_MINUTES} * 60000 <= epoch_ms(t) - 30 * 60000""",
)
def l06e(t):
    """Visits of users, closed by a later event of theirs or by a timer once they stay away."""
    return idle_visits(t).table.withColumn("total", F.round("total", 4))
