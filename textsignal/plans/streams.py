"""Registered queries: sessions in batch and on streams."""

from pyspark.sql import DataFrame, functions as F

from textsignal.constants import TOOLS
from textsignal.functions.clean import fix_text
from textsignal.functions.hashing import uniform
from textsignal.operators import sessions as ss
from textsignal.operators.route import route
from textsignal.plans.registry import query
from textsignal.plans.routing import ANSWERS, ROUTED
from textsignal.plans.views import sql_uniform
from textsignal.streaming import jobs

TAU = 0.5
SQL_SIGNALS = (
    "sig AS (SELECT conv_id, turn, role, text, round(2*" + sql_uniform("'lex|'||conv_id||'|'||turn") + "-1, 4) AS compound, "
    + ", ".join(f"{sql_uniform(f"'{p}{i}|'||conv_id||'|'||turn")} AS {p}{i}" for p in "be" for i in range(3))
    + " FROM conversations)"
)
SESSIONS = f"{SQL_SIGNALS}, {ANSWERS.format(src='sig')}, {ROUTED}"


def signals(df: DataFrame) -> DataFrame:
    """Derived tool scores for every turn."""
    u = lambda name: uniform(name, F.col("conv_id"), F.col("turn"))
    return df.select(
        "conv_id",
        "turn",
        "text",
        F.round(2 * u("lex") - 1, 4).alias("compound"),
        *[u(f"{p}{i}").alias(f"{p}{i}") for p in "be" for i in range(3)],
    )


def routed_turns(df: DataFrame) -> DataFrame:
    return route(signals(df), TAU)


# Command words are put in front of turns by number, so that every intent occurs.
COMMANDS = ["help", "why was that", "show the history", "last analysis", "stats please", "compare: ", "compare ", "?"]
SQL_MESSAGE = (
    "msg AS (SELECT conv_id, turn, CASE (conv_id + turn) % 12 "
    + " ".join(f"WHEN {i} THEN '{c}'{'' if c in ('help', '?') else ' || text'}" for i, c in enumerate(COMMANDS))
    + " ELSE text END AS message FROM conversations)"
)


def messages(t) -> DataFrame:
    text = F.col("text")
    pick = text
    for i, c in enumerate(COMMANDS):
        value = F.lit(c) if c in ("help", "?") else F.concat(F.lit(c), text)
        pick = F.when((F.col("conv_id") + F.col("turn")) % 12 == i, value).otherwise(pick)
    return t.read("conversations").select("conv_id", "turn", pick.alias("message"))


@query(
    "l01_intent",
    f"""WITH {SQL_MESSAGE}, low AS (SELECT *, trim(lower(message)) AS m FROM msg)
    SELECT conv_id, turn, CASE WHEN m = 'help' OR m = '?' THEN 'help'
      WHEN regexp_matches(m, 'why|explain|reason|how did you|justify') THEN 'why'
      WHEN regexp_matches(m, 'history') OR (contains(m, 'last') AND contains(m, 'analys')) THEN 'history'
      WHEN regexp_matches(m, 'stats|summary') THEN 'stats' WHEN regexp_matches(m, '^compare[: ]') THEN 'compare' ELSE 'classify' END AS intent FROM low""",
)
def l01(t):
    return messages(t).select("conv_id", "turn", ss.intent(F.col("message")).alias("intent"))


@query(
    "l02_compare_argument",
    f"""WITH {SQL_MESSAGE} SELECT conv_id, turn, trim(CASE WHEN contains(message, ':') THEN substr(message, strpos(message, ':') + 1)
      ELSE substr(message, 9) END, E' \\t\\n\\r') AS argument FROM msg WHERE regexp_matches(trim(lower(message)), '^compare[: ]')
      AND NOT regexp_matches(lower(message), 'why|explain|reason|how did you|justify|history|stats|summary')
      AND NOT (contains(lower(message), 'last') AND contains(lower(message), 'analys'))""",
)
def l02(t):
    rows = messages(t).filter(ss.intent(F.col("message")) == "compare")
    return rows.select("conv_id", "turn", ss.compare_argument(F.col("message")).alias("argument"))


LAST3 = f"""WITH {SESSIONS} SELECT conv_id, turn, final, tool, CAST(back AS INTEGER) AS back FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM routed) WHERE back <= 3"""
STATS = f"""WITH {SESSIONS} SELECT conv_id, count(*) AS n, count(*) FILTER (tool = 'lexicon') AS tool_0, count(*) FILTER (tool = 'model') AS tool_1,
    count(*) FILTER (tool = 'expert') AS tool_2, count(*) FILTER (final = 0) AS label_0, count(*) FILTER (final = 1) AS label_1,
    count(*) FILTER (final = 2) AS label_2{{extra}} FROM routed GROUP BY conv_id"""


@query("l03_last_three", LAST3)
def l03(t):
    rows = routed_turns(t.read("conversations")).select("conv_id", "turn", "final", "tool")
    return ss.last_records(rows, "conv_id", "turn")


@query("l04_session_stats", STATS.format(extra=", round(round(avg(cost), 6), 1) AS mean_cost"))
def l04(t):
    return ss.session_stats(routed_turns(t.read("conversations")), "conv_id")


@query(
    "l04_running_stats",
    f"""WITH {SESSIONS} SELECT conv_id, turn, count(*) OVER w AS n, count(*) FILTER (tool = 'lexicon') OVER w AS tool_0,
    count(*) FILTER (tool = 'model') OVER w AS tool_1, count(*) FILTER (tool = 'expert') OVER w AS tool_2,
    round(round(avg(cost) OVER w, 6), 1) AS mean_cost FROM routed WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""",
)
def l04r(t):
    rows = ss.running_stats(routed_turns(t.read("conversations")), "conv_id", "turn")
    return rows.select("conv_id", "turn", "n", "tool_0", "tool_1", "tool_2", "mean_cost")


def clean_and_route(df: DataFrame) -> DataFrame:
    rows = routed_turns(df.withColumn("text", fix_text(F.col("text"))))
    return rows.select("conv_id", "turn", "final", "tool", F.length("text").alias("n_chars"))


@query(
    "l05_stream_route",
    f"""WITH {SESSIONS} SELECT conv_id, turn, final, tool, CAST(length(trim(regexp_replace(regexp_replace(regexp_replace(text,
      '[�…°]+\\s*(https?://\\S*)?$', ''), 'https?://\\S+', '', 'g'), '[\\s\\-–:]+$', ''), E' \\t\\n\\r')) AS INTEGER) AS n_chars FROM routed""",
)
def l05(t):
    return jobs.transform_stream(t.spark, t.path, "conversations", clean_and_route)


def _session_updates(t) -> DataFrame:
    stream = routed_turns(jobs.read_stream(t.spark, t.path, "conversations"))
    updates = jobs.run_to_table(jobs.session_state(stream, "conv_id"), "session-state", "update")
    return jobs.latest_state(updates, "conv_id")


@query("l06_stream_session_stats", STATS.format(extra=""))
def l06(t):
    s = _session_updates(t)
    return s.select(
        "conv_id",
        "n",
        *[F.col("by_tool")[i].alias(f"tool_{i}") for i in range(len(TOOLS))],
        *[F.col("by_label")[i].alias(f"label_{i}") for i in range(3)],
    )


@query("l06_stream_last_three", LAST3.replace("SELECT conv_id, turn, final, tool,", "SELECT conv_id, turn, final,"))
def l06b(t):
    s = _session_updates(t)
    rows = s.select("conv_id", F.size("turns").alias("k"), F.posexplode(F.arrays_zip("turns", "finals")).alias("i", "r"))
    return rows.select(
        "conv_id", F.col("r.turns").alias("turn"), F.col("r.finals").alias("final"), (F.col("k") - F.col("i")).alias("back")
    )


@query(
    "l07_stream_windows",
    """SELECT start, start + INTERVAL 1 HOUR AS "end", event_type, n, mean_value FROM
      (SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL)
    WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events)""",
)
def l07(t):
    stream = jobs.read_stream(t.spark, t.path, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    done = jobs.run_to_table(jobs.windowed_counts(stream, "ts", "event_type"), "windows")
    return done.select(
        F.col("start").cast("timestamp_ntz").alias("start"),
        F.col("end").cast("timestamp_ntz").alias("end"),
        "event_type",
        "n",
        F.round("mean_value", 6).alias("mean_value"),
    )
