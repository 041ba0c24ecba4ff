"""Session memory as tables: intents, last records, running statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.constants import CLASS_NAMES, TOOLS
from textsignal.operators.split import head_per_group

# --- fixed values: substring rules, first match wins ----------------------------------
WHY_WORDS = ["why", "explain", "reason", "how did you", "justify"]


def intent(message: Column) -> Column:
    """help / why / history / stats / compare / classify."""
    m = F.trim(F.lower(message))
    any_of = F.lit(False)
    for w in WHY_WORDS:
        any_of = any_of | m.contains(w)
    return (
        F.when(m.isin("help", "?"), "help")
        .when(any_of, "why")
        .when(m.contains("history") | (m.contains("last") & m.contains("analys")), "history")
        .when(m.contains("stats") | m.contains("summary"), "stats")
        .when(m.startswith("compare:") | m.startswith("compare "), "compare")
        .otherwise("classify")
    )


def compare_argument(message: Column) -> Column:
    """Text after the first colon, else after the command word."""
    at = F.locate(":", message)
    rest = F.when(at > 0, F.substr(message, at + 1)).otherwise(F.substr(message, F.lit(9)))
    return F.regexp_replace(rest, r"(?U)^\s+|\s+$", "")


def last_records(df: DataFrame, session: str, turn: str, n: int = 3) -> DataFrame:
    """The last ``n`` rows per session, ``back`` = 1 for the newest.

    The rank limit also runs before the shuffle, so long sessions stay small.
    """
    heads = head_per_group(df, [session], [F.desc(turn)], n)
    w = Window.partitionBy(session).orderBy(F.desc(turn))
    return heads.withColumn("back", F.row_number().over(w))


def _one_digit(mean: Column) -> Column:
    """Rounded twice, so that summing order cannot move a half."""
    return F.round(F.round(mean, 6), 1)


def session_stats(df: DataFrame, session: str) -> DataFrame:
    """Counts by tool and class and the mean cost (one digit) of each session."""
    return df.groupBy(session).agg(
        F.count("final").alias("n"),
        *[F.count_if(F.col("tool") == t).alias(f"tool_{i}") for i, t in enumerate(TOOLS)],
        *[F.count_if(F.col("final") == c).alias(f"label_{c}") for c in CLASS_NAMES],
        _one_digit(F.avg("cost")).alias("mean_cost"),
    )


def running_stats(df: DataFrame, session: str, turn: str) -> DataFrame:
    """Session statistics as of every turn.

    A long session is one window partition; it is streamed through in turn order
    with constant state and spills while sorting.
    """
    w = Window.partitionBy(session).orderBy(turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {
            "n": F.count(F.lit(1)).over(w),
            **{f"tool_{i}": F.count_if(F.col("tool") == t).over(w) for i, t in enumerate(TOOLS)},
            "mean_cost": _one_digit(F.avg("cost").over(w)),
        }
    )
