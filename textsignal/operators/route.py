"""Cheap-to-costly cascade of three scorers, as table operators.

Input columns: ``compound`` and the class probabilities ``b0..b2`` (second tool)
and ``e0..e2`` (expert); null probabilities mean that a tool gave no answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.constants import CLASS_NAMES, TAUS, TOOL_COSTS, TOOLS
from textsignal.functions.proba import argmax3
from textsignal.operators.lexicon import lexicon_class
from textsignal.session import scratch_path
from textsignal.sources.writers import materialise

Scorer = Callable[[DataFrame], DataFrame]


def class_name(cls: Column) -> Column:
    return F.when(cls == 0, CLASS_NAMES[0]).when(cls == 1, CLASS_NAMES[1]).when(cls == 2, CLASS_NAMES[2])


def tool_answers(df: DataFrame) -> DataFrame:
    """Add class and confidence of every tool: ``v, b, b_conf, e, e_conf``."""
    answer = lambda p: F.when(F.col(f"{p}0").isNotNull(), argmax3(*[F.col(f"{p}{i}") for i in range(3)]))
    conf = lambda p: F.greatest(*[F.col(f"{p}{i}") for i in range(3)])
    return df.withColumns(
        {
            "v": lexicon_class(F.col("compound")),
            "b": answer("b"),
            "b_conf": conf("b"),
            "e": answer("e"),
            "e_conf": conf("e"),
        }
    )


def _ms(cost: float, digits: int) -> str:
    return f"{cost:.{digits}f} ms"


def decide(answered: DataFrame, tau: float, costs: list[float] = TOOL_COSTS) -> DataFrame:
    """``final, label, tool, reason, trace, cost`` from the tools' answers."""
    strong = F.abs("compound") > tau
    no_b, agree = F.col("b").isNull(), F.col("b") == F.col("v")
    no_e = F.col("e").isNull()
    asked_e = ~strong & ~no_b & ~agree

    def choose(on_strong, on_no_b, on_agree, on_no_e, on_expert):
        return (
            F.when(strong, on_strong).when(no_b, on_no_b).when(agree, on_agree).when(no_e, on_no_e).otherwise(on_expert)
        )

    lit = F.lit
    a, b, e = TOOLS
    reason = choose(
        F.format_string(f"signal %.3f above {tau}: {a} decides", F.abs("compound")),
        lit(f"{b} gave no answer: {a} decides"),
        lit(f"{a} and {b} gave one class"),
        lit(f"{a} and {b} differ, {e} gave no answer: {b} decides"),
        lit(f"{a} and {b} differ: {e} decides"),
    )

    def step(tool: str, cls: str, what: str, value: str, cost: str):
        return F.format_string(f"{tool}: %s, {what} %.3f, {cost}", class_name(F.col(cls)), F.col(value))

    trace = F.array_compact(
        F.array(
            step(a, "v", "signal", "compound", _ms(costs[0], 1)),
            F.when(~strong & ~no_b, step(b, "b", "certainty", "b_conf", _ms(costs[1], 0))),
            F.when(asked_e & ~no_e, step(e, "e", "certainty", "e_conf", _ms(costs[2], 0))),
        )
    )
    c0, c1, c2 = costs
    out = answered.withColumns(
        {
            "final": choose(F.col("v"), F.col("v"), F.col("b"), F.col("b"), F.col("e")),
            "tool": choose(lit(TOOLS[0]), lit(TOOLS[0]), lit(TOOLS[1]), lit(TOOLS[1]), lit(TOOLS[2])),
            "reason": reason,
            "trace": trace,
            "cost": choose(lit(c0), lit(c0), lit(c0 + c1), lit(c0 + c1), lit(c0 + c1 + c2)),
        }
    )
    return out.withColumn("verdict", class_name(F.col("final")))


def route(df: DataFrame, tau: float, costs: list[float] = TOOL_COSTS) -> DataFrame:
    """Route rows whose tool scores are all present as columns."""
    return decide(tool_answers(df), tau, costs)


def cascade(df: DataFrame, tau: float, mid: Scorer, expert: Scorer, costs: list[float] = TOOL_COSTS) -> DataFrame:
    """Route rows, calling a costly scorer only on the rows that reach it.

    A Python scorer inside CASE WHEN would run for every row, so the table is
    split instead.  The output of the second tool is stored before it is split
    again; no row is scored twice, and a lost executor re-reads the stored part.
    """
    spark = df.sparkSession
    none = [F.lit(None).cast("double").alias(f"{p}{i}") for p in "be" for i in range(3)]
    strong = df.filter(F.abs("compound") > tau).select("*", *none)
    weak = df.filter(~(F.abs("compound") > tau) | F.col("compound").isNull())
    scored = tool_answers(
        materialise(spark, scratch_path(spark, "cascade"), lambda: mid(weak)).select("*", *none[3:])
    )
    settled = F.col("b").isNull() | (F.col("b") == F.col("v"))
    drop = ["v", "b", "b_conf", "e", "e_conf"]
    rest = scored.filter(~settled).drop(*drop, "e0", "e1", "e2")
    parts = strong.unionByName(scored.filter(settled).drop(*drop)).unionByName(expert(rest))
    return route(parts, tau, costs)


# --- economics ----------------------------------------------------------------------
def tau_sweep(answered: DataFrame, taus: list[float] = TAUS, costs: list[float] = TOOL_COSTS) -> DataFrame:
    """``(tau, accuracy, pct_expert, mean_cost)`` for every threshold.

    A row is strong for the thresholds below its own signal.  Rows are counted by
    how many thresholds that is, so the table is read once and one row per count
    is left, whatever the number of thresholds.
    """
    grid = F.array(*[F.lit(float(x)) for x in taus])
    agree = F.col("b") == F.col("v")
    weak_ok = F.when(agree, F.col("b") == F.col("label")).otherwise(F.col("e") == F.col("label"))
    below = F.size(F.filter(grid, lambda x: F.abs(F.col("compound")) > x))
    steps = answered.groupBy(below.alias("s")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("v") == F.col("label")).alias("strong_ok"),
        F.count_if(weak_ok).alias("weak_ok"),
        F.count_if(agree).alias("agree"),
    )
    # at most len(taus) + 1 rows from here on
    per = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(x)).alias("tau")) for i, x in enumerate(taus)]))
    rows = steps.select("*", per)
    strong = F.col("s") > F.col("i")
    pick = lambda a, b: F.sum(F.when(strong, a).otherwise(b))
    total = F.sum("n")
    asked = F.sum(F.when(strong, 0).otherwise(F.col("n") - F.col("agree")))
    mid = F.sum(F.when(strong, 0).otherwise(F.col("n")))
    return rows.groupBy("tau").agg(
        (pick(F.col("strong_ok"), F.col("weak_ok")) / total).alias("accuracy"),
        (asked / total).alias("pct_expert"),
        ((F.lit(costs[0]) * total + F.lit(costs[1]) * mid + F.lit(costs[2]) * asked) / total).alias("mean_cost"),
    )


def best_tau(sweep: DataFrame) -> DataFrame:
    """The first threshold of the highest accuracy."""
    return sweep.orderBy(F.desc(F.round("accuracy", 12)), "tau").limit(1)


def every_nth(sweep: DataFrame, n: int = 4) -> DataFrame:
    """Rows 0, n, 2n ... of the sweep (one row per threshold)."""
    w = Window.partitionBy(F.lit(0)).orderBy("tau")
    return sweep.withColumn("_i", F.row_number().over(w) - 1).filter(F.col("_i") % n == 0).drop("_i")


def route_report(routed: DataFrame) -> DataFrame:
    """``(tool, rows, share, accuracy)`` per tool; accuracy is null for an unused tool."""
    counts = routed.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("tool") == t).alias(f"n{i}") for i, t in enumerate(TOOLS)],
        *[
            F.count_if((F.col("tool") == t) & (F.col("final") == F.col("label"))).alias(f"k{i}")
            for i, t in enumerate(TOOLS)
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("tool"),
                F.col(f"n{i}").alias("rows"),
                F.round(100 * F.col(f"n{i}") / F.col("total"), 1).alias("share"),
                F.when(F.col(f"n{i}") > 0, F.round(F.col(f"k{i}") / F.col(f"n{i}"), 3)).alias("accuracy"),
            )
            for i, t in enumerate(TOOLS)
        ]
    )
    return counts.select(F.inline(rows))


def economics(routed: DataFrame, costs: list[float] = TOOL_COSTS) -> DataFrame:
    """Cascade against always asking the expert: accuracy, cost, saving."""
    always = float(sum(costs))
    ok = lambda c: F.avg((F.col(c) == F.col("label")).cast("double"))
    one = routed.agg(
        ok("final").alias("accuracy"),
        F.avg("cost").alias("mean_cost"),
        ok("e").alias("accuracy_expert"),
        F.avg((F.col("tool") != TOOLS[2]).cast("double")).alias("resolved_cheaply"),
    )
    return one.withColumns(
        {"cost_expert": F.lit(always), "saving_pct": 100 * (1 - F.col("mean_cost") / F.lit(always))}
    )


def compare_tools(answered: DataFrame, id_col: str) -> DataFrame:
    """``(id, tool, answer, agreement)``: all tools side by side; no answer counts as ``none``."""
    names = [F.coalesce(class_name(F.col(c)), F.lit("none")) for c in ("v", "b", "e")]
    same = (names[0] == names[1]) & (names[1] == names[2])
    rows = F.array(*[F.struct(F.lit(t).alias("tool"), n.alias("answer")) for t, n in zip(TOOLS, names)])
    verdict = F.when(same, "one class").otherwise("several classes")
    return answered.select(id_col, verdict.alias("agreement"), F.inline(rows))


def tool_costs(routed: DataFrame) -> DataFrame:
    """Mean cost of the rows each tool settled."""
    return routed.groupBy("tool").agg(F.avg("cost").alias("mean_cost"), F.count(F.lit(1)).alias("rows"))


# --- text for people ----------------------------------------------------------------
def explain_rows(routed: DataFrame) -> Column:
    """Numbered trace, result and reason in one string."""
    steps = F.array_join(F.transform("trace", lambda x, i: F.concat((i + 1).cast("string"), F.lit(") "), x)), "\n")
    result = F.format_string("\n= %s (%d) by %s, %.0f ms\n", "verdict", "final", "tool", "cost")
    return F.concat(steps, result, F.col("reason"))


def tool_line(name: str, cls: Column, *probs: Column) -> Column:
    """Class, certainty and all probabilities, or a note that the tool gave no answer."""
    shares = ", ".join(f"{CLASS_NAMES[i]} %.3f" for i in range(3))
    text = F.format_string(f"%s (%d), certainty %.3f of {shares}", class_name(cls), cls, F.greatest(*probs), *probs)
    return F.when(cls.isNull(), F.lit(f"{name}: no answer")).otherwise(text)
