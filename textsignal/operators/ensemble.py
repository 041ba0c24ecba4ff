"""Votes, weight search, soft targets and loss tables over probability tables.

Long form: one row per document and model with ``label, model, p0, p1, p2``.
Weights are small driver-side dictionaries ``{model: weight}``.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from textsignal.constants import WEIGHT_GRID
from textsignal.functions.proba import argmax3, kl3, pick3, soften3
from textsignal.operators.metrics import CELLS, confusion_cells, macro_f1
from textsignal.session import scratch_path
from textsignal.sources.writers import materialise

P = ["p0", "p1", "p2"]
Weights = dict[str, float]


def weight_column(weights: Weights, model_col: str = "model") -> Column:
    """Weight of the row's model; null for a model that is not listed."""
    out = F.lit(None).cast("double")
    for name, w in weights.items():
        out = F.when(F.col(model_col) == name, F.lit(float(w))).otherwise(out)
    return out


def equal_vote(probs: DataFrame, keys: list[str]) -> DataFrame:
    """Mean probability per document over at least two models."""
    votes = probs.groupBy(*keys).agg(*[F.avg(p).alias(p) for p in P], F.count(F.lit(1)).alias("_n"))
    return votes.filter("_n >= 2").drop("_n")


def weighted_vote(probs: DataFrame, weights: Weights, keys: list[str]) -> DataFrame:
    """Weighted mean; models that are missing are left out of the divisor too.

    A document none of whose models has weight is left out.
    """
    w = weight_column(weights)
    rows = probs.select(*keys, *P, w.alias("_w")).filter("_w > 0")
    return rows.groupBy(*keys).agg(*[(F.sum(F.col("_w") * F.col(p)) / F.sum("_w")).alias(p) for p in P])


def vote_many(probs: DataFrame, configs: dict[str, Weights], keys: list[str]) -> DataFrame:
    """``(keys, config, p0, p1, p2)`` for several weightings in one aggregation.

    Rows are not multiplied before the shuffle: every configuration is a set of
    partial sums of the same group.
    """
    sums = []
    for i, weights in enumerate(configs.values()):
        w = F.coalesce(weight_column(weights), F.lit(0.0))
        sums += [F.sum(w * F.col(p)).alias(f"_{p}_{i}") for p in P] + [F.sum(w).alias(f"_w_{i}")]
    wide = probs.groupBy(*keys).agg(*sums)
    out = [
        F.struct(
            F.lit(name).alias("config"), *[F.try_divide(f"_{p}_{i}", f"_w_{i}").alias(p) for p in P]
        )
        for i, name in enumerate(configs)
    ]
    return wide.select(*keys, F.inline(F.array(*out))).filter("p0 IS NOT NULL")  # no model with weight: no vote


def vote_scores(votes: DataFrame, by: list[str]) -> DataFrame:
    """``(by, f1_macro)`` of vote tables."""
    named = votes.withColumn("pred", argmax3(*[F.col(p) for p in P]))
    return confusion_cells(named, by).select(*by, macro_f1().alias("f1_macro"))


def model_scores(probs: DataFrame) -> Weights:
    """Each model's own macro-F1, one value per model."""
    return {r["model"]: r["f1_macro"] for r in vote_scores(probs, ["model"]).orderBy("model").collect()}


def score_weighted_vote(probs: DataFrame, keys: list[str]) -> DataFrame:
    return weighted_vote(probs, model_scores(probs), keys)


def better_vote(probs: DataFrame, keys: list[str]) -> DataFrame:
    """The equal or the score-weighted vote, whichever scores higher; equal wins ties."""
    own = model_scores(probs)
    votes = vote_many(probs, {"equal": dict.fromkeys(own, 1.0), "weighted": own}, keys)
    f1 = {r["config"]: r["f1_macro"] for r in vote_scores(votes, ["config"]).collect()}
    method = "weighted" if f1["weighted"] > f1["equal"] else "equal"
    return votes.filter(F.col("config") == method)


def candidate_test(probs: DataFrame, base: Weights, candidate: str, keys: list[str], margin: float = 1e-4) -> DataFrame:
    """``(config, f1_macro, accepted)`` for the base vote and the candidate at full and half weight."""
    configs = {"base": base, "full": {**base, candidate: 1.0}, "half": {**base, candidate: 0.5}}
    scores = vote_scores(vote_many(probs, configs, keys), ["config"])
    f1 = {r["config"]: r["f1_macro"] for r in scores.collect()}
    best = "base"
    for name in ("full", "half"):
        if f1[name] > f1[best] + margin:
            best = name
    return scores.withColumn("accepted", F.col("config") == best)


# --- weight search ------------------------------------------------------------------
def wide_probabilities(probs: DataFrame, models: list[str], keys: list[str]) -> DataFrame:
    """One row per document with ``p<class>_<i>`` for model ``i`` and ``has_<i>``, 1 if the model scored it, else 0.

    What a model lacks counts as 0, and its weight is missing from the divisor.
    """
    cols = [
        F.coalesce(F.max(F.when(F.col("model") == m, F.col(p))), F.lit(0.0)).alias(f"{p}_{i}")
        for i, m in enumerate(models)
        for p in P
    ]
    has = [F.max((F.col("model") == m).cast("double")).alias(f"has_{i}") for i, m in enumerate(models)]
    return probs.groupBy(*keys).agg(*cols, *has)


def _trial_cells(wide: DataFrame, trials: list[list[float]]) -> list[dict]:
    """Nine counts per trial from one job over the wide table."""
    preds = []
    for i, ws in enumerate(trials):
        total = sum(ws)
        if total == 0:
            preds.append(F.lit(-1).alias(f"t{i}"))
            continue
        there = sum((F.col(f"has_{j}") * F.lit(float(w)) for j, w in enumerate(ws) if w > 0), F.lit(0.0))
        votes = [
            F.try_divide(sum((F.col(f"{p}_{j}") * F.lit(float(w)) for j, w in enumerate(ws) if w > 0), F.lit(0.0)), there)
            for p in P
        ]
        preds.append(F.when(there > 0, argmax3(*votes)).otherwise(-1).alias(f"t{i}"))  # -1: no model with weight
    rows = wide.select("label", *preds)
    hit = lambda i, a, b: (F.col("label") == a) & (F.col(f"t{i}") == b)
    aggs = [
        F.count_if(hit(i, a, b)).alias(f"t{i}_{a}{b}") for i in range(len(trials)) for a in range(3) for b in range(3)
    ]
    row = rows.agg(*aggs).first()
    return [{(a, b): row[f"t{i}_{a}{b}"] for a in range(3) for b in range(3)} for i in range(len(trials))]


def _f1_of(cells: dict) -> float:
    out, seen = 0.0, 0
    for c in range(3):
        sup = sum(cells[c, j] for j in range(3))
        pre = sum(cells[j, c] for j in range(3))
        if sup + pre:
            out, seen = out + 2 * cells[c, c] / (sup + pre), seen + 1
    return out / seen if seen else 0.0


def coordinate_ascent(
    probs: DataFrame,
    start: Weights,
    keys: list[str],
    grid: list[float] = WEIGHT_GRID,
    gain: float = 1e-6,
    max_passes: int = 10,
) -> tuple[Weights, float]:
    """Visit models in order and keep the grid weight that helps; repeat until nothing does.

    The documents are stored once in wide form; every visit scores all other grid
    values of a model in one job that returns nine counts per value.
    """
    spark, models = probs.sparkSession, list(start)
    wide = materialise(spark, scratch_path(spark, "votes"), lambda: wide_probabilities(probs, models, keys))
    weights = [float(start[m]) for m in models]
    best = _f1_of(_trial_cells(wide, [weights])[0])
    for _ in range(max_passes):
        moved = False
        for i in range(len(models)):
            values = [w for w in grid if w != weights[i]]
            trials = [weights[:i] + [w] + weights[i + 1 :] for w in values]
            keep = weights[i]
            for w, cells in zip(values, _trial_cells(wide, trials)):
                f1 = _f1_of(cells)
                if f1 > best + gain:
                    best, keep = f1, w
            if keep != weights[i]:
                weights[i], moved = keep, True
        if not moved:
            break
    return {m: w for m, w in zip(models, weights) if w > 0}, best


def keep_better_config(stored: DataFrame | None, found: DataFrame, gain: float = 1e-6) -> DataFrame:
    """The found configuration if it beats the stored one, else the stored one."""
    if stored is None:
        return found
    best = stored.agg(F.max("oof_f1_macro")).first()[0]
    return found if found.agg(F.max("oof_f1_macro")).first()[0] > best + gain else stored


def weight_configs(n_models: int, grid: list[float] = WEIGHT_GRID, at: np.ndarray | None = None) -> np.ndarray:
    """Grid weightings by number (all if ``at`` is None), in the order of their digits; a row each."""
    base = len(grid)
    at = np.arange(base**n_models) if at is None else at
    digits = (at[:, None] // base ** np.arange(n_models - 1, -1, -1)) % base
    return np.array(grid, dtype=float)[digits]


def is_least(configs: np.ndarray, grid: list[float] = WEIGHT_GRID) -> np.ndarray:
    """One weighting of every proportional set: the one whose steps have no common divisor; the empty one is none."""
    step = min(w for w in grid if w > 0)
    return np.gcd.reduce(np.rint(configs / step).astype(np.int64), axis=1) == 1


CONFIG_BLOCK = 4096  # weightings that one row of work stands for


def weight_search(
    probs: DataFrame, models: list[str], keys: list[str], grid: list[float] = WEIGHT_GRID, chunk: int = 1024
) -> DataFrame:
    """``(config, w_<model>..., f1_macro)`` for every subset and grid weighting.

    Weightings are never shipped: every document stands beside each number of a block of weightings, and the
    task derives the weights from the number.  Nine counts per batch and configuration are summed.  A model that
    lacks a document is left out of its divisor; a document no weighted model scored counts as not predicted.
    """
    n = len(models)
    blocks = -(-(len(grid) ** n) // CONFIG_BLOCK)
    wide = wide_probabilities(probs, models, keys)
    work = wide.select("label", *[c for c in wide.columns if c[:1] in "ph" and "_" in c])
    work = work.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cols = [[f"{p}_{i}" for i in range(n)] for p in P]
    has = [f"has_{i}" for i in range(n)]
    schema = T.StructType(
        [T.StructField("config", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in CELLS]
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, pdf in batch.groupby("block"):
                first = int(block) * CONFIG_BLOCK
                number = np.arange(first, min(first + CONFIG_BLOCK, len(grid) ** n))
                w = weight_configs(n, grid, number)
                keep = is_least(w, grid)
                number, w = number[keep], w[keep]
                label, there = pdf["label"].to_numpy(), pdf[has].to_numpy()
                mats = [pdf[c].to_numpy() for c in cols]
                for lo in range(0, len(w), chunk):
                    part = w[lo : lo + chunk]
                    weight = there @ part.T
                    votes = np.stack([m @ part.T for m in mats]) / np.where(weight > 0, weight, 1)
                    code = np.where(weight > 0, label[:, None] * 3 + votes.argmax(axis=0), -1)
                    cells = np.stack([(code == k).sum(axis=0) for k in range(9)], axis=1)
                    out = pd.DataFrame(cells, columns=CELLS)
                    out.insert(0, "config", number[lo : lo + chunk].astype("int32"))
                    yield out

    counted = work.mapInPandas(count, schema)
    summed = counted.groupBy("config").agg(*[F.sum(c).alias(c) for c in CELLS])
    base = len(grid)
    values = F.array(*[F.lit(float(w)) for w in grid])
    weight = [F.get(values, (F.floor(F.col("config") / base ** (n - 1 - i)) % base).cast("int")) for i in range(n)]
    return summed.select("config", *[w.alias(f"w_{m}") for w, m in zip(weight, models)], macro_f1().alias("f1_macro"))


# --- soft targets and losses --------------------------------------------------------
def soft_targets(probs: DataFrame, weights: Weights, keys: list[str], temperature: float = 2.0) -> DataFrame:
    """Weighted vote, softened: ``(keys, s0, s1, s2)``."""
    vote = weighted_vote(probs, weights, keys)
    soft = soften3([F.col(p) for p in P], temperature)
    return vote.select(*keys, *[s.alias(f"s{i}") for i, s in enumerate(soft)])


def _safe_log(p: Column) -> Column:
    return F.log(F.greatest(p, F.lit(1e-12)))


def smoothed_cross_entropy(rows: DataFrame, by: list[str], class_weights: list[float], smoothing: float = 0.0) -> DataFrame:
    """``(by, loss)``: class-weighted cross-entropy of a probability table.

    Divided by the sum of the rows' class weights; ``smoothing`` moves that share
    of the target evenly over the classes.
    """
    ws = [F.lit(float(w)) for w in class_weights]
    logs = [_safe_log(F.col(p)) for p in P]
    own_w = pick3(F.col("label"), ws)
    hard = -own_w * pick3(F.col("label"), logs)
    spread = -(ws[0] * logs[0] + ws[1] * logs[1] + ws[2] * logs[2]) / 3
    per_row = (1 - smoothing) * hard + smoothing * spread
    return rows.groupBy(*by).agg((F.sum(per_row) / F.sum(own_w)).alias("loss"))


def distillation_loss(
    student: DataFrame,
    teacher: DataFrame | None,
    by: list[str],
    key: str,
    class_weights: list[float],
    alpha: float = 0.5,
    temperature: float = 2.0,
) -> DataFrame:
    """``(by, loss)``: (1 - alpha) weighted CE + alpha T^2 KL(teacher || student at T).

    ``teacher`` holds softened ``s0..s2`` per key; without one the hard loss is used.
    """
    if teacher is None:
        return smoothed_cross_entropy(student, by, class_weights)
    ws = [F.lit(float(w)) for w in class_weights]
    own_w = pick3(F.col("label"), ws)
    hard = -own_w * pick3(F.col("label"), [_safe_log(F.col(p)) for p in P])
    soft = soften3([F.col(p) for p in P], temperature)
    kl = kl3([F.col(f"s{i}") for i in range(3)], soft)
    rows = student.join(teacher.select(key, "s0", "s1", "s2"), key)
    loss = (1 - alpha) * F.sum(hard) / F.sum(own_w) + alpha * temperature**2 * F.avg(kl)
    return rows.groupBy(*by).agg(loss.alias("loss"))


def symmetric_kl(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Mean of KL in both directions between two probability tables over the same keys."""
    a = first.select(key, *[F.col(p).alias(f"a{i}") for i, p in enumerate(P)])
    b = second.select(key, *[F.col(p).alias(f"b{i}") for i, p in enumerate(P)])
    pa, pb = [F.col(f"a{i}") for i in range(3)], [F.col(f"b{i}") for i in range(3)]
    return a.join(b, key).agg((0.5 * (F.avg(kl3(pa, pb)) + F.avg(kl3(pb, pa)))).alias("divergence"))


def grid_report(results: DataFrame, config: str, metric: str, default: str) -> DataFrame:
    """Change of every configuration against the default one, best one marked."""
    everyone = Window.partitionBy(F.lit(0))  # one row per configuration
    base = F.max(F.when(F.col(config) == default, F.col(metric))).over(everyone)
    top = F.max(metric).over(everyone)
    return results.withColumns({"change": F.col(metric) - base, "best": F.col(metric) == top})
