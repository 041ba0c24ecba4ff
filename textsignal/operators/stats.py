"""Paired tests: signed-rank over folds, bootstrap over rows, rank-sum AUC."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from textsignal.constants import SEED
from textsignal.functions.hashing import digest


def signed_rank(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One-sided Wilcoxon test that ``a`` exceeds ``b``: ``(n, w_plus, p_value)``.

    Pairs are few (one per fold).  Zero differences are dropped, ties share their mean rank.  The
    p-value is exact: sign patterns are counted by their doubled rank sum, one pair after the other, so the work
    grows with the cube of the pairs and not with the number of patterns.
    """
    d = F.round(F.col(a) - F.col(b), 12)
    diffs = pairs.select(d.alias("d")).filter("d <> 0")
    size = F.abs("d")
    everyone = Window.partitionBy(F.lit(0))
    rank = F.rank().over(everyone.orderBy(size)) + (F.count(F.lit(1)).over(Window.partitionBy(size)) - 1) / 2
    one = diffs.select("d", rank.alias("r")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("d") > 0, F.col("r")).otherwise(0.0)).alias("w_plus"),
        F.sort_array(F.collect_list((2 * F.col("r")).cast("int"))).alias("ranks"),
    )
    shares = F.expr(
        """aggregate(ranks, array(1D), (ways, r) -> zip_with(
             concat(ways, array_repeat(0D, r)), concat(array_repeat(0D, r), ways), (x, y) -> (x + y) / 2))"""
    )
    reached = F.expr("slice(shares, cast(round(2 * w_plus) AS INT) + 1, size(shares))")
    return one.withColumn("shares", shares).select(
        "n", F.coalesce("w_plus", F.lit(0.0)).alias("w_plus"), F.coalesce(F.aggregate(reached, F.lit(0.0), lambda x, y: x + y), F.lit(1.0)).alias("p_value")
    )


def bootstrap_difference(
    df: DataFrame, label: str, pred_a: str, pred_b: str, replicates: int = 1000, seed: int = SEED, partitions: int = 8
) -> DataFrame:
    """``(ci_low, ci_high, observed)`` of macro-F1(a) - macro-F1(b), 95 %.

    A resample of rows only matters through the 27 counts of (gold, a, b), and
    those follow one multinomial draw; so the rows are read once, whatever the
    number of replicates.
    """
    code = F.col(label) * 9 + F.col(pred_a) * 3 + F.col(pred_b)
    counts = np.zeros(27)
    for row in df.groupBy(code.alias("k")).count().collect():  # 27 rows at most
        counts[row["k"]] = row["count"]
    total = int(counts.sum())
    share = counts / counts.sum()

    def f1_of(cells: np.ndarray, axis: int) -> float:
        m = cells.reshape(3, 3, 3).sum(axis=axis)
        sup, pre = m.sum(axis=1), m.sum(axis=0)
        seen = (sup + pre) > 0
        return float((2 * np.diag(m)[seen] / (sup + pre)[seen]).mean())

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf["id"]:
                cells = np.random.default_rng([seed, int(r)]).multinomial(total, share)
                out.append(f1_of(cells, 2) - f1_of(cells, 1))
            yield pd.DataFrame({"d": out})

    spark = df.sparkSession
    diffs = spark.range(0, replicates, 1, partitions).mapInPandas(
        draw, T.StructType([T.StructField("d", T.DoubleType())])
    )
    return diffs.agg(
        F.percentile("d", F.lit(0.025)).alias("ci_low"),
        F.percentile("d", F.lit(0.975)).alias("ci_high"),
        F.lit(f1_of(counts, 2) - f1_of(counts, 1)).alias("observed"),
    )


# Poisson(1) weights: the weight of a uniform number is how many of these bounds it reaches.  Beyond the last the
# chance is under 2^-32, the grain of the uniform numbers.
POISSON_BOUNDS = [math.fsum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(13)]
PER_DIGEST = 4  # numbers of 32 bits in one md5


def poisson_bootstrap(
    df: DataFrame, id_col: str, label: str, pred_a: str, pred_b: str, replicates: int = 1000, seed: int = SEED
) -> DataFrame:
    """``(replicates, ci_low, ci_high, observed)`` of macro-F1(a) - macro-F1(b), 95 %, by weighted rows.

    Every row has a Poisson(1) weight in every replicate, from a digest of its id: the same rows get the same
    weights wherever they are stored, and tables that share rows share their weights.  Rows are read once; a task
    keeps 27 sums a replicate, and these sums are all that is shuffled.  A class that a replicate has neither
    as label nor as prediction is left out of its mean.  An empty table gives nulls.
    """
    if replicates % PER_DIGEST:
        raise ValueError(f"replicates must be a multiple of {PER_DIGEST}")
    cell = (F.col(label) * 9 + F.col(pred_a) * 3 + F.col(pred_b)).alias("cell")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(replicates // PER_DIGEST - 1))).alias("block")
    rows = df.select(F.col(id_col).alias("_id"), cell, blocks).withColumn("_d", digest(seed, "poisson", F.col("_id"), F.col("block")))

    def weight(nth: int):
        u = F.conv(F.substring("_d", 8 * nth + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
        return sum(((u >= F.lit(bound)).cast("int") for bound in POISSON_BOUNDS), F.lit(0))

    sums = [F.sum(weight(i)).alias(f"w{i}") for i in range(PER_DIGEST)]
    cells = rows.groupBy("block", "cell").agg(*sums)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("nth"), F.col(f"w{i}").alias("w")) for i in range(PER_DIGEST)])).alias("e")
    cells = cells.select((F.col("block") * PER_DIGEST).alias("_first"), "cell", each)
    cells = cells.select((F.col("_first") + F.col("e.nth")).alias("replicate"), "cell", F.col("e.w").alias("w"))
    plain = df.groupBy(cell).agg(F.count(F.lit(1)).alias("w")).select(F.lit(-1).alias("replicate"), "cell", "w")
    gold, a, b = F.floor(F.col("cell") / 9), F.floor(F.col("cell") / 3) % 3, F.col("cell") % 3

    def macro(pred):
        parts, seen = [], []
        for c in range(3):
            of = lambda cond: F.sum(F.when(cond, F.col("w")).otherwise(0))
            size = of(gold == c) + of(pred == c)
            parts.append(F.when(size > 0, 2 * of((gold == c) & (pred == c)) / size).otherwise(0.0))
            seen.append((size > 0).cast("int"))
        return F.try_divide(parts[0] + parts[1] + parts[2], seen[0] + seen[1] + seen[2])

    diffs = plain.unionByName(cells).groupBy("replicate").agg((macro(a) - macro(b)).alias("d"))
    drawn = F.when(F.col("replicate") >= 0, F.col("d"))
    return diffs.agg(
        F.count(drawn).alias("replicates"),
        F.percentile(drawn, F.lit(0.025)).alias("ci_low"),
        F.percentile(drawn, F.lit(0.975)).alias("ci_high"),
        F.max(F.when(F.col("replicate") < 0, F.col("d"))).alias("observed"),
    )


def rank_sum_auc(df: DataFrame, score: str, positive: str, buckets: int = 4096) -> DataFrame:
    """Exact area under the ROC curve of a score in [0, 1], ties counted half.

    Equal scores are merged first.  Score ranges are summed on their own and
    shifted by the negatives of lower ranges, so no task sorts all scores.
    """
    merged = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(positive) == 1).alias("pos"), F.count_if(F.col(positive) == 0).alias("neg")
    )
    merged = merged.withColumn("b", F.floor(F.col("s") * buckets))
    totals = merged.groupBy("b").agg(F.sum("neg").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"))
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    under = F.coalesce(F.sum("neg").over(inside), F.lit(0))
    rows = merged.withColumn("under", under).join(offsets, "b")
    won = F.sum(F.col("pos") * (F.col("lower") + F.col("under") + F.col("neg") / 2))
    return rows.agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"))
