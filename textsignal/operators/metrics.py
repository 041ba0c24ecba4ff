"""Scores from a nine-cell confusion record.

Every score is a formula over the nine counts ``c<gold><pred>``, so one partially
aggregated pass over the rows serves any number of groups (models, folds,
temperatures, weight settings).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.constants import CLASS_NAMES, CONFIDENCE_EDGES, NOISE_THRESHOLDS, TEMPERATURES
from textsignal.functions.hashing import uniform
from textsignal.functions.proba import pred_of, soften3, argmax3
from textsignal.operators.split import head_per_group

CLASSES = range(3)
CELLS = [f"c{i}{j}" for i in CLASSES for j in CLASSES]


def confusion_cells(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """One row per group with the nine counts."""
    hit = lambda i, j: (F.col(label) == i) & (F.col(pred) == j)
    return df.groupBy(*by).agg(*[F.count_if(hit(i, j)).alias(f"c{i}{j}") for i in CLASSES for j in CLASSES])


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _sum(cols: list[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def class_scores(i: int, prefix: str = "c") -> dict[str, Column]:
    """Precision, recall, F1 and support of one class; 0 where undefined."""
    cell = lambda a, b: F.col(f"{prefix}{a}{b}")
    tp = cell(i, i)
    support = _sum([cell(i, j) for j in CLASSES])
    predicted = _sum([cell(j, i) for j in CLASSES])
    return {
        "precision": _ratio(tp, predicted),
        "recall": _ratio(tp, support),
        "f1": _ratio(2 * tp, support + predicted),
        "support": support,
        "predicted": predicted,
    }


def overall_scores(prefix: str = "c") -> dict[str, Column]:
    """Accuracy, macro and weighted averages.

    A class that is neither gold nor predicted takes no part in macro averages.
    """
    per = [class_scores(i, prefix) for i in CLASSES]
    n = _sum([p["support"] for p in per])
    seen = [F.when(p["support"] + p["predicted"] > 0, 1).otherwise(0) for p in per]
    macro = lambda k: _ratio(_sum([p[k] for p in per]), _sum(seen))
    weighted = lambda k: _ratio(_sum([p[k] * p["support"] for p in per]), n)
    return {
        "n": n,
        "accuracy": _ratio(_sum([F.col(f"{prefix}{i}{i}") for i in CLASSES]), n),
        "f1_macro": macro("f1"),
        "f1_weighted": weighted("f1"),
        "precision_macro": macro("precision"),
        "recall_macro": macro("recall"),
    }


def macro_f1(prefix: str = "c") -> Column:
    return overall_scores(prefix)["f1_macro"]


def score(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    cells = confusion_cells(df, by, label, pred)
    return cells.select(*by, *[c.alias(n) for n, c in overall_scores().items()])


def confusion_long(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """``(by, label, pred, n, share)``: counts and row shares, zero cells kept."""
    cells = confusion_cells(df, by, label, pred)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("label"),
                F.lit(j).alias("pred"),
                F.col(f"c{i}{j}").alias("n"),
                _ratio(F.col(f"c{i}{j}"), class_scores(i)["support"]).alias("share"),
            )
            for i in CLASSES
            for j in CLASSES
        ]
    )
    return cells.select(*by, F.inline(rows))


def class_report(df: DataFrame, by: list[str], label: str = "label", pred: str = "pred") -> DataFrame:
    """``(by, row, precision, recall, f1, support)`` for classes, macro and weighted average."""
    cells = confusion_cells(df, by, label, pred)
    per = [class_scores(i) for i in CLASSES]
    total = overall_scores()
    weighted = lambda k: _ratio(_sum([p[k] * p["support"] for p in per]), total["n"])

    def line(name: str, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"), s.alias("support"))

    rows = [line(CLASS_NAMES[i], per[i]["precision"], per[i]["recall"], per[i]["f1"], per[i]["support"]) for i in CLASSES]
    rows.append(line("macro", total["precision_macro"], total["recall_macro"], total["f1_macro"], total["n"]))
    rows.append(line("weighted", weighted("precision"), weighted("recall"), total["f1_weighted"], total["n"]))
    return cells.select(*by, F.inline(F.array(*rows)))


def fold_summary(per_fold: DataFrame, by: list[str], metric: str = "f1_macro") -> DataFrame:
    """Mean and population deviation over folds."""
    return per_fold.groupBy(*by).agg(
        F.count(F.lit(1)).alias("folds"), F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std")
    )


def metric_record(train_scores: DataFrame, test_scores: DataFrame, by: list[str]) -> DataFrame:
    """Flat comparison record: fold means, deviation, train score and overfit gap."""
    names = ["f1_macro", "f1_weighted", "accuracy", "precision_macro", "recall_macro"]
    test = test_scores.groupBy(*by).agg(
        *[F.avg(m).alias(m) for m in names], F.stddev_pop("f1_macro").alias("f1_macro_std")
    )
    train = train_scores.groupBy(*by).agg(F.avg("f1_macro").alias("train_f1_macro"))
    gap = F.col("train_f1_macro") - F.col("f1_macro")
    return test.join(train, by).withColumn("overfit_gap", gap)


def class_distribution(df: DataFrame, by: list[str], pred: str = "pred") -> DataFrame:
    """``(by, pred, n, share)`` with zero rows for classes that are never predicted."""
    counts = df.groupBy(*by).agg(*[F.count_if(F.col(pred) == i).alias(f"n{i}") for i in CLASSES])
    total = F.col("n0") + F.col("n1") + F.col("n2")
    rows = [
        F.struct(F.lit(i).alias("pred"), F.col(f"n{i}").alias("n"), _ratio(F.col(f"n{i}"), total).alias("share"))
        for i in CLASSES
    ]
    return counts.select(*by, F.inline(F.array(*rows)))


def error_types(df: DataFrame, by: list[str]) -> DataFrame:
    """Wrong (label, pred) pairs with counts."""
    wrong = df.filter(F.col("label") != F.col("pred"))
    return wrong.groupBy(*by, "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def error_examples(df: DataFrame, by: list[str], id_col: str, top: int = 4, each: int = 2) -> DataFrame:
    """The first rows of each of the most frequent error types."""
    w = Window.partitionBy(*by).orderBy(F.desc("n"), "label", "pred")
    kinds = error_types(df, by).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    heads = head_per_group(df.filter(F.col("label") != F.col("pred")), [*by, "label", "pred"], [id_col], each)
    return heads.join(kinds, [*by, "label", "pred"])


def validate_predictions(preds: DataFrame, source: DataFrame, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """One row of checks on a prediction table against the ids it must cover."""
    p = preds.groupBy(F.col(id_col).alias("_id")).agg(
        F.count(F.lit(1)).alias("np"),
        F.count_if(F.col(label_col).isNull()).alias("nulls"),
        F.count_if(~F.col(label_col).isin(*CLASSES)).alias("foreign"),
        *[F.count_if(F.col(label_col) == i).alias(f"n{i}") for i in CLASSES],
    )
    s = source.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("ns"))
    both = p.join(s, "_id", "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = both.agg(
        total("np").alias("rows"),
        total("ns").alias("expected"),
        total("nulls").alias("nulls"),
        total("foreign").alias("foreign"),
        F.count_if(F.col("np") > 1).alias("repeated"),
        F.count_if(F.col("np").isNull()).alias("missing"),
        F.count_if(F.col("ns").isNull()).alias("unknown"),
        F.least(*[total(f"n{i}") for i in CLASSES]).alias("smallest"),
        *[(total(f"n{i}") > 0).alias(f"has{i}") for i in CLASSES],
    )
    return sums.select(
        (F.col("rows") == F.col("expected")).alias("row_count_ok"),
        F.lit(sorted(preds.columns) == sorted([id_col, label_col])).alias("columns_ok"),
        (F.col("has0") & F.col("has1") & F.col("has2") & (F.col("foreign") == 0)).alias("labels_ok"),
        (F.col("nulls") == 0).alias("no_nulls"),
        (F.col("repeated") == 0).alias("ids_unique"),
        ((F.col("missing") == 0) & (F.col("unknown") == 0)).alias("ids_match"),
        (F.col("smallest") > 0.01 * F.col("rows")).alias("no_collapse"),
    )


def id_order_mismatches(preds: DataFrame, source: DataFrame, pos_col: str, id_col: str = "id") -> DataFrame:
    """Positions at which two tables hold different ids (tables carry their position)."""
    joined = preds.select(pos_col, F.col(id_col).alias("a")).join(
        source.select(pos_col, F.col(id_col).alias("b")), pos_col, "full_outer"
    )
    return joined.filter(~F.col("a").eqNullSafe(F.col("b")))


# --- calibration --------------------------------------------------------------------
def reliability_table(df: DataFrame, by: list[str]) -> DataFrame:
    """Accuracy and count per confidence bucket (0,.5], (.5,.6] ... (.9,1]."""
    bucket = F.lit(None).cast("double")
    for hi in reversed(CONFIDENCE_EDGES):
        bucket = F.when(F.col("conf") <= hi, F.lit(hi)).otherwise(bucket)
    ok = (F.col("pred") == F.col("label")).cast("double")
    rows = df.withColumn("upper", F.when(F.col("conf") > 0, bucket))
    out = rows.groupBy(*by, "upper").agg(F.avg(ok).alias("accuracy"), F.count("upper").alias("n"))
    return out.filter(F.col("n") > 0)  # rows outside all buckets count as none


def calibration_edges(lo: float = 0.33, hi: float = 1.0, bins: int = 10) -> list[float]:
    step = (hi - lo) / bins
    return [round(lo + i * step, 6) for i in range(bins)] + [hi]


def calibration_curve(df: DataFrame, by: list[str], min_rows: int = 20) -> DataFrame:
    """Accuracy per equal confidence bin [lo, hi); thin bins are left out."""
    edges = calibration_edges()
    bin_id = F.lit(None).cast("int")
    for i in range(len(edges) - 1):
        bin_id = F.when((F.col("conf") >= edges[i]) & (F.col("conf") < edges[i + 1]), F.lit(i)).otherwise(bin_id)
    ok = (F.col("pred") == F.col("label")).cast("double")
    rows = df.withColumn("bin", bin_id)
    out = rows.groupBy(*by, "bin").agg(F.avg(ok).alias("accuracy"), F.count("bin").alias("n"))
    return out.filter(F.col("n") >= max(min_rows, 1))  # rows outside the curve count as none


def temperature_search(df: DataFrame, by: list[str], grid: list[float] = TEMPERATURES) -> DataFrame:
    """``(by, base_f1, best_t, best_f1, gain)``; T = 1 stays unless another is strictly better."""
    temps = F.explode(F.array(*[F.lit(float(t)) for t in grid])).alias("t")
    scaled = df.select(*by, "label", "p0", "p1", "p2", temps)
    ps = soften3([F.col("p0"), F.col("p1"), F.col("p2")], F.col("t"))
    cells = confusion_cells(scaled.withColumn("pred", argmax3(*ps)), [*by, "t"])
    per_t = cells.select(*by, "t", macro_f1().alias("f1"))
    base = confusion_cells(df.withColumn("pred", pred_of()), by).select(*by, macro_f1().alias("base_f1"))
    best = per_t.groupBy(*by).agg(F.max_by(F.struct("t", "f1"), F.struct("f1", -F.col("t"))).alias("b"))
    better = F.round(F.col("b.f1") - F.col("base_f1"), 12) > 0
    picked = base.join(best, by).select(
        *by,
        "base_f1",
        F.when(better, F.col("b.t")).otherwise(F.lit(1.0)).alias("best_t"),
        F.when(better, F.col("b.f1")).otherwise(F.col("base_f1")).alias("best_f1"),
    )
    return picked.withColumn("gain", F.col("best_f1") - F.col("base_f1"))


def prior_scaling(df: DataFrame, by: list[str], grid: list[tuple[float, float, float]], id_col: str = "doc_id") -> DataFrame:
    """Class multipliers tuned on one half and scored on the other, both ways.

    ``(by, tuned_on, config, held_out_gain)``; halves come from a digest of the id.
    """
    half = F.when(uniform("half", F.col(id_col)) < 0.5, 0).otherwise(1)
    configs = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("config"), *[F.lit(float(m)).alias(f"m{c}") for c, m in enumerate(ms)])
                for i, ms in enumerate(grid)
            ]
        )
    )
    rows = df.select(*by, "label", "p0", "p1", "p2", half.alias("half")).select("*", configs)
    pred = argmax3(*[F.col(f"p{c}") * F.col(f"m{c}") for c in CLASSES])
    f1 = confusion_cells(rows.withColumn("pred", pred), [*by, "half", "config"]).select(
        *by, "half", "config", macro_f1().alias("f1")
    )
    neutral = [i for i, ms in enumerate(grid) if len(set(ms)) == 1][0]
    best = f1.groupBy(*by, "half").agg(F.max_by("config", F.struct(F.round("f1", 12), -F.col("config"))).alias("config"))
    other = best.select(*by, F.col("half").alias("tuned_on"), (1 - F.col("half")).alias("half"), "config")
    base = f1.filter(F.col("config") == neutral).select(*by, "half", F.col("f1").alias("base"))
    scored = other.join(f1, [*by, "half", "config"]).join(base, [*by, "half"])
    return scored.select(*by, "tuned_on", "config", (F.col("f1") - F.col("base")).alias("held_out_gain"))


def label_noise(df: DataFrame, by: list[str], thresholds: list[float] = NOISE_THRESHOLDS) -> DataFrame:
    """Confident disagreements with the gold label per threshold, count and percent."""
    wrong = F.col("pred") != F.col("label")
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(wrong & (F.col("conf") >= t)).alias(f"n{i}") for i, t in enumerate(thresholds)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"n{i}").alias("n"),
                (100 * F.col(f"n{i}") / F.col("total")).alias("pct"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    return counts.select(*by, F.inline(rows))


# --- report tables ------------------------------------------------------------------
def leaderboard(records: DataFrame, top: int | None = None) -> DataFrame:
    """Run records by macro-F1, scores rounded to four digits."""
    scores = ["f1_macro", "f1_weighted", "accuracy"]
    table = records.withColumns({c: F.round(c, 4) for c in scores}).orderBy(F.desc("f1_macro"), "tag")
    return table.limit(top) if top else table


def ablation_table(df: DataFrame, group: str, order: str, metric: str) -> DataFrame:
    """Change of a metric against the previous variant of the same group."""
    before = F.lag(metric).over(Window.partitionBy(group).orderBy(order))
    return df.withColumn("delta", F.round(F.col(metric) - before, 4))


def gain_over(df: DataFrame, key: str, metric: str, baseline: str) -> DataFrame:
    """Difference of every row to the named baseline row."""
    base = df.filter(F.col(key) == baseline).agg(F.max(metric).alias("b"))
    return df.withColumn("gain", F.col(metric) - base.scalar())


def run_summary(df: DataFrame, by: list[str]) -> DataFrame:
    """Scores, per-class F1 and predicted distribution of each run as one row."""
    cells = confusion_cells(df, by)
    per = [class_scores(i) for i in CLASSES]
    return cells.select(
        *by,
        *[c.alias(n) for n, c in overall_scores().items()],
        F.struct(*[per[i]["f1"].alias(CLASS_NAMES[i]) for i in CLASSES]).alias("per_class_f1"),
        F.array(*[per[i]["predicted"] for i in CLASSES]).alias("test_dist"),
    )
