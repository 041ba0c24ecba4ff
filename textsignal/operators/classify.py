"""Classifiers and model selection on MLlib, and the closed forms that need none."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F, types as T

from textsignal.constants import SEED
from textsignal.functions.hashing import uniform
from textsignal.functions.proba import argmax3
from textsignal.operators.joint_fit import fit_all, margin_vectors
from textsignal.operators.metrics import CELLS, confusion_cells, macro_f1, metric_record, overall_scores, score
from textsignal.operators.sparse import FoldVectors
from textsignal.operators.split import top_per_group
from textsignal.session import scratch_path

P = ["p0", "p1", "p2"]


# --- baselines and naive Bayes in closed form -------------------------------------------
def majority_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Most frequent training class for every test row; the lowest wins ties."""
    counts = [F.count_if(F.col("label") == c).alias(f"n{c}") for c in range(3)]
    modal = train.agg(*counts).select(argmax3(F.col("n0"), F.col("n1"), F.col("n2")).alias("pred"))
    return test.withColumn("pred", modal.scalar())


def random_baseline(train: DataFrame, test: DataFrame, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Class drawn with the training shares from a digest of the id."""
    shares = train.agg(
        F.struct(*[F.avg((F.col("label") <= c).cast("double")).alias(f"c{c}") for c in range(2)]).alias("s")
    )
    rows = test.withColumn("_s", shares.scalar()).withColumn("_u", uniform(seed, "random", F.col(id_col)))
    pred = F.when(F.col("_u") < F.col("_s.c0"), 0).when(F.col("_u") < F.col("_s.c1"), 1).otherwise(2)
    return rows.withColumn("pred", pred).drop("_s", "_u")


def naive_bayes_folds(
    counts: DataFrame, rows: DataFrame, k: int, alpha: float, complement: bool = False, max_features: int = 20000
) -> DataFrame:
    """``(doc_id, label, s0, s1, s2, pred)``: binary-feature naive Bayes, every row scored by the model of the other folds.

    Terms are counted once per (term, fold, class); what a fold's model has seen is the total minus the fold's own
    counts, its vocabulary too.  Rows without a known term get the prior.
    """
    seen = stored(counts.select("doc_id", "term").join(rows.select("doc_id", "label", "fold"), "doc_id"), "nb-terms")
    hits = [F.count_if(F.col("label") == c).alias(f"n{c}") for c in range(3)]
    cells = seen.groupBy("term", "fold").agg(*hits)
    every = cells.groupBy("term").agg(  # a term of one text is in no fold's vocabulary
        *[F.sum(f"n{c}").alias(f"t{c}") for c in range(3)],
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n0", "n1", "n2")))).alias("own"),  # k entries
    )
    per_fold = every.filter("t0 + t1 + t2 >= 2").withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    own = F.try_element_at("own", F.col("fold"))
    left = [(F.col(f"t{c}") - F.coalesce(own[f"n{c}"], F.lit(0))).alias(f"n{c}") for c in range(3)]
    known = per_fold.select("fold", "term", *left).withColumn("df", F.col("n0") + F.col("n1") + F.col("n2")).filter("df >= 2")
    vocabulary = top_per_group(known, ["fold"], [F.desc("df"), "term"], max_features, ["term"])
    m = [(F.col("df") - F.col(f"n{c}")) if complement else F.col(f"n{c}") for c in range(3)]
    vocabulary = stored(vocabulary.select("fold", "term", *[x.alias(f"m{c}") for c, x in enumerate(m)]), "nb-vocabulary")
    totals = vocabulary.groupBy("fold").agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"m{c}").alias(f"s{c}") for c in range(3)])

    def weight(c: int):
        w = F.log((F.col(f"m{c}") + F.lit(alpha)) / (F.col(f"s{c}") + F.lit(alpha) * F.col("v")))
        return (-w if complement else w).alias(f"w{c}")

    weights = vocabulary.join(F.broadcast(totals), "fold").select("fold", "term", *[weight(c) for c in range(3)])
    sums = seen.join(F.broadcast(weights), ["fold", "term"])  # folds x max_features rows at most
    sums = sums.groupBy("doc_id").agg(*[F.sum(f"w{c}").alias(f"w{c}") for c in range(3)])

    sizes = rows.groupBy("fold").agg(*hits)
    all_rows = sizes.agg(F.struct(*[F.sum(f"n{c}").alias(f"a{c}") for c in range(3)]).alias("a"))
    rest = sizes.withColumn("_a", all_rows.scalar())
    rest = rest.select("fold", *[(F.col(f"_a.a{c}") - F.col(f"n{c}")).alias(f"r{c}") for c in range(3)])
    total = F.col("r0") + F.col("r1") + F.col("r2")
    prior = rest.select("fold", *[(F.lit(0.0) if complement else F.log(F.col(f"r{c}") / total)).alias(f"b{c}") for c in range(3)])
    scored = rows.select("doc_id", "label", "fold").join(F.broadcast(prior), "fold").join(sums, "doc_id", "left")
    s = [F.col(f"b{c}") + F.coalesce(f"w{c}", F.lit(0.0)) for c in range(3)]
    out = scored.select("doc_id", "label", *[x.alias(f"s{c}") for c, x in enumerate(s)])
    return out.withColumn("pred", argmax3(*[F.round(f"s{c}", 9) for c in range(3)]))


def every_fold(rows: DataFrame, k: int, run: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``run(train, test)`` of each of ``k`` folds in one table, so every row is scored once."""
    parts = [run(rows.filter(F.col("fold") != f), rows.filter(F.col("fold") == f)) for f in range(k)]
    return reduce(DataFrame.unionByName, parts)


# --- MLlib estimators -------------------------------------------------------------------
def make_estimator(kind: str, n_rows: int = 1, weight_col: str | None = None, **params) -> Estimator:
    """Estimators by name; ``C`` is turned into a penalty of 1 / (C n)."""
    weighted = {"weightCol": weight_col} if weight_col else {}
    if kind == "logistic":
        reg = 1.0 / (params.pop("C", 1.0) * max(n_rows, 1))
        return LogisticRegression(family="multinomial", regParam=reg, standardization=False, **weighted, **params)
    if kind == "svm":
        reg = 1.0 / (params.pop("C", 1.0) * max(n_rows, 1))
        return OneVsRest(classifier=LinearSVC(regParam=reg, standardization=False, **params), parallelism=3, **weighted)
    if kind == "naive_bayes":
        return NaiveBayes(smoothing=params.pop("alpha", 1.0), **weighted, **params)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(seed=SEED, **params)
    if kind == "forest":
        return RandomForestClassifier(seed=SEED, **weighted, **params)
    if kind == "boosted":
        return OneVsRest(classifier=GBTClassifier(seed=SEED, **params), parallelism=3, **weighted)
    raise ValueError(f"unknown estimator {kind!r}")


def with_probabilities(predictions: DataFrame, margin_scale: float = 2.0) -> DataFrame:
    """``p0..p2`` and ``pred`` from MLlib output; one-vs-rest margins become normalised sigmoids."""
    if "probability" in predictions.columns:
        probs = vector_to_array("probability")
        cols = [F.coalesce(F.get(probs, F.lit(c)), F.lit(0.0)) for c in range(3)]
    else:
        raw = vector_to_array("rawPrediction")
        sig = [1 / (1 + F.exp(-margin_scale * F.coalesce(F.get(raw, F.lit(c)), F.lit(-50.0)))) for c in range(3)]
        total = sig[0] + sig[1] + sig[2]
        cols = [s / total for s in sig]
    out = predictions.withColumns({p: c for p, c in zip(P, cols)})
    return out.withColumn("pred", argmax3(*[F.col(p) for p in P]))


Featurise = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back: fitting passes over its input many times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def as_is(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    return train, test


class Columns:
    """Features that are made as the rows are read: ``build(train, test, fold)`` gives both and the training rows' number.

    They cost less than writing them, so cross-validation stores nothing per fold.  With ``joint``, the texts of all
    folds that these features are of, linear models of every fold are fitted side by side.
    """

    def __init__(self, build: Callable[[DataFrame, DataFrame, int], tuple[DataFrame, DataFrame, int]], joint: FoldVectors | None = None):
        self.build, self.joint = build, joint


class FoldFeatures(Columns):
    """Features of every fold, prepared once however many settings are tried on them."""

    def __init__(self, features: Columns):
        made = {}

        def build(train: DataFrame, test: DataFrame, fold: int) -> tuple[DataFrame, DataFrame, int]:
            if fold not in made:
                made[fold] = features.build(train, test, fold)
            return made[fold]

        super().__init__(build, features.joint)


def joint_of(featurise: Featurise | Columns, k: int) -> FoldVectors | None:
    joint = getattr(featurise, "joint", None)
    return joint if joint is not None and joint.k == k else None


def cross_validate(
    rows: DataFrame,
    make: Callable[[int], Estimator],
    name: str,
    k: int,
    featurise: Featurise | Columns = as_is,
    prepare_train: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = 4,
    is_stored: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Out-of-fold table and flat metric record of one model.

    ``rows`` has ``doc_id, label, fold``; ``make`` gets the number of training rows of the fold.  Features are
    built inside the fold from its training rows.  Test predictions of each fold are appended to a stored
    table; of the training predictions only the nine counts are kept.
    """
    spark, started = rows.sparkSession, time.time()
    path = scratch_path(spark, f"oof-{name}")
    rows = rows if is_stored else stored(rows, f"rows-{name}")

    def run(fold: int) -> dict:
        train, test = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        n = None
        if isinstance(featurise, Columns):
            train, test, n = featurise.build(train, test, fold)
        elif featurise is not as_is:
            train, test = (stored(part, f"fold-{name}") for part in featurise(train, test))
        if prepare_train:
            train, n = stored(prepare_train(train), f"train-{name}"), None
        model = make(train.count() if n is None else n).fit(train)
        got = with_probabilities(model.transform(test)).select("doc_id", "label", F.lit(fold).alias("fold"), *P, "pred")
        got.write.mode("overwrite").parquet(f"{path}/part={fold}")
        cells = confusion_cells(with_probabilities(model.transform(train)), []).first().asDict()
        return {"fold": fold, **cells}

    fitted = fit_all(joint_of(featurise, k), make) if prepare_train is None else None
    if fitted is not None:
        got = fitted.scored().withColumn("pred", argmax3(*[F.col(p) for p in P]))
        got.write.parquet(f"{path}/part=-1")
        train_cells = [{"fold": f, **dict(zip(CELLS, counts.ravel().astype(int)))} for f, counts in enumerate(fitted.training_cells())]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            train_cells = list(pool.map(run, range(k)))
    oof = spark.read.parquet(path).drop("part").withColumn("model", F.lit(name))
    seen = spark.createDataFrame(pd.DataFrame(train_cells)[["fold", *CELLS]])
    train_scores = seen.select(F.lit(name).alias("model"), *[c.alias(n) for n, c in overall_scores().items()])
    test_scores = score(oof, ["model", "fold"])
    record = metric_record(train_scores, test_scores, ["model"]).withColumn("time_s", F.lit(time.time() - started))
    return oof, record


def platt_calibrate(margins: DataFrame, margin_col: str = "rawPrediction") -> DataFrame:
    """Sigmoid per class fitted on out-of-fold margins, normalised over classes."""
    raw = vector_to_array(margin_col)
    keep = [c for c in margins.columns if c != margin_col]
    rows = margins.select(*keep, *[F.get(raw, F.lit(c)).alias(f"m{c}") for c in range(3)])
    for c in range(3):
        one = rows.withColumn("_x", array_to_vector(F.array(f"m{c}")))
        one = one.withColumn("_y", (F.col("label") == c).cast("double"))
        fitted = LogisticRegression(featuresCol="_x", labelCol="_y").fit(one)
        a, b = float(fitted.coefficients[0]), float(fitted.intercept)
        rows = rows.withColumn(f"_s{c}", 1 / (1 + F.exp(-(F.lit(a) * F.col(f"m{c}") + F.lit(b)))))
    total = F.col("_s0") + F.col("_s1") + F.col("_s2")
    out = rows.withColumns({p: F.col(f"_s{c}") / total for c, p in enumerate(P)})
    return out.withColumn("pred", argmax3(*[F.col(p) for p in P])).drop(*[f"_s{c}" for c in range(3)], "m0", "m1", "m2")


def oof_margins(
    rows: DataFrame, make: Callable[[int], Estimator], k: int, featurise: Featurise | Columns = as_is, parallelism: int = 4, is_stored: bool = False
) -> DataFrame:
    """Stored out-of-fold ``rawPrediction`` of every row; features are built inside the fold."""
    spark = rows.sparkSession
    path = scratch_path(spark, "margins")
    rows = rows if is_stored else stored(rows, "margin-rows")

    def run(fold: int) -> None:
        train, test = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
        n = None
        if isinstance(featurise, Columns):
            train, test, n = featurise.build(train, test, fold)
        elif featurise is not as_is:
            train, test = (stored(part, "margin-fold") for part in featurise(train, test))
        got = make(train.count() if n is None else n).fit(train).transform(test).select("doc_id", "label", "fold", "rawPrediction")
        got.write.mode("overwrite").parquet(f"{path}/part={fold}")

    fitted = fit_all(joint_of(featurise, k), make)
    if fitted is not None:
        margin_vectors(fitted.scored(margins=True)).write.parquet(f"{path}/part=-1")
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(run, range(k)))
    return spark.read.parquet(path).drop("part")


# --- model selection --------------------------------------------------------------------
class MacroF1(Evaluator):
    """Macro-F1 of a prediction table as an MLlib evaluator."""

    def _evaluate(self, dataset: DataFrame) -> float:
        rows = dataset.withColumn("pred", F.col("prediction").cast("int"))
        return float(confusion_cells(rows, []).select(macro_f1()).first()[0])

    def isLargerBetter(self) -> bool:
        return True


def random_grid(estimator, space: dict[str, list], trials: int, seed: int = SEED) -> list[dict]:
    """Reproducible random settings from lists of values, without repeats."""
    import random

    rng, out, seen = random.Random(seed), [], set()
    size = 1
    for values in space.values():
        size *= len(values)
    while len(out) < min(trials, size):
        pick = {name: rng.choice(values) for name, values in space.items()}
        key = tuple(pick.values())
        if key not in seen:
            seen.add(key)
            out.append({estimator.getParam(name): value for name, value in pick.items()})
    return out


def search(rows: DataFrame, estimator: Estimator, grid: list[dict], k: int, parallelism: int = 2) -> DataFrame:
    """``(setting, f1_macro, best)`` of every parameter setting under the same folds."""
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=MacroF1(), foldCol="fold", numFolds=k, parallelism=parallelism
    )
    scores = cv.fit(stored(rows, "search-rows")).avgMetrics
    top = max(range(len(scores)), key=lambda i: (scores[i], -i))
    table = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(g.items(), key=lambda e: e[0].name)), float(s), i == top)
        for i, (g, s) in enumerate(zip(grid, scores))
    ]
    return rows.sparkSession.createDataFrame(table, "setting string, f1_macro double, best boolean")


def hard_vote(preds: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent predicted class over models; the lowest wins ties."""
    counts = preds.groupBy(*keys).agg(*[F.count_if(F.col("pred") == c).alias(f"n{c}") for c in range(3)])
    return counts.select(*keys, argmax3(F.col("n0"), F.col("n1"), F.col("n2")).alias("pred"))


def meta_table(probs: DataFrame, models: list[str], keys: list[str]) -> DataFrame:
    """One row per document with three probabilities per base model."""
    pick = lambda m, p: F.max(F.when(F.col("model") == m, F.col(p)))
    return probs.groupBy(*keys).agg(*[pick(m, p).alias(f"{m}_{p}") for m in models for p in P])


def stack(probs: DataFrame, models: list[str], keys: list[str], k: int, name: str = "stack") -> tuple[DataFrame, DataFrame]:
    """Logistic meta-learner over the base models' out-of-fold probabilities, same folds."""
    table = meta_table(probs, models, keys)
    cols = [F.coalesce(F.col(f"{m}_{p}"), F.lit(0.0)) for m in models for p in P]
    rows = table.select(*keys, array_to_vector(F.array(*cols)).alias("features"))
    return cross_validate(rows, lambda n: LogisticRegression(regParam=0.01), name, k)


def compare_variants(records: dict[str, DataFrame], base: str) -> DataFrame:
    """Scores of variants under the same folds and their difference to ``base``."""
    table = None
    for name, rec in records.items():
        one = rec.select(F.lit(name).alias("variant"), "f1_macro", "f1_macro_std")
        table = one if table is None else table.unionByName(one)
    ref = records[base].agg(F.max("f1_macro"))
    return table.withColumn("delta", F.col("f1_macro") - ref.scalar())


def adversarial_rows(left: DataFrame, right: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Both tables with ``label`` = 1 for the second: can a classifier tell them apart?"""
    mark = lambda df, v: df.withColumn("label", F.lit(v))
    return mark(left, 0).unionByName(mark(right, 1))


Predictor = Callable[[pd.DataFrame], pd.DataFrame]


def predict_table(df: DataFrame, load: Callable[[], Predictor], id_col: str, columns: list[str]) -> DataFrame:
    """Score rows with a supplied batch predictor.

    ``load`` runs once per task; the predictor maps a batch to ``p0, p1, p2``.
    """
    schema = T.StructType([df.schema[id_col]] + [T.StructField(p, T.DoubleType()) for p in P])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor = load()
        for pdf in batches:
            got = predictor(pdf)
            yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), **{p: got[p].to_numpy() for p in P}})

    return df.select(id_col, *[c for c in columns if c != id_col]).mapInPandas(run, schema)
