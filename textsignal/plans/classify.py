"""Registered queries: classifiers, model selection, stacking."""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Row, functions as F

from textsignal.constants import SEED
from textsignal.functions import surface
from textsignal.functions.clean import fix_text
from textsignal.functions.proba import map_model_label
from textsignal.operators import classify as cl
from textsignal.operators import metrics as m
from textsignal.operators import sparse as sp
from textsignal.operators.dense import smote
from textsignal.operators.ensemble import equal_vote
from textsignal.operators.features import SURFACE_COLUMNS
from textsignal.operators.joins import place_by
from textsignal.operators.split import stratified_folds, with_class_weights
from textsignal.operators.stats import rank_sum_auc
from textsignal.operators.tokens import full_pipeline
from textsignal.plans.evaluation import preds, rounded
from textsignal.plans.registry import query
from textsignal.plans.views import N_FOLDS, sql_uniform
from textsignal.session import drop_stored

K = 5


def text_rows(t) -> DataFrame:
    """Labelled texts with folds."""
    return stratified_folds(t.social_gold, "doc_id", "label", K)


def stored_texts(rows: DataFrame, name: str) -> DataFrame:
    """Stored in parts enough for all cores: reading a text costs much more than its bytes, by which parts are put together."""
    return cl.stored(place_by(rows, "doc_id"), name)


def surface_table(rows: DataFrame) -> DataFrame:
    cols = surface.surface_columns(F.col("text"))
    return rows.select("doc_id", "label", "fold", *[cols[c].cast("double").alias(c) for c in SURFACE_COLUMNS])


def vector_rows(t) -> DataFrame:
    """The given dense vectors with three classes and folds."""
    rows = t.read("embeddings").select(
        F.col("vec_id").alias("doc_id"), (F.col("label") % 3).cast("int").alias("label"), array_to_vector("embedding").alias("features")
    )
    return stratified_folds(rows, "doc_id", "label", K)


def weighted(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Class weights of the training rows."""
    return with_class_weights(train, "label"), test.withColumn("weight", F.lit(1.0))


def class_weight(sizes: list[tuple[int, int]]) -> Column:
    """Weight n / (k * count) by the row's ``label``, from the sizes of parts of the classes."""
    n, labels = sum(size for _, size in sizes), {label for label, _ in sizes}
    weight = F.lit(None).cast("double")
    for k in labels:
        weight = F.when(F.col("label") == k, n / (len(labels) * sum(size for label, size in sizes if label == k))).otherwise(weight)
    return weight


def surface_cells(rows: DataFrame) -> list[Row]:
    """One aggregation has the moments of every fold and class; the driver gets a row for each."""
    moments = [f(c).alias(f"{n}_{c}") for c in SURFACE_COLUMNS for n, f in (("m", F.avg), ("v", F.var_pop))]
    return rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"), *moments).collect()


def surface_moments(cells: list[Row], fold: int) -> list[tuple[float, float]]:
    """Mean and deviation of each column in a fold's training rows, put together from the other folds'."""
    seen, found = [r for r in cells if r["fold"] != fold], []
    n = sum(r["n"] for r in seen)
    for c in SURFACE_COLUMNS:
        mean = sum(r["n"] * r[f"m_{c}"] for r in seen) / n
        found.append((mean, (sum(r["n"] * (r[f"v_{c}"] + (r[f"m_{c}"] - mean) ** 2) for r in seen) / n) ** 0.5))
    return found


def scaled_surface(rows: DataFrame):
    """Surface columns scaled by the moments of a fold's training rows, with their class weights, as column expressions.

    Columns that are constant in the training rows become 0.
    """
    cells = surface_cells(rows)

    def featurise(train: DataFrame, test: DataFrame, fold: int) -> tuple[DataFrame, DataFrame, int]:
        seen = [r for r in cells if r["fold"] != fold]
        n = sum(r["n"] for r in seen)
        scaled = [(F.col(c) - mean) / spread if spread > 0 else F.lit(0.0) for c, (mean, spread) in zip(SURFACE_COLUMNS, surface_moments(cells, fold))]
        weight = class_weight([(r["label"], r["n"]) for r in seen])
        build = lambda df: df.select("doc_id", "label", "fold", array_to_vector(F.array(*scaled)).alias("features"))
        return build(train).withColumn("weight", weight), build(test).withColumn("weight", F.lit(1.0)), n

    return cl.Columns(featurise)


def tfidf_features(rows: DataFrame, preset: str, k: int = K) -> cl.Columns:
    """Vocabulary and idf from a fold's training rows only, in a published preset; every row of the stored ``rows`` gets a vector."""
    found = sp.FoldVectors(rows, preset, k)

    def featurise(train: DataFrame, test: DataFrame, fold: int) -> tuple[DataFrame, DataFrame, int]:
        weights = class_weight([(label, n) for f, label, n in found.sizes if f != fold])
        seen = found.vectors(fold, True).filter(F.col("label").isNotNull()).withColumn("weight", weights)
        return seen, found.vectors(fold, False).withColumn("weight", F.lit(1.0)), found.n_train(fold)

    return cl.Columns(featurise, found)


def predicted(oof: DataFrame, *more: str) -> DataFrame:
    """Every row's out-of-fold probabilities and class."""
    return oof.select("doc_id", *more, "label", "fold", *[F.round(f"p{i}", 6).alias(f"p{i}") for i in range(3)], "pred")


@query(
    "g01_majority",
    """WITH n AS (SELECT f, label, count(*) AS n FROM folds, (SELECT DISTINCT fold AS f FROM folds) WHERE fold <> f GROUP BY ALL),
    m AS (SELECT f AS fold, label AS pred FROM n QUALIFY row_number() OVER (PARTITION BY f ORDER BY n DESC, label) = 1)
    SELECT doc_id, label, fold, pred FROM folds JOIN m USING (fold)""",
    "folds",
)
def g01(t):
    return cl.every_fold(t.folds, N_FOLDS, cl.majority_baseline).select("doc_id", "label", "fold", "pred")


@query(
    "g02_stratified_random",
    f"""WITH s AS (SELECT f AS fold, avg((label <= 0)::INT) AS c0, avg((label <= 1)::INT) AS c1
      FROM folds, (SELECT DISTINCT fold AS f FROM folds) WHERE fold <> f GROUP BY f)
    SELECT doc_id, label, fold, CASE WHEN u < c0 THEN 0 WHEN u < c1 THEN 1 ELSE 2 END AS pred FROM
    (SELECT *, {sql_uniform("'42|random|'||doc_id")} AS u FROM folds) JOIN s USING (fold)""",
    "folds",
)
def g02(t):
    return cl.every_fold(t.folds, N_FOLDS, cl.random_baseline).select("doc_id", "label", "fold", "pred")


def sql_nb(alpha: float, complement: bool) -> str:
    n = "(n0 + n1 + n2 - n{c})" if complement else "n{c}"
    sign = "-" if complement else ""
    prior = "max(0)::DOUBLE" if complement else "ln(avg((label = {c})::INT))"
    share = "ln((m{c} + {a}::DOUBLE) / (sum(m{c}) OVER (PARTITION BY f) + {a}::DOUBLE * count(*) OVER (PARTITION BY f)))"
    w = ", ".join(f"{sign}{share.format(c=c, a=alpha)} AS w{c}" for c in range(3))
    return f"""WITH fs AS (SELECT DISTINCT fold AS f FROM folds),
    toks AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN_]{{2,}}')) AS term FROM corpus),
    seen AS (SELECT doc_id, term, label, fold FROM toks JOIN folds USING (doc_id)),
    cnt AS (SELECT f, term, {', '.join(f'count(*) FILTER (label = {c}) AS n{c}' for c in range(3))} FROM seen, fs WHERE fold <> f GROUP BY ALL HAVING count(*) >= 2),
    vocab AS (SELECT * FROM cnt QUALIFY row_number() OVER (PARTITION BY f ORDER BY n0 + n1 + n2 DESC, term) <= 20000),
    eff AS (SELECT f, term, {', '.join(n.format(c=c) + f' AS m{c}' for c in range(3))} FROM vocab),
    wts AS (SELECT f AS fold, term, {w} FROM eff),
    pri AS (SELECT f AS fold, {', '.join(prior.format(c=c) + f' AS b{c}' for c in range(3))} FROM folds, fs WHERE fold <> f GROUP BY f),
    sums AS (SELECT doc_id, {', '.join(f'sum(w{c}) AS w{c}' for c in range(3))} FROM seen JOIN wts USING (fold, term) GROUP BY doc_id),
    sc AS (SELECT folds.doc_id, label, {', '.join(f'b{c} + coalesce(w{c}, 0) AS s{c}' for c in range(3))} FROM folds JOIN pri USING (fold) LEFT JOIN sums USING (doc_id))
    SELECT doc_id, label, {', '.join(f'round(s{c}, 5) AS s{c}' for c in range(3))},
      CASE WHEN round(s0,9)>=round(s1,9) AND round(s0,9)>=round(s2,9) THEN 0 WHEN round(s1,9)>=round(s2,9) THEN 1 ELSE 2 END AS pred FROM sc"""


def naive_bayes(t, alpha, complement):
    return rounded(cl.naive_bayes_folds(sp.word_term_counts(t.corpus), t.folds, N_FOLDS, alpha, complement), 5)


@query("g03_multinomial_nb", sql_nb(1.0, False), "folds corpus")
def g03(t):
    return naive_bayes(t, 1.0, False)


@query("g03_complement_nb", sql_nb(0.5, True), "folds corpus")
def g03c(t):
    return naive_bayes(t, 0.5, True)


@query("g03_nb_mllib")
def g03m(t):
    rows = stored_texts(text_rows(t), "nb-rows")
    oof, _ = cl.cross_validate(rows, lambda n: cl.make_estimator("naive_bayes"), "nb", K, tfidf_features(rows, "unigram"), is_stored=True)
    return predicted(oof)


def by_penalty(rows: DataFrame, kind: str, grid: list[float], preset: str) -> DataFrame:
    """Out-of-fold tables of one model for every C; features are built once per fold."""
    rows = stored_texts(rows, f"{kind}-rows")
    features = cl.FoldFeatures(tfidf_features(rows, preset))
    parts = []
    for c in grid:
        make = lambda n, c=c: cl.make_estimator(kind, n, "weight", C=c)
        if kind == "svm":
            oof = cl.platt_calibrate(cl.oof_margins(rows, make, K, features, is_stored=True))
        else:
            oof, _ = cl.cross_validate(rows, make, kind, K, features, is_stored=True)
        parts.append(oof.select("doc_id", "label", "fold", "p0", "p1", "p2", "pred", F.lit(c).alias("c")))
    return predicted(reduce(DataFrame.unionByName, parts), "c")


@query("g04_logistic")
def g04(t):
    return by_penalty(text_rows(t), "logistic", [0.1, 1.0, 10.0], "bigram")


@query("g04_logistic_char")
def g04c(t):
    return by_penalty(text_rows(t), "logistic", [1.0], "char")


@query("g05_svm_calibrated")
def g05(t):
    return by_penalty(text_rows(t), "svm", [0.1, 1.0], "unigram")


def _dense_query(name, kind, **params):
    @query(name)
    def run(t):
        weight = None if kind == "mlp" else "weight"
        oof, _ = cl.cross_validate(vector_rows(t), lambda n: cl.make_estimator(kind, n, weight, **params), kind, K, weighted)
        return predicted(oof)


_dense_query("g07_mlp", "mlp", layers=[64, 256, 128, 3], maxIter=100)
_dense_query("g07_mlp_deep", "mlp", layers=[64, 512, 256, 128, 3], maxIter=100)
_dense_query("g08_forest", "forest", numTrees=100)
_dense_query("g08_forest_300", "forest", numTrees=300)
_dense_query("g09_boosted", "boosted", maxIter=100, maxDepth=3)


@query("g10_metric_record")
def g10(t):
    make = lambda n: cl.make_estimator("logistic", n, "weight")
    rows = cl.stored(surface_table(text_rows(t)), "surface")
    _, record = cl.cross_validate(rows, make, "logistic", K, scaled_surface(rows), is_stored=True)
    return rounded(record.drop("time_s"))


@query("g11_out_of_fold")
def g11(t):
    make = lambda n: cl.make_estimator("forest", n, "weight", numTrees=100)
    rows = cl.stored(surface_table(text_rows(t)), "surface")
    oof, _ = cl.cross_validate(rows, make, "forest", K, scaled_surface(rows), is_stored=True)
    return predicted(oof)


FLOORS = ["logistic", "naive_bayes", "svm"]


@query(
    "g10_floors",
    f"""WITH t AS (SELECT max(c) AS most, sum(c)::BIGINT AS n FROM (SELECT label, count(*) AS c FROM gold GROUP BY label))
    SELECT model, n, round(2.0::DOUBLE * most / (most + n) / 3, 6) AS floor, TRUE AS above FROM t, (SELECT unnest({FLOORS}) AS model)""",
    "gold",
)
def g10f(t):
    """Does each text classifier's pooled macro-F1, every row scored out of fold, exceed always giving the commonest class?"""
    rows = stored_texts(stratified_folds(t.social_gold, "doc_id", "label", 3), "floor-rows")
    features = cl.FoldFeatures(tfidf_features(rows, "unigram", 3))
    make = lambda kind: lambda n: cl.make_estimator(kind, n, "weight", **({} if kind == "naive_bayes" else {"C": 10.0}))
    parts = []
    for kind in FLOORS:
        if kind == "svm":
            oof = cl.platt_calibrate(cl.oof_margins(rows, make(kind), 3, features, is_stored=True)).withColumn("model", F.lit(kind))
        else:
            oof, _ = cl.cross_validate(rows, make(kind), kind, 3, features, is_stored=True)
        parts.append(oof.select("model", "label", "pred"))
    every = reduce(DataFrame.unionByName, parts)
    scores = m.score(every, ["model"]).select("model", "f1_macro").join(every.groupBy("model").agg(F.count(F.lit(1)).alias("n")), "model")
    most = t.gold.groupBy("label").count().agg(F.max("count"))
    floor = 2.0 * F.col("most") / (F.col("most") + F.col("n")) / 3
    rows = scores.withColumn("most", most.scalar()).withColumn("floor", floor)
    return rows.select("model", "n", F.round("floor", 6).alias("floor"), (F.col("f1_macro") > F.col("floor")).alias("above"))


@query("g12_search")
def g12(t):
    rows = with_class_weights(vector_rows(t), "label")  # the search compares settings; it keeps no model
    est = LogisticRegression(weightCol="weight", standardization=False)
    grid = cl.random_grid(est, {"regParam": [10.0**e for e in range(-6, 2)], "elasticNetParam": [0.0, 0.25, 0.5]}, 12)
    return rounded(cl.search(rows, est, grid, K, parallelism=4))


@query("g12_search_boosted")
def g12b(t):
    rows = vector_rows(t).withColumn("label", (F.col("label") == 1).cast("int"))
    est = GBTClassifier(seed=SEED)
    space = {
        "maxDepth": [2, 3, 5],
        "maxIter": [10, 20],
        "stepSize": [0.05, 0.1, 0.3],
        "subsamplingRate": [0.6, 0.8, 1.0],
        "featureSubsetStrategy": ["sqrt", "0.5", "all"],
        "minInstancesPerNode": [1, 5, 10],
        "minInfoGain": [0.0, 0.001],
        "maxBins": [16, 32, 64],
        "minWeightFractionPerNode": [0.0, 0.01],
    }
    return rounded(cl.search(rows, est, cl.random_grid(est, space, 6), K, parallelism=4))


@query(
    "g13_hard_vote",
    "SELECT doc_id, label, pred FROM (SELECT doc_id, label, pred, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, pred) AS rn"
    " FROM preds GROUP BY doc_id, label, pred) WHERE rn = 1",
    "preds",
)
def g13(t):
    return cl.hard_vote(preds(t), ["doc_id", "label"])


@query(
    "g13_soft_vote",
    "SELECT doc_id, label, " + ", ".join(f"round(avg(p{i}), 6) AS p{i}" for i in range(3)) + " FROM probs GROUP BY doc_id, label",
    "probs",
)
def g13b(t):
    return rounded(equal_vote(t.probs, ["doc_id", "label"]))


@query(
    "g14_meta_table",
    "SELECT doc_id, label, "
    + ", ".join(f"round(max(p{i}) FILTER (model = '{m}'), 6) AS {m}_p{i}" for m in "abcd" for i in range(3))
    + " FROM probs GROUP BY doc_id, label",
    "probs",
)
def g14(t):
    return rounded(cl.meta_table(t.probs, list("abcd"), ["doc_id", "label"]))


@query("g14_stacking")
def g14s(t):
    folds = stratified_folds(t.gold, "doc_id", "label", K).select("doc_id", "fold")
    oof, _ = cl.stack(t.probs.join(folds, "doc_id"), list("abcd"), ["doc_id", "label", "fold"], K)
    return predicted(oof)


def _record(rows, name, featurise, prepare=None, weight="weight"):
    """``rows`` are stored."""
    make = lambda n: cl.make_estimator("logistic", n, weight)
    return cl.cross_validate(rows, make, name, K, featurise, prepare, is_stored=True)[1]


@query("g15_preprocessing_ablation")
def g15(t):
    """Raw, repaired, cleaned, cleaned and lemmatised, cleaned and stemmed texts under the same folds."""
    rows = stored_texts(text_rows(t), "ablation-rows")
    ids = rows.select("doc_id", "label", "fold")
    cleaned = lambda **k: ids.join(full_pipeline(rows.select("doc_id", "text"), **k).withColumnRenamed("clean", "text"), "doc_id")
    variants = {
        "raw": rows,
        "repaired": rows.withColumn("text", fix_text(F.col("text"))),
        "clean": cleaned(use_lemmatize=False),
        "lemma": cleaned(use_lemmatize=True),
        "stem": cleaned(use_stem=True),
    }

    def run(v):
        texts = rows if v[1] is rows else stored_texts(v[1], v[0])
        features = tfidf_features(texts, "ablation")
        record = _record(texts, v[0], features)
        features.joint.drop()
        if texts is not rows:
            drop_stored(texts)
        return v[0], record

    with ThreadPoolExecutor(2) as pool:  # a variant's texts and terms lie on disk until its record is made
        recs = dict(pool.map(run, variants.items()))
    return rounded(cl.compare_variants(recs, "raw"))


@query("g15_fusion_gain")
def g15f(t):
    """Word features alone, and beside the scaled surface features, under the same folds."""
    rows = stored_texts(text_rows(t), "fusion-rows")

    surfaces = cl.stored(surface_table(rows), "fusion-surface")
    scaler = scaled_surface(surfaces)

    word_features = cl.FoldFeatures(tfidf_features(rows, "unigram"))  # the same words for both

    def fused(train, test, fold):
        *words, n = word_features.build(train, test, fold)
        more = scaler.build(surfaces.filter(F.col("fold") != fold), surfaces.filter(F.col("fold") == fold), fold)[:2]
        both = []
        for a, b in zip(words, more):
            b = b.select("doc_id", F.col("features").alias("more"))
            joined = a.join(b, "doc_id")
            packed = VectorAssembler(inputCols=["features", "more"], outputCol="both").transform(joined)
            both.append(packed.drop("features", "more").withColumnRenamed("both", "features"))
        return both[0], both[1], n

    cells = surface_cells(surfaces)
    moments = [tuple(np.array(v) for v in zip(*surface_moments(cells, f))) for f in range(K)]
    both = word_features.joint.beside(surfaces.select("doc_id", "fold", F.array(*SURFACE_COLUMNS).alias("more")), moments)
    recs = {"words": _record(rows, "words", word_features), "words_and_surface": _record(rows, "fused", cl.Columns(fused, both))}
    return rounded(cl.compare_variants(recs, "words"))


@query("g15_smote_or_weights")
def g15b(t):
    rows = cl.stored(surface_table(text_rows(t)), "surface")

    def balance(train: DataFrame) -> DataFrame:
        dense = train.select("doc_id", "label", vector_to_array("features").alias("v"))
        made = smote(dense, "doc_id", "label", "v").select("doc_id", "label", F.col("vector").alias("v"))
        return dense.unionByName(made).select("doc_id", "label", array_to_vector("v").alias("features"))

    recs = {
        "weights": _record(rows, "weights", scaled_surface(rows)),
        "smote": _record(rows, "smote", scaled_surface(rows), prepare=balance, weight=None),
    }
    return rounded(cl.compare_variants(recs, "weights"))


@query(
    "g16_rank_sum_auc",
    """WITH s AS (SELECT p1 AS score, (label = 1)::INT AS y FROM probs WHERE model = 'b'),
    r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM s)
    SELECT round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) AS auc FROM r""",
    "probs",
)
def g16(t):
    rows = t.probs.filter("model = 'b'").select(F.col("p1").alias("score"), (F.col("label") == 1).cast("int").alias("y"))
    return rounded(rank_sum_auc(rows, "score", "y"))


@query("g16_adversarial")
def g16b(t):
    rows = stored_texts(stratified_folds(cl.adversarial_rows(t.split_a, t.split_b), "doc_id", "label", K), "adversarial-rows")
    make = lambda n: cl.make_estimator("logistic", n, "weight")
    oof, _ = cl.cross_validate(rows, make, "adversarial", K, tfidf_features(rows, "ablation"), is_stored=True)
    return rounded(rank_sum_auc(oof, "p1", "label"), 4)


NAMES = ["Bearish", "POSITIVE", "neutral", "LABEL_1", "negative", "bullish", "LABEL_0"]


@query(
    "g17_label_names",
    "SELECT doc_id, CAST(CASE WHEN regexp_matches(lower(name), 'bear|negative') THEN 0 WHEN regexp_matches(lower(name), 'bull|positive') THEN 1"
    " WHEN contains(lower(name), 'neutral') THEN 2 ELSE doc_id % 3 END AS INTEGER) AS cls FROM (SELECT doc_id, CASE doc_id % 7 "
    + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES))
    + " END AS name FROM documents)",
)
def g17(t):
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.col("doc_id") % 7 + 1).cast("int"))
    return t.documents.select("doc_id", map_model_label(name, F.col("doc_id") % 3).alias("cls"))


def _load_length_predictor():
    """A stand-in for a model: shares from the counts of three letters."""

    def predict(pdf):
        raw = [pdf["text"].str.count(ch) + 1 for ch in "aeo"]
        total = raw[0] + raw[1] + raw[2]
        return {f"p{i}": r / total for i, r in enumerate(raw)}

    return predict


@query(
    "g17_batch_predict",
    "SELECT doc_id, "
    + ", ".join(
        f"round((length(text) - length(replace(text, '{ch}', '')) + 1)::DOUBLE / (length(text) * 3 - length(replace(text, 'a', '')) - length(replace(text, 'e', '')) - length(replace(text, 'o', '')) + 3), 6) AS p{i}"
        for i, ch in enumerate("aeo")
    )
    + " FROM documents",
)
def g17b(t):
    return rounded(cl.predict_table(t.documents, _load_length_predictor, "doc_id", ["text"]))
