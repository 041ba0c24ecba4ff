"""Closed arithmetic checks, brute force on small fixtures, skew and state."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textsignal.functions.hashing import digest
from textsignal.functions.proba import argmax_array, soften3
from textsignal.operators import ensemble as en
from textsignal.operators import metrics as m
from textsignal.operators import stats as st
from textsignal.operators.classify import make_estimator, predict_table
from textsignal.operators.dense import smote
from textsignal.operators.joins import stored_side
from textsignal.operators.knn import knn
from textsignal.operators.route import cascade, route
from textsignal.operators.split import balanced_class_weights, distributed_rank, stratified_folds, stratified_sample
from textsignal.streaming.jobs import _merge_session


def labelled(spark, counts):
    rows = [(c,) for c, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "label int").withColumn("doc_id", F.monotonically_increasing_id())


def test_majority_scores(spark):
    df = labelled(spark, {0: 1442, 1: 1923, 2: 6178}).withColumn("pred", F.lit(2))
    row = m.score(df, []).first()
    assert row["accuracy"] == pytest.approx(0.64738, abs=1e-5)
    assert row["f1_macro"] == pytest.approx(0.26198, abs=1e-5)
    weights = {r["label"]: r["weight"] for r in balanced_class_weights(df, "label").collect()}
    assert [round(weights[c], 4) for c in range(3)] == [2.206, 1.6542, 0.5149]


def test_absent_class_is_left_out(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "label int, pred int")
    assert m.score(df, []).first()["f1_macro"] == pytest.approx(2 / 3)


def test_signed_rank_golden(spark):
    a = [0.9046694859062105, 0.9072339616913343, 0.89368545913031, 0.9036805279725769, 0.918687358368385,
         0.9307168255454495, 0.8989108640921981, 0.9060593779742717, 0.910718164458766, 0.9081035384367432]
    b = [0.9037096864643147, 0.8977989993986202, 0.8872664028545915, 0.9144002618229422, 0.9184501460408829,
         0.9156715552564533, 0.9001365559148727, 0.9058652564796423, 0.8992802840565622, 0.9066838811490655]
    pairs = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    row = st.signed_rank(pairs, "a", "b").first()
    assert (row["n"], row["w_plus"], row["p_value"]) == (10, 43.0, 0.0654296875)


def test_population_deviation(spark):
    scores = spark.createDataFrame([("x", 1.0), ("x", 3.0)], "model string, f1_macro double")
    assert m.fold_summary(scores, ["model"]).first()["std"] == 1.0


def test_ties_and_temperature(spark):
    df = spark.createDataFrame([(0.4, 0.4, 0.2)], "p0 double, p1 double, p2 double").repartition(1)
    p = [F.col("p0"), F.col("p1"), F.col("p2")]
    assert df.select(argmax_array(F.array(*p))).first()[0] == 0
    assert list(df.select(*soften3(p, 1.0)).first()) == pytest.approx([0.4, 0.4, 0.2], abs=1e-8)


def test_buckets(spark):
    df = spark.createDataFrame([(0.5,), (0.50001,), (1.0,)], "conf double").withColumns({"label": F.lit(0), "pred": F.lit(0)})
    got = {r["upper"]: r["n"] for r in m.reliability_table(df, []).collect()}
    assert got == {0.5: 1, 0.6: 1, 1.0: 1}
    assert sum(r["n"] for r in m.calibration_curve(df, [], min_rows=1).collect()) == 2


def test_bootstrap_matches_row_resampling(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 3, 600)
    a = np.where(rng.random(600) < 0.8, y, rng.integers(0, 3, 600))
    b = np.where(rng.random(600) < 0.7, y, rng.integers(0, 3, 600))

    def f1(t, p):
        return np.mean([2 * ((t == c) & (p == c)).sum() / ((t == c).sum() + (p == c).sum()) for c in range(3)])

    diffs = []
    for _ in range(1000):
        i = rng.integers(0, 600, 600)
        diffs.append(f1(y[i], a[i]) - f1(y[i], b[i]))
    lo, hi = np.percentile(diffs, [2.5, 97.5])
    df = spark.createDataFrame(pd.DataFrame({"label": y, "pa": a, "pb": b}))
    row = st.bootstrap_difference(df, "label", "pa", "pb").first()
    assert row["observed"] == pytest.approx(f1(y, a) - f1(y, b))
    assert row["ci_low"] == pytest.approx(lo, abs=0.01) and row["ci_high"] == pytest.approx(hi, abs=0.01)


def test_rank_without_one_task_per_group(spark):
    """A class with nearly all rows is cut into ranges; ranks stay exact."""
    df = labelled(spark, {0: 5000, 1: 3})
    ranked = distributed_rank(df, ["label"], digest(1, F.col("doc_id")), ["doc_id"], "r", hex_digits=2)
    pdf = ranked.select("label", "doc_id", "r", digest(1, F.col("doc_id")).alias("d")).toPandas()
    want = pdf.sort_values(["label", "d"]).groupby("label").cumcount() + 1
    assert (pdf["r"] == want.reindex(pdf.index)).all()
    sizes = stratified_folds(df, "doc_id", "label", 10).groupBy("label", "fold").count().toPandas()
    for _, g in sizes.groupby("label"):
        assert g["count"].max() - g["count"].min() <= 1


def test_sample_quota(spark):
    df = labelled(spark, {0: 10, 1: 25, 2: 65})
    got = {r["label"]: r["count"] for r in stratified_sample(df, "doc_id", "label", size=20).groupBy("label").count().collect()}
    assert got == {0: 2, 1: 5, 2: 13}


@pytest.mark.parametrize("within, pivots, block", [(None, 1, 4096), (None, 20, 16), ("g", 8, 32)])
def test_knn_is_exact(spark, within, pivots, block):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(4, 6)) * 3
    x = np.vstack([centre[0 if i % 3 else i % 4] + rng.normal(size=6) * 0.3 for i in range(240)])
    x[5], x[7] = 0, x[8]  # a zero vector and a copy
    g = [i % 3 for i in range(240)]
    df = spark.createDataFrame([(i, x[i].tolist(), g[i]) for i in range(240)], "id long, v array<double>, g int")
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    sims = np.round(unit @ unit.T, 9)
    want = {}
    for i in range(240):
        near = sorted((-sims[i, j], j) for j in range(240) if j != i and (within is None or g[i] == g[j]))
        want[i] = [j for _, j in near[:5]]
    got: dict = {}
    for r in knn(df, df, 5, "id", "v", within=within, n_pivots=pivots, block=block).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == want


def test_smote_balances(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 0 if i < 30 else 1 if i < 37 else 2, rng.normal(size=3).tolist()) for i in range(39)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>")
    made = smote(df, "id", "label", "v").collect()
    assert sum(r["label"] == 1 for r in made) == 23 and sum(r["label"] == 2 for r in made) == 28
    vec = {r[0]: np.array(r[2]) for r in rows}
    for r in made:
        a, b, x = vec[r["id"]], vec[r["neighbour"]], np.array(r["vector"])
        assert np.linalg.norm(x - a) + np.linalg.norm(x - b) == pytest.approx(np.linalg.norm(a - b))


def probs_table(spark, n=200):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        y = int(rng.integers(0, 3))
        for k, skill in (("a", 1.2), ("b", 0.8), ("c", 0.5)):
            p = rng.random(3) + skill * (np.arange(3) == y)
            rows.append((i, y, k, *(p / p.sum()).tolist()))
    return spark.createDataFrame(rows, "doc_id long, label int, model string, p0 double, p1 double, p2 double")


def test_weight_search_bounds_the_ascent(spark):
    probs = probs_table(spark)
    keys = ["doc_id", "label"]
    table = en.weight_search(probs, ["a", "b", "c"], keys)
    assert table.count() == en.is_least(en.weight_configs(3)).sum()
    best = table.agg(F.max("f1_macro")).first()[0]
    weights, f1 = en.coordinate_ascent(probs, {"a": 1.0, "b": 0.0, "c": 0.0}, keys)
    assert f1 <= best + 1e-12
    again = en.vote_scores(en.weighted_vote(probs, weights, keys), []).first()[0]
    assert again == pytest.approx(f1)


def test_missing_model_leaves_the_divisor(spark):
    probs = probs_table(spark, 5)
    vote = en.weighted_vote(probs, {"a": 1.0, "gone": 3.0}, ["doc_id"])
    same = vote.join(probs.filter("model = 'a'").withColumnRenamed("p0", "q"), "doc_id")
    assert all(r["p0"] == pytest.approx(r["q"]) for r in same.collect())


def test_losses(spark):
    probs = probs_table(spark, 50)
    one = probs.filter("model = 'a'")
    pdf = one.toPandas()
    w = np.array([2.0, 1.0, 0.5])
    logs = np.log(pdf[["p0", "p1", "p2"]].to_numpy())
    own = w[pdf["label"]]
    hard = (-own * logs[np.arange(50), pdf["label"]]).sum() / own.sum()
    smooth = (-(w * logs).sum(axis=1) / 3).sum() / own.sum()
    got = en.smoothed_cross_entropy(one, [], w.tolist(), 0.1).first()[0]
    assert got == pytest.approx(0.9 * hard + 0.1 * smooth)
    assert en.symmetric_kl(one, one, "doc_id").first()[0] == pytest.approx(0)


def test_cascade_scores_only_what_escalates(spark):
    rows = [(0, 0.9), (1, -0.8), (2, 0.1), (3, 0.0), (4, 0.3)]
    df = spark.createDataFrame(rows, "doc_id long, compound double")
    seen = {"b": spark.sparkContext.accumulator(0), "e": spark.sparkContext.accumulator(0)}

    def scorer(prefix, cls):
        acc = seen[prefix]

        def score(part):
            schema = part.select("*", *[F.lit(0.0).alias(f"{prefix}{i}") for i in range(3)]).schema

            def run(batches):
                for pdf in batches:
                    acc.add(len(pdf))
                    for i in range(3):
                        pdf[f"{prefix}{i}"] = 1.0 if i == cls else 0.0
                    yield pdf

            return part.mapInPandas(run, schema)

        return score

    got = {r["doc_id"]: r for r in cascade(df, 0.5, scorer("b", 1), scorer("e", 0)).collect()}
    assert seen["b"].value == 3 and seen["e"].value == 1
    assert [got[i]["tool"] for i in range(5)] == ["lexicon", "lexicon", "model", "expert", "model"]
    assert [got[i]["final"] for i in range(5)] == [1, 0, 1, 0, 1]
    assert [len(got[i]["trace"]) for i in range(5)] == [1, 1, 2, 3, 2]


def test_route_fall_backs(spark):
    cols = "doc_id long, compound double, b0 double, b1 double, b2 double, e0 double, e1 double, e2 double"
    df = spark.createDataFrame([(0, 0.1, None, None, None, 1.0, 0.0, 0.0), (1, 0.1, 1.0, 0.0, 0.0, None, None, None)], cols)
    got = {r["doc_id"]: r for r in route(df, 0.5).collect()}
    assert got[0]["tool"] == "lexicon" and "no answer" in got[0]["reason"] and got[0]["cost"] == 0.1
    assert got[1]["tool"] == "model" and got[1]["final"] == 0


def test_predictor_loads_once_per_task(spark):
    df = spark.createDataFrame([(i, "x") for i in range(10)], "doc_id long, text string")
    load = lambda: (lambda pdf: pd.DataFrame({"p0": [0.05] * len(pdf), "p1": [0.9] * len(pdf), "p2": [0.05] * len(pdf)}))
    got = predict_table(df, load, "doc_id", ["text"])
    assert got.count() == 10 and got.filter("p1 = 0.9").count() == 10


def test_late_turns_keep_the_last_three():
    state = (0, [0] * 3, [0] * 3, [], [])
    first = pd.DataFrame({"turn": [5, 7, 9], "final": [0, 1, 2], "tool": ["lexicon"] * 3})
    late = pd.DataFrame({"turn": [1, 8], "final": [2, 0], "tool": ["lexicon", "expert"]})
    n, tools, labels, turns, finals = _merge_session(_merge_session(state, iter([first])), iter([late]))
    assert (n, tools, labels, turns, finals) == (5, [4, 0, 1], [2, 1, 2], [7, 8, 9], [1, 0, 2])


def test_stored_side_cuts_the_lineage(spark):
    side = stored_side(spark.range(5))
    assert sorted(r.id for r in side.collect()) == [0, 1, 2, 3, 4]
    assert "FileScan" in side._jdf.queryExecution().executedPlan().toString()  # its lineage is cut


def test_penalty_follows_c(spark):
    assert make_estimator("logistic", 50, C=10.0).getRegParam() == pytest.approx(1 / 500)
