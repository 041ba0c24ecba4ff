"""Linear models of all folds fitted side by side, against MLlib's one by one."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textsignal.operators import classify as cl
from textsignal.operators import joint_fit as jf
from textsignal.operators import sparse as sp
from textsignal.operators.features import SURFACE_COLUMNS
from textsignal.plans import classify as plans

WORDS = [f"{a}{b}" for a in "bcdfghklm" for b in ("an", "ot", "ur")]


def texts(n=60, k=3):
    rng, rows = random.Random(3), []
    for i in range(n):
        liked = WORDS[9 * (i % 3) : 9 * (i % 3) + 14]
        rows.append((i, i % 3, (i // 3) % k, " ".join(rng.choice(liked) for _ in range(rng.randint(1, 12))) + (" han" * 400 if i == 5 else "")))
    return rows + [(4, 1, 2, "ban ban zz"), (4, 1, 0, "zz cot"), (None, 0, 1, "gur"), (None, 2, 1, "kan kot"), (70, 1, 2, None), (71, 0, 0, "")]


def scores(table):
    columns = table.columns
    numbers = vector_to_array("rawPrediction") if "rawPrediction" in columns else F.array("p0", "p1", "p2")
    rows = table.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "label", "fold", numbers.alias("v")).collect()
    keys = sorted((r.id, r.label, r.fold, tuple(round(x, 5) + 0.0 for x in r.v)) for r in rows)
    return [x[:3] for x in keys], np.array([x[3] for x in keys])


@pytest.mark.parametrize("kind", ["logistic", "svm"])
def test_models_of_all_folds_are_mllibs(spark, kind):
    """Every fold's vectors were made, cached and passed over for itself; repeated and null ids, null and empty texts stay as they were."""
    rows = cl.stored(spark.createDataFrame(texts(), "doc_id long, label int, fold int, text string"), "joint-test")
    features = plans.tfidf_features(rows, "unigram", 3)
    make = lambda n: cl.make_estimator(kind, n, "weight", maxIter=6)
    found = []
    for joint in (features.joint, None):
        features.joint = joint
        assert (jf.fit_all(cl.joint_of(features, 3), make) is None) == (joint is None)
        if kind == "svm":
            found.append((cl.oof_margins(rows, make, 3, features, is_stored=True), None))
        else:
            oof, record = cl.cross_validate(rows, make, kind, 3, features, is_stored=True)
            found.append((oof, record.drop("time_s").first().asDict()))
    (ours, record), (theirs, expected) = found
    assert ours.schema.simpleString() == theirs.schema.simpleString()
    (keys, got), (other, wanted) = scores(ours), scores(theirs)
    assert keys == other and len(keys) == len(texts()) and np.allclose(got, wanted, atol=2e-5)
    assert record is None or all(record[c] == pytest.approx(expected[c]) for c in record)


def test_one_pass_serves_every_fold(spark, monkeypatch):
    """Each pass over the texts was one fold's; rows wider than the driver should add up itself are added in slices."""
    rows = cl.stored(spark.createDataFrame(texts(), "doc_id long, label int, fold int, text string"), "joint-test")
    found, passes, sums_of = sp.FoldVectors(rows, "char", 3), [], jf.sums_of
    monkeypatch.setattr(jf, "sums_of", lambda cells, size, gather: passes.append(size) or sums_of(cells, size, gather))
    fit = jf.fit_all(found, lambda n: cl.make_estimator("logistic", n, "weight", maxIter=3))
    whole = [m.coefficients for m in fit.models]
    assert 4 <= len(passes) <= 12  # moments, the start, three steps of each fold at once
    monkeypatch.setattr(jf, "MOST", 1)
    monkeypatch.setattr(jf, "PIECE", 40)
    again = jf.fit_all(found, lambda n: cl.make_estimator("logistic", n, "weight", maxIter=3))
    assert all(np.allclose(a, m.coefficients) for a, m in zip(whole, again.models))


def test_dense_columns_beside_terms_are_mllibs(spark):
    """Word vectors were joined with the surface columns for every fold and each reading."""
    rows = cl.stored(spark.createDataFrame(texts(), "doc_id long, label int, fold int, text string").filter("text is not null"), "joint-test")
    surfaces = cl.stored(plans.surface_table(rows), "joint-surface")
    words, cells = plans.tfidf_features(rows, "unigram", 3), plans.surface_cells(surfaces)
    moments = [tuple(np.array(v) for v in zip(*plans.surface_moments(cells, f))) for f in range(3)]
    both = words.joint.beside(surfaces.select("doc_id", "fold", F.array(*SURFACE_COLUMNS).alias("more")), moments)
    make = lambda n: cl.make_estimator("logistic", n, "weight", maxIter=5)
    scaler, out = plans.scaled_surface(surfaces), []

    def fused(train, test, fold):
        from pyspark.ml.feature import VectorAssembler

        *sides, n = words.build(train, test, fold)
        more = scaler.build(surfaces.filter(F.col("fold") != fold), surfaces.filter(F.col("fold") == fold), fold)[:2]
        joined = [a.join(b.select("doc_id", F.col("features").alias("more")), "doc_id") for a, b in zip(sides, more)]
        built = [VectorAssembler(inputCols=["features", "more"], outputCol="both").transform(x).drop("features", "more") for x in joined]
        return *[x.withColumnRenamed("both", "features") for x in built], n

    for joint in (both, None):
        oof, record = cl.cross_validate(rows, make, "fused", 3, cl.Columns(fused, joint), is_stored=True)
        out.append((scores(oof), record.select("f1_macro", "train_f1_macro").first()))
    (a, ours), (b, theirs) = out
    assert a[0] == b[0] and np.allclose(a[1], b[1], atol=2e-5) and tuple(ours) == pytest.approx(tuple(theirs))


def test_counts_over_a_byte_are_whole():
    from textsignal.operators.term_rows import pack_counts, unpack_counts

    lists = [np.array([1, 255, 70_000, 2]), np.array([], dtype=int), np.array([254, 3])]
    packed = [pack_counts(v).tobytes() for v in lists] + [None]
    assert unpack_counts(packed, np.array([4, 0, 2, 0])).tolist() == [1, 255, 70_000, 2, 254, 3]
    assert unpack_counts(packed[2:], np.array([2, 0])).tolist() == [254, 3]


def test_a_null_among_dense_columns_is_an_error():
    """As for MLlib's vectors; it must not become a number."""
    import pyarrow as pa

    cells = {"label": pa.array([0]), "fold": pa.array([0]), "use": pa.array([0]), "test": pa.array([True])}
    cells |= {c: pa.array([b""], pa.binary()) for c in ("indices", "tf")} | {"sizes": pa.array([bytes(16)], pa.binary())}
    batch = lambda more: pa.RecordBatch.from_pydict({**cells, "more": pa.array([more], pa.list_(pa.float64()))})
    assert next(jf.pieces(batch([1.0, 2.0]), 5, 2)).more.tolist() == [[1.0, 2.0]]
    with pytest.raises(ValueError):
        next(jf.pieces(batch([1.0, None]), 5, 2))
