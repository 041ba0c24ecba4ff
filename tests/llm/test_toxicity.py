import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm.q_toxicity import op2
from textsignal.llm.registry import Source
from textsignal.llm.toxicity import FactorizationMachine, _Buckets, bucket_column, fit, score_toxicity, terms_of, train


def test_logit_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = FactorizationMachine(np.arange(6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    for row in ([], [2], [0, 3, 5]):
        want = 0.3 + sum(m.w[i] for i in row) + sum(m.v[i] @ m.v[j] for k, i in enumerate(row) for j in row[:k])
        assert m.logit([np.array(row, np.int64)])[0] == pytest.approx(want)


def test_learns_an_interaction_that_linear_weights_miss():
    rows = [np.array(r, np.int64) for r in ([0], [1], [0, 1], [])] * 50
    for target in (np.array([0, 0, 1, 0] * 50, float), np.array([1, 1, 0, 0] * 50, float)):
        m = FactorizationMachine(np.arange(2), 0.0, np.zeros(2), np.zeros((2, 4)))
        fit(m, rows, target, np.ones(len(target)))
        assert ((m.probability(rows[:4]) > 0.5) == target[:4]).all()


@pytest.mark.parametrize("kind", ["either but not both", "both"])
def test_training_finds_the_pair_among_noise(make, kind):
    """2,000 texts of two telling words and twenty others, all equally common in both classes where one of the two is asked for."""
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "abcd" for b in "vwxyz"] + ["insult", "group"]
    held = rng.random((2000, 22)) < 0.5
    y = (held[:, 20] ^ held[:, 21]) if kind != "both" else held[:, 20] & held[:, 21]
    docs = make([(i, " ".join(w for w, h in zip(words, row) if h)) for i, row in enumerate(held.tolist())], "doc_id long, text string")
    labels = make([(i, int(t)) for i, t in enumerate(y) if i % 2], "doc_id long, toxic int")
    model = train(docs, labels, per_class=600)
    assert len(model.w) >= 2
    scored = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    right = [(scored[i] > 0.5) == bool(y[i]) for i in range(0, 2000, 2)]
    assert np.mean(right) >= 0.95


def test_buckets_of_spark_and_python_agree(make):
    texts = ["Some words, some WORDS: été Straße x1y2", "", None, "日本語 ñandú"]
    docs = make(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(r.b) for r in docs.select("doc_id", bucket_column(F.col("text")).alias("b")).collect()}
    known = _Buckets()
    assert got == {i: {known[t] for t in terms_of(x)} for i, x in enumerate(texts)}


def test_the_query(spark):
    """Contract columns, held-out rows by the id's checksum, and better than chance by far on rows that taught nothing."""
    sf = "/root/testdata/sf0.1"
    rows = op2(Source(spark, sf)).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    ones, zeros = ([s for s, t in held if t == c] for c in (1, 0))
    assert np.mean([s >= 0.3 for s in ones]) >= 0.75 and np.mean([s >= 0.3 for s in zeros]) <= 0.01
    assert np.mean([a > b for a in ones for b in zeros]) >= 0.95


def test_held_out_and_edges(spark, make, edge_docs, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = train(docs, labels.filter("doc_id % 4 <> 0"))
    held = score_toxicity(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    flagged = [r for r in held if r.predicted]
    assert len(flagged) > 3 and sum(r.toxic for r in flagged) >= 0.9 * len(flagged)
    got = score_toxicity(edge_docs, model)
    assert got.count() == edge_docs.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert score_toxicity(no_docs, model).count() == 0
    for some in (labels.limit(0), labels.filter("toxic = 0"), make([(None, None), (1, None)], "doc_id long, toxic int")):
        share = {round(r.score, 6) for r in score_toxicity(edge_docs, train(docs, some)).collect()}
        assert len(share) == 1
