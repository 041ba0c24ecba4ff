import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm.common import held_out
from textsignal.llm import language
from textsignal.llm.language import VOCABULARY, LanguageModel, Pieces, identify, train

PIECES = ["▁a", "a", "b", "ab", "▁ab", "bba", "é"]


def all_segmentations(pieces, p, word):
    coded = sorted((b"\0" if x[0] == "▁" else b"") + x.lstrip("▁").encode() for x in PIECES)
    total = np.zeros(p.shape[1])

    def go(at, prob):
        nonlocal total
        if at == len(word):
            total = total + prob
            return
        go(at + 1, prob * p[pieces.first_byte + word[at]])
        for i, c in enumerate(coded):
            if word.startswith(c, at):
                go(at + len(c), prob * p[i])

    go(0, np.ones(p.shape[1]))
    return total


def test_forward_sums_all_segmentations():
    pieces = Pieces(PIECES)
    p = np.random.default_rng(0).random((pieces.size, 3))
    p /= p.sum(axis=0)
    words = [b"\0" + x.encode() for x in ("abba", "aé", "zz", "b", "abbaabba", "")]
    want = [np.log(all_segmentations(pieces, p, w)) for w in words]
    assert np.allclose(pieces.log_likelihoods(words, p), want)


def test_expected_counts_by_differences():
    """Expected uses of a piece are the derivative of the log likelihood by the log of its probability."""
    pieces = Pieces(PIECES)
    p = np.random.default_rng(1).random((pieces.size, 1))
    p /= p.sum()
    word = b"\0abbaab"
    counts = pieces.expected_counts([word], np.ones(1), np.zeros(1, np.int64), p)
    for i in range(len(PIECES)):
        more = p.copy()
        more[i] *= 1 + 1e-6
        slope = math.log(all_segmentations(pieces, more, word)[0] / all_segmentations(pieces, p, word)[0]) / 1e-6
        assert counts[i, 0] == pytest.approx(slope, abs=1e-4)


def test_long_runs_do_not_underflow():
    pieces = Pieces(PIECES)
    p = np.full((pieces.size, 2), 1 / pieces.size)
    one, two = pieces.log_likelihoods([b"\0" + b"ab" * 500, b"\0" + b"ab" * 1000], p)[:, 0]
    assert np.isfinite(two) and one > two > 2.1 * one


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.filter(~held_out(F.col("doc_id"))), per_language=60)
    found = identify(docs.filter(held_out(F.col("doc_id"))), model)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98


def test_edges(make, edge_docs, no_docs):
    rows = [(i, t, x, x, 1) for i in range(40) for t, x in (("the cat and the house", "en"), ("die Katze und das Haus", "de"))]
    train_docs = make(rows, edge_docs.schema)
    model = train(train_docs)
    got = {(r.doc_id, r.text): r for r in identify(edge_docs.withColumn("Score", F.lit("mine")), model).collect()}
    for t in (None, "", " ", "…", "1 2 3", "\n\n"):
        assert [r.lang_pred for k, r in got.items() if k[1] == t][0] == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert identify(edge_docs, model).count() == edge_docs.count()
    assert identify(no_docs, model).count() == 0
    nothing = train(no_docs)
    assert {r.lang_pred for r in identify(edge_docs, nothing).collect()} == {"und"}


def test_ties_and_very_long_words(make):
    """Two languages with the same probabilities: the first by name; a word of 300,000 letters has a finite score."""
    pieces = Pieces.load(VOCABULARY)
    model = LanguageModel(["aa", "bb"], pieces, np.full((pieces.size, 2), 1 / pieces.size))
    docs = make([(1, "some words"), (2, "x" * 300_000), (3, "été " * 5), (4, "12")], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    assert found == {1: ("aa", 0.5), 2: ("aa", 0.5), 3: ("aa", 0.5), 4: ("und", 0.0)}


def test_long_words_are_counted_like_short_ones(monkeypatch):
    """The sums in logarithms equal the plain ones, and do not vanish where those do."""
    pieces = Pieces.load(VOCABULARY)
    rng = np.random.default_rng(0)
    p = rng.random((pieces.size, 2))
    p /= p.sum(axis=0)
    words = [b"\0" + w.encode() for w in ("the", "running", "été", "z")]
    weights, langs = np.array([1.0, 2.0, 3.0, 1.0]), np.array([0, 1, 0, 1])
    plain = pieces.expected_counts(words, weights, langs, p)
    monkeypatch.setattr(language, "PLAIN", 0)
    assert np.allclose(plain, pieces.expected_counts(words, weights, langs, p))
    monkeypatch.undo()
    long = [b"\0" + ("\u4e00" * 300).encode()]
    found = pieces.expected_counts(long, np.ones(1), np.zeros(1, np.int64), p / 1000)
    assert np.isfinite(found).all() and found.sum() > 100
