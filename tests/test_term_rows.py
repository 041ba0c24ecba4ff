"""Terms counted inside their rows, against counting by hand."""

import math
from collections import Counter

import pytest

from textsignal.operators import sparse as sp
from textsignal.operators.term_rows import term_sums

TEXTS = [(1, "Ab ab Żółw ab"), (2, "ab cd cd e"), (2, "cd ab"), (3, None), (4, ""), (None, "ab zz zz"), (5, "x" * 40 + " zz cd ab ef")]


def terms_of(text, kind):
    lowered = (text or "").lower().split()
    if kind == "char":
        return [f" {w} "[i : i + n] for w in lowered for n in (3, 4, 5) for i in range(len(w) + 3 - n)]
    tokens = [w for w in lowered if len(w) > 1]
    return tokens + ([f"{a} {b}" for a, b in zip(tokens, tokens[1:])] if kind == "bigram" else [])


def by_hand(kind):
    docs = {}
    for i, text in TEXTS:
        docs.setdefault(i, Counter()).update(terms_of(text, kind))
    return docs


@pytest.mark.parametrize("kind", ["unigram", "bigram", "char"])
def test_sums_and_weights_are_those_of_merged_ids(spark, kind):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    docs = by_hand(kind)
    sums = {r.term: (r.df, r.total) for r in term_sums(sp.term_rows(df, kind)).collect()}
    assert sums == {t: (sum(t in d for d in docs.values()), sum(d[t] for d in docs.values())) for t in set().union(*docs.values())}
    vocabulary = sp.fit_vocabulary(term_sums(sp.term_rows(df, kind)), sp.corpus_size(df), 50, min_df=2)
    idf = {r.term: r.idf for r in vocabulary.collect()}
    weights = {(r.doc_id, r.term): r.weight for r in sp.tfidf(sp.term_rows(df, kind), vocabulary).collect()}
    expected = {}
    for i, d in docs.items():
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in d.items() if t in idf}
        expected |= {(i, t): w / math.sqrt(sum(x * x for x in raw.values())) for t, w in raw.items()}
    assert weights == pytest.approx(expected)
    vectors = sp.tfidf_vectors(df, sp.numbered(vocabulary), kind).collect()
    assert len(vectors) == len(TEXTS)
    names = sorted(idf)
    for r in vectors:
        known = {names[j]: v for j, v in zip(r.features.indices, r.features.values)}
        assert known == pytest.approx({t: w for (i, t), w in expected.items() if i is not None and i == r.doc_id})


def test_terms_are_neither_shuffled_nor_stored(spark):
    """Term rows by document were written, read twice and sorted by document: many times the texts' size on disk."""
    df = spark.createDataFrame([(i, f"ab cd w{i}") for i in range(20)], "doc_id long, text string")
    counted, vocabulary = sp.fit_tfidf(df, "char")
    plan = sp.tfidf(counted, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Scan parquet" not in plan


def test_tokens_are_stemmed_where_they_lie(spark):
    """Tokens were exploded, joined with their stems and sorted together again, three shuffles of all tokens."""
    from textsignal.operators.tokens import replace_tokens, stem, stem_vocabulary

    rows = [(1, ["running", "dogs", "running"]), (2, None), (3, []), (4, ["URL", None, "flies"]), (None, ["cats"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = {r.doc_id: r.tokens for r in stem(df, "doc_id", "tokens").collect()}
    assert got == {r.doc_id: r.tokens for r in replace_tokens(df, "doc_id", "tokens", stem_vocabulary(df, "tokens")).collect()}
    assert got[1] == ["run", "dog", "run"] and got[2] == [] and got[None] == ["cat"]
    assert "Exchange" not in stem(df, "doc_id", "tokens")._jdf.queryExecution().executedPlan().toString()
    both = df.unionByName(spark.createDataFrame([(1, ["cats"])], df.schema))
    old = replace_tokens(both, "doc_id", "tokens", stem_vocabulary(both, "tokens"))
    assert sorted(map(str, stem(both, "doc_id", "tokens").collect())) == sorted(map(str, old.collect()))


@pytest.mark.parametrize("kind", ["unigram", "bigram", "char"])
def test_vectors_of_all_folds_are_those_of_each_fold_alone(spark, kind):
    """Every fold tokenised its training rows twice and its test rows once; now texts are read twice for all folds."""
    words = ["ab", "cd", "ef", "gh", "ij", "Żółw"]
    rows = [(i, i % 2, i % 3, " ".join(words[(i * j) % 6] for j in range(1, 6))) for i in range(24)]
    rows += [(3, 1, 1, "cd cd zz"), (3, 1, 0, "zz ab"), (None, 0, 1, "gh zz"), (None, 0, 1, "ab"), (30, 1, 2, None), (31, 0, 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, label int, fold int, text string")
    made = sp.FoldVectors(df, kind, 3)
    for fold in range(3):
        train, test = df.filter(f"fold <> {fold}"), df.filter(f"fold = {fold}")
        vocabulary = sp.numbered(sp.fit_tfidf(train, kind)[1])
        assert made.vocabularies[fold][0] == vocabulary[0] and made.vocabularies[fold][1].tolist() == vocabulary[1].tolist()
        assert made.n_train(fold) == train.count()
        for side, is_train in ((train, True), (test, False)):
            alone = sp.tfidf_vectors(side, vocabulary, kind, keep=["label", "fold"])
            assert sorted(map(str, made.vectors(fold, is_train).collect())) == sorted(map(str, alone.collect()))
    once = sp.FoldVectors(df.filter("doc_id <> 3"), kind, 3)
    assert "text" not in once.vectors(0, True)._jdf.queryExecution().optimizedPlan().toString()


def test_texts_leave_the_jvm_whole(spark):
    """Token lists were made by patterns in the JVM and copied token by token; n-grams were exploded from lists made twice."""
    from textsignal.plans.sparse import d01

    df = spark.createDataFrame([(1, "Ab-cd e Żó_9gh\u0085ab"), (1, "AB cd"), (2, None), (None, "　cd  ab\n")], "doc_id long, text string")
    table = type("T", (), {"documents": df})()
    pairs = Counter(["ab", "cd", "żó_9", "gh", "ab", "ab cd", "cd żó_9", "żó_9 gh", "gh ab", "ab", "cd", "ab cd", "cd", "ab", "cd ab"])
    found = d01(table)
    assert {r.term: r.n for r in found.collect()} == pairs
    sums = term_sums(sp.term_rows(df, "bigram"))
    assert {r.term: r.total for r in sums.collect()} == pairs  # no pair across the two texts of one id
    for made in (found, sums):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp" not in plan and "Generate" not in plan
    words = Counter(["ab-cd", "e", "żó_9gh", "ab", "ab", "cd", "cd", "ab"])
    assert {r.term: r.total for r in term_sums(sp.TermRows(sp.term_rows(df, "char").rows, "word", "doc_id")).collect()} == words


def test_words_are_counted_where_their_texts_lie(spark):
    """Whole texts were shuffled by id and exploded before their words met the vectors."""
    from textsignal.operators.dense import mean_pool

    df = spark.createDataFrame([(1, "a b  a"), (1, "\tc b"), (2, "x"), (3, None), (None, "a")], "doc_id long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 6.0])], "word string, vector array<float>")
    pooled = mean_pool(df, vectors, 2)
    assert sorted((r.doc_id or 0, r.vector) for r in pooled.collect()) == [
        (0, [0.0, 0.0]), (1, [0.5, 3.0]), (1, [0.5, 3.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0]),
    ]
    assert "Generate" not in pooled._jdf.queryExecution().optimizedPlan().toString()
