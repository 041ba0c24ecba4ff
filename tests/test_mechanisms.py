import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textsignal import session
from textsignal.functions import clean, sql_functions
from textsignal.operators import predict, sketches, stats
from textsignal.operators.tokens import noun_lemmas
from textsignal.plans import mechanisms as mech
from textsignal.plans.views import Tables
from textsignal.sources import models
from textsignal.sources.bucketed import bucket_count, write_bucketed

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- SQL functions
def test_sql_functions_equal_the_column_expressions(spark):
    texts = ["$AAPL beats https://t.co/a @joão #olá", "cafÃ© can’t 'quoted' \\ back", "", None, "x = y, not (z) = 'and(1)' or(2) …", "SOOOO good :)"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    names = sql_functions.register_functions(spark, "q_")
    every = {**sql_functions.TEXT_FUNCTIONS, **{n: f for n, (f, _) in sql_functions.OTHER_FUNCTIONS.items()}}
    assert names == [f"q_{n}" for n in every]
    by_sql = spark.sql(f"SELECT {', '.join(f'q_{n}(text) AS {n}' for n in every)} FROM {{df}}", df=df)
    by_column = df.select(*[f(F.col("text")).alias(n) for n, f in every.items()])
    assert by_sql.collect() == by_column.collect()
    assert "Python" not in plan_of(by_sql) and "Arrow" not in plan_of(by_sql)


def test_functions_work_in_views_and_predicates(spark):
    sql_functions.register_functions(spark)
    assert spark.sql("SELECT count(*) AS n FROM VALUES ('a b'), ('a') AS t(x) WHERE ts_word_count(x) = 2").first().n == 1
    assert sql_functions.sql_text(F.col("a") == F.lit("=(b")) == "`=`(a, '=(b')"


# --- scratch
def test_a_job_clears_its_own_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    (tmp_path / "textsignal-of-another").mkdir()
    spark.range(3).write.parquet(session.scratch_path(spark, "mine"))
    assert session.run_folder(spark).startswith(str(tmp_path)) and session.clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["textsignal-of-another"] and not session.clear_scratch(spark)


# --- noun lemmas
PAIRS = {
    "churches": "church", "wishes": "wish", "buses": "bus", "boxes": "box", "leaves": "leaf", "women": "woman", "stories": "story",
    "cats": "cat", "children": "child", "feet": "foot", "mice": "mouse", "analyses": "analysis", "stocks": "stock", "companies": "company",
}


def test_published_noun_pairs(spark):
    tokens = [(x,) for x in [*PAIRS, "gas", "was", "bus", "class", "", None, "news", "cats"]]
    known = [(x,) for x in [*PAIRS.values(), "bus", "class", "news"]]
    found = noun_lemmas(spark.createDataFrame(tokens, "token string"), spark.createDataFrame(known, "lemma string"))
    assert dict(map(tuple, found.collect())) == PAIRS  # words without a known form stay


def test_the_vocabulary_is_its_own_dictionary(spark):
    vocab = spark.createDataFrame([(x,) for x in ("runs", "run", "bosses", "gas", "ga")], "token string")
    assert dict(map(tuple, noun_lemmas(vocab).collect())) == {"runs": "run", "gas": "ga"}
    assert noun_lemmas(vocab.limit(0)).collect() == []
    assert noun_lemmas(vocab, exceptions={"bosses": "boss"}).filter("token = 'bosses'").first().lemma == "boss"


# --- bootstrap
def test_poisson_weights_are_poisson(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), *[F.lit(0).alias(c) for c in ("label", "a", "b")])
    one = stats.poisson_bootstrap(rows, "doc_id", "label", "a", "b", 4).first()
    assert tuple(one) == (4, 0.0, 0.0, 0.0)
    u = np.random.default_rng(0).random(200_000)
    weights = sum((u >= b).astype(int) for b in stats.POISSON_BOUNDS)
    assert abs(weights.mean() - 1) < 0.02 and abs(weights.var() - 1) < 0.03
    assert 1 - stats.POISSON_BOUNDS[-1] < 2**-32 * 2


def test_both_bootstraps_agree(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(g), int(g if rng.random() < 0.8 else rng.integers(3)), int(g if rng.random() < 0.7 else rng.integers(3))) for i, g in enumerate(rng.integers(0, 3, 600))]
    df = spark.createDataFrame(rows, "doc_id long, label int, pa int, pb int")
    mine = stats.poisson_bootstrap(df, "doc_id", "label", "pa", "pb", 400).first()
    other = stats.bootstrap_difference(df, "label", "pa", "pb", 400).first()
    assert mine.observed == pytest.approx(other.observed) and mine.replicates == 400
    assert mine.ci_low == pytest.approx(other.ci_low, abs=0.012) and mine.ci_high == pytest.approx(other.ci_high, abs=0.012)
    assert stats.poisson_bootstrap(df.limit(0), "doc_id", "label", "pa", "pb", 8).first().observed is None
    assert stats.poisson_bootstrap(df.repartition(7), "doc_id", "label", "pa", "pb", 400).first() == mine


# --- sketches
def test_merged_sketches_against_exact_counts(spark):
    """60,000 terms in 40 parts that share most of them; a few terms are frequent."""
    rows = spark.range(600_000).select((F.col("id") % 40).alias("part"), F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(F.col("id") % 60_000 + 7).cast("string").alias("term"))
    parts = sketches.token_sketches(rows, "part")
    assert parts.count() == 40 and parts.agg(F.max(F.length("distinct_sketch"))).first()[0] < 20_000
    whole = sketches.merge_sketches(parts)
    size = sketches.vocabulary_size(whole).first()
    exact = rows.agg(F.count_distinct("term")).first()[0]
    assert size.n_tokens == 600_000 and abs(size.n_terms - exact) <= 0.03 * exact
    truth = {r.term: r["count"] for r in rows.groupBy("term").count().orderBy(F.desc("count"), "term").limit(7).collect()}
    top = sketches.heavy_terms(whole, 7).collect()
    assert {r.term for r in top} == set(truth) and all(abs(r.n - truth[r.term]) <= 0.05 * truth[r.term] for r in top)
    coarse = sketches.merge_sketches(parts, (F.col("part") % 2).cast("string"))
    assert {r.part for r in coarse.collect()} == {"0", "1"}


# --- batch prediction
def test_linear_artefacts(spark):
    weights, offsets = np.array([[1.0, -1.0], [0.5, 2.0]]), np.array([0.0, 1.0])
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0])], "id long, v array<double>")
    plain = {r.id: r.out for r in predict.predict_vectors(rows, predict.LinearArtefact(weights, offsets), "v", "out", 2).collect()}
    assert plain == {1: [2.0, 4.0], 2: None, 3: [0.0, 1.0]}
    shares = predict.predict_vectors(rows, predict.LinearArtefact(weights, offsets, "softmax"), "v", "out", 2, batch=1).filter("id = 1").first().out
    assert shares == pytest.approx([1 / (1 + np.exp(2)), 1 / (1 + np.exp(-2))])
    unit = predict.predict_vectors(rows, predict.LinearArtefact(weights, np.zeros(2), "unit"), "v", "out", 2).collect()
    assert unit[0].out == pytest.approx([2 / 13**0.5, 3 / 13**0.5]) and unit[2].out == [0.0, 0.0]
    table = spark.createDataFrame([(0, 0, 1.0), (1, 0, -1.0), (0, 1, 0.5), (1, 1, 2.0), (1, -1, 1.0)], "output int, input int, weight double")
    read = predict.artefact_from_table(table, "plain")
    assert (read.weights == weights).all() and (read.offsets == offsets).all()


# --- bucketed tables
def test_co_located_tables_need_no_exchange(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        tables = mech.bucketed_votes(Tables(spark, SF))
        voted = mech.co_located_votes(*tables)
        assert "Exchange" not in plan_of(voted) and "SortMergeJoin" in plan_of(voted)
        plain = mech.co_located_votes(*[df.select("*").repartition(3) for df in tables])
        assert "Exchange" in plan_of(plain)
        key = lambda rows: sorted((r.doc_id, r.fold, round(r.p0, 9)) for r in rows)
        assert key(voted.collect()) == key(plain.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_buckets_hold_nulls_and_grow_by_doubling(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "k long, v string")
    assert sorted(r.v for r in write_bucketed(rows, "k", 4, "tiny").collect()) == ["a", "b", "c"]
    assert [bucket_count(n) for n in (0, 10, 10**9)] == [8, 8, 256]


# --- stored models
def test_models_predict_the_same_in_another_session(spark):
    rows, fitted, params = mech.fitted_by_fold(Tables(spark, SF))
    folder = models.save_models(spark, fitted, "logistic", params, ["features"])
    other = spark.newSession()
    cards = models.model_cards(other, folder).orderBy("fold").collect()
    assert [c.fold for c in cards] == [0, 1, 2] and '"C": 1.0' in cards[0].params
    pick = lambda df: {r.vec_id: r.p for r in df.select("vec_id", vector_to_array("probability").alias("p")).collect()}
    assert pick(models.predict_by_fold(models.load_models(other, folder), rows)) == pick(models.predict_by_fold(fitted, rows))


def test_clean_functions_are_the_ones_registered():
    assert sql_functions.TEXT_FUNCTIONS["clean_noise"] is clean.clean_noise
