"""Registered queries against their oracle SQL on the smallest tables, and plan checks."""

import duckdb
import pytest

import __spark_entry__ as driver
from pyspark.sql import functions as F

from textsignal.plans.views import Tables

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels conversations events pages".split()
SAMPLE = [
    "a03_run_records", "a05_write_probabilities", "b07_clean_noise", "b16_full_clean", "b22_fix_text", "c01_lexicon",
    "d05_tfidf_unigram", "d10_top_terms", "e03_mean_pool", "e11_knn_5", "f01_folds", "g03_multinomial_nb",
    "h03_report", "h14_temperature_search", "i07_weight_search", "j02_length_summary", "j10_normalised_overlap",
    "k03_route", "k05_tau_sweep", "l04_session_stats", "l05_stream_route", "l06_stream_last_three", "l07_stream_windows",
]


def as_text(v):
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, name):
    df = driver.queries()[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted(tuple(as_text(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(driver.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    theirs = sorted(tuple(as_text(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert mine == theirs


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 150


def test_entry(spark):
    assert driver.entry(spark).count() == 20


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    text = plan(Tables(spark, SF).gold)
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in text
    text = plan(driver.queries()["f01_folds"](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_token_counts_need_no_token_shuffle(spark):
    """Texts are placed by id; counting and the row norm reuse that placement."""
    from textsignal.operators import sparse as sp

    counts = sp.word_term_counts(Tables(spark, SF).read("documents"))
    assert plan(counts).count("Exchange") == 1


def test_streams_read_folders_in_several_batches(spark, tmp_path):
    """Part files and micro-batches, some rows late: the same as one file in one batch."""
    from textsignal.plans.routing import TAU  # noqa: F401  (the routed view needs its module)
    from textsignal.plans.streams import routed_turns
    from textsignal.streaming import jobs

    for name in ("conversations", "events"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        table.repartition(5).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = jobs.run_to_table(routed_turns(jobs.read_stream(spark, str(tmp_path), "conversations", files=1)), "routed")
    assert rows.count() == spark.read.parquet(f"{SF}/conversations.parquet").count()

    def sessions(folder, files):
        stream = routed_turns(jobs.read_stream(spark, folder, "conversations", files))
        updates = jobs.run_to_table(jobs.session_state(stream, "conv_id"), "sessions", "update")
        return sorted(map(tuple, jobs.latest_state(updates, "conv_id").collect()))

    assert sessions(str(tmp_path), 2) == sessions(SF, 64)

    def windows(folder, files):
        stream = jobs.read_stream(spark, folder, "events", files).withColumn("ts", F.col("ts").cast("timestamp"))
        done = jobs.run_to_table(jobs.windowed_counts(stream, "ts", "event_type", lateness="3650 days"), "windows", "update")
        return sorted(map(tuple, done.groupBy("start", "event_type").agg(F.max("n")).collect()))

    assert windows(str(tmp_path), 1) == windows(SF, 64)


def test_divisions_by_nothing(spark):
    """One-row class, constant class, documents without a weighted model, one class only, more than 20 pairs."""
    from textsignal.operators import audit, ensemble, stats

    one = spark.createDataFrame([(0, "aa", 0.5), (1, "a", 0.1), (1, "abc", 0.2)], "label int, text string, lex_compound double")
    got = {r.label: r.std for r in audit.describe_by(one, "label", {"n": F.length("text")}).collect()}
    assert got[0] is None and got[1] == pytest.approx(2**0.5)
    assert audit.lexicon_histogram(one).filter("label = 0").first().bin == 0
    assert audit.lexicon_ambiguity(one, 7).first().positive_pct is None
    probs = spark.createDataFrame([(1, 0, "a", 0.2, 0.3, 0.5), (2, 0, "z", 0.2, 0.3, 0.5)], "doc_id int, label int, model string, p0 double, p1 double, p2 double")
    keys = ["doc_id", "label"]
    assert [r.doc_id for r in ensemble.weighted_vote(probs, {"a": 1.0, "b": 0.0}, keys).collect()] == [1]
    assert [r.doc_id for r in ensemble.vote_many(probs, {"x": {"a": 1.0}}, keys).collect()] == [1]
    assert ensemble.weight_search(probs, ["a", "z"], keys).count() == ensemble.is_least(ensemble.weight_configs(2)).sum()
    scores = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert stats.rank_sum_auc(scores, "s", "y").first().auc is None
    pairs = spark.createDataFrame([(float(i), 0.0) for i in range(1, 31)], "a double, b double")
    row = stats.signed_rank(pairs, "a", "b").first()
    assert row.n == 30 and row.w_plus == 465 and row.p_value == pytest.approx(2**-30)
