"""Text edge cases."""

import pytest
from pyspark.sql import functions as F

from textsignal.functions import clean as c
from textsignal.functions import surface as s
from textsignal.functions.stem import stem_word
from textsignal.operators.lexicon import default_lexicon, lexicon_class, lexicon_scores
from textsignal.operators.tokens import full_pipeline


def one(spark, fn, text):
    df = spark.createDataFrame([(text,)], "x string").repartition(1)
    return df.select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "fn, text, want",
    [
        (
            c.clean_noise,
            "$AAPL - Apple beats https://t.co/abc123 @analyst #tag &amp; $toolongx",
            "TICKER_AAPL - Apple beats URL USER tag $toolongx",
        ),
        (c.mark_cashtags, "$aapl,$MSFT", " TICKER_AAPL , TICKER_MSFT "),
        (c.mark_mentions, "@joão hi", " USER  hi"),
        (c.unwrap_hashtags, "#olá!", " olá !"),
        (c.expand_contractions, "won't Can't didn't", "will not can not did not"),
        (c.straighten_apostrophes, "didn’t", "didn't"),
        (c.fold_ascii, "Ünïcode ﬁne…", "unicode fine..."),
        (c.repair_encoding, "UBS raises Pelotonâ€™s cafÃ©", "UBS raises Peloton’s café"),
        (c.repair_encoding, "café 5€ naïve 日本 «ÉTÉ»", "café 5€ naïve 日本 «ÉTÉ»"),
        (c.fix_encoding, "A “b” &amp; c’s", 'A "b" & c\'s'),
        (c.fix_text, "Stock up … https://t.co/a", "Stock up"),
        (c.fix_text, "Stock up -", "Stock up"),
        (c.fix_text, "see https://t.co/a now:", "see  now"),
        (c.eda_clean, "$AAPL @me #Up www.x.y", " aapl     up   "),
    ],
)
def test_clean(spark, fn, text, want):
    assert one(spark, fn, text) == want


def test_tokens(spark):
    assert one(spark, c.tokenize, "sooooo Good :) @user it's #up 3.5") == ["sooo", "good", ":)", "it's", "#up", "3.5"]
    assert one(spark, c.words, "  a  b ") == ["a", "b"]
    assert one(spark, c.words, "") == []


def test_pipeline_keeps_negation_and_blank(spark):
    df = spark.createDataFrame([(1, "Stocks are not falling today"), (2, "  "), (3, None)], "doc_id long, text string")
    got = dict(full_pipeline(df).collect())
    assert got == {1: "stocks not falling today", 2: "", 3: ""}
    stemmed = dict(full_pipeline(df, use_stem=True).collect())
    assert stemmed == {1: "stock not fall today", 2: "", 3: ""}


def test_lemma_dictionary_keeps_order(spark):
    df = spark.createDataFrame([(1, "rates rise rates fall")], "doc_id long, text string")
    dictionary = spark.createDataFrame([("rates", "rate")], "token string, lemma string")
    assert full_pipeline(df, dictionary=dictionary).first()["clean"] == "rate rise rate fall"


def test_stemmer_on_published_pairs():
    pairs = {
        "caresses": "caress", "ties": "tie", "cries": "cri", "gas": "gas", "gaps": "gap", "agreed": "agre",
        "hopping": "hop", "hoping": "hope", "happy": "happi", "relational": "relat", "consigned": "consign",
        "consistency": "consist", "knightly": "knight", "generously": "generous", "skies": "sky", "news": "news",
        "dying": "die", "falling": "fall", "national": "nation", "conditional": "condit", "by": "by", "say": "say",
    }
    assert {w: stem_word(w) for w in pairs} == pairs


def test_counts(spark):
    assert one(spark, s.cashtag_count, "$TOOLONG $aapl $A") == 2
    assert one(spark, s.caps_ratio, "A b CD 12") == 0.5
    assert one(spark, s.caps_ratio, "") == 0.0
    assert one(spark, lambda x: s.mark_count(x, "!"), "a!!b!") == 3


def test_lexicon_rules(spark):
    rows = [
        (1, "great quarter"), (2, "not great quarter"), (3, "very great quarter"), (4, "nothing here"),
        (5, "great quarter!!!"), (6, "good news but terrible guidance"), (7, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lexicon_scores(df, default_lexicon(spark)).collect()}
    comp = {i: r["lex_compound"] for i, r in got.items()}
    assert comp[1] == round(3.1 / (3.1**2 + 15) ** 0.5, 4)
    assert comp[2] == round(-2.294 / (2.294**2 + 15) ** 0.5, 4)
    assert comp[3] > comp[1] and comp[5] > comp[1]
    assert comp[4] == 0 and comp[7] == 0 and comp[6] < 0
    assert len(got) == 7
    assert abs(got[1]["lex_pos"] + got[1]["lex_neu"] + got[1]["lex_neg"] - 1) < 0.002


def test_cut_offs(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0,)], "c double").repartition(1)
    assert [r[0] for r in df.select(lexicon_class(F.col("c"))).collect()].count(2) == 1
    assert all(r[0] == 2 for r in df.select(lexicon_class(F.col("c"), strict=True)).collect())


def test_a_text_is_cleaned_once(spark):
    """The choice between a text and its decomposition cleaned it once for each, and an explode once more before it."""
    from textsignal.functions.surface import surface_columns
    from textsignal.operators.tokens import stem_vocabulary

    df = spark.createDataFrame([(1, "Cafés won't RUN"), (2, None), (3, ""), (4, "running cats")], "doc_id long, text string")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    tokens = df.select(c.pipeline_tokens(F.col("text")).alias("tokens"))
    vocabulary = stem_vocabulary(tokens, "tokens")
    assert {r.token: r.target for r in vocabulary.collect()} == {"cafes": "cafe", "not": "not", "run": "run", "running": "run", "cats": "cat"}
    assert plan(df.select(c.normalize_text(F.col("text")).alias("x"))).count("can not") == 1
    assert plan(vocabulary).count("can not") == 1
    words = c.each(df, c.words(F.col("text")), "word", "doc_id")
    assert sorted((r.doc_id, r.word) for r in words.collect()) == [(1, "Cafés"), (1, "RUN"), (1, "won't"), (4, "cats"), (4, "running")]
    assert plan(words).count("split(") == 1
    rows = spark.createDataFrame([("ÉTÉ rhythm B1 12 İI\u0085the end. e",)], "text string")
    got = rows.select(*[x.alias(n) for n, x in surface_columns(F.col("text")).items()]).first()
    assert (got.word_count, round(got.all_caps_ratio, 6)) == (8, 0.375)
    assert abs(got.flesch_score - (206.835 - 1.015 * 8 - 84.6 * 9 / 8)) < 1e-9


@pytest.mark.parametrize("normalised", [True, False])
def test_overlap_makes_each_key_once(spark, normalised):
    """The join's filter for keys that are not null cleaned every text a second time."""
    from textsignal.operators.audit import overlap

    left = spark.createDataFrame([("Up …",), ("Up …",), ("up",), (None,), ("only here",), ("",)], "text string")
    right = spark.createDataFrame([("Up …",), (None,), ("there",), ("",), ("",)], "text string")
    found = overlap(left, right, normalised)
    assert tuple(found.first()) == ((4, 2) if normalised else (3, 2))
    assert tuple(overlap(left, right.limit(0), normalised).first()) == (0, 0)
    assert tuple(overlap(left.limit(0), right, normalised).first()) == (0, 0)
    assert "isnotnull(sha2" not in found._jdf.queryExecution().optimizedPlan().toString()
