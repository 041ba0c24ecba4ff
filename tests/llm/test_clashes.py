"""Columns of any name go through every operator that keeps its input's columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm import decontaminate, language, line_dedup, near_dup, packing, pii, quotes, shard, toxicity

NAMES = "_id _key _spans _tokens _c _t _k _arc _part _size _row _a _p _group _b _found _bin _from _grain _rank _text row found id key block number grp".split()
PIECES = language.Pieces.load(language.VOCABULARY)
LANGUAGE = language.LanguageModel([], PIECES, np.zeros((PIECES.size, 0)))


@pytest.fixture
def crowded(make):
    docs = make([(1, "a text of mine\nmail joe@mail.com", 3), (2, "another one entirely here", 3), (3, None, 3)], "doc_id long, text string, conv_id long")
    return docs.withColumn("turn", F.col("doc_id")).withColumns({n: F.lit(n) for n in NAMES})


def none_toxic(spark):
    return toxicity.train(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))


CASES = {
    "language": lambda d: language.identify(d, LANGUAGE),
    "toxicity": lambda d: toxicity.score_toxicity(d, none_toxic(d.sparkSession)),
    "ring": lambda d: shard.shard_by_ring(d, F.col("text"), F.lit(1), F.col("doc_id"), 2),
    "packing": lambda d: packing.pack(d, F.col("doc_id")),
    "personal data": lambda d: pii.sanitise(d),
    "quotes": lambda d: quotes.link_quotes(d),
    "near_dedup": lambda d: near_dup.one_per_component(d),
    "benchmark": lambda d: decontaminate.decontaminate(d, d.select(F.lit(1).alias("item_id"), F.lit("nothing of it").alias("text"))),
    "lines": lambda d: line_dedup.drop_common_lines(d),
}


@pytest.mark.parametrize("name", CASES)
def test_crowded_rows(crowded, name):
    out = CASES[name](crowded)
    assert out.columns[: len(crowded.columns)] == crowded.columns and out.count() == 3
    assert {tuple(r[n] for n in NAMES) for r in out.collect()} == {tuple(NAMES)}
