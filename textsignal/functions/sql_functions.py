"""Cleaning and feature functions for SQL: made from the column expressions, evaluated by the JVM.

The body of each function is the SQL text of its column expression, so SQL users and DataFrame users run one
definition, and Spark inlines it into the plan: no Python worker is started.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession, functions as F

from textsignal.functions import clean, surface

TEXT_FUNCTIONS: dict[str, Callable[[Column], Column]] = {
    "mark_urls": clean.mark_urls,
    "mark_mentions": clean.mark_mentions,
    "mark_cashtags": clean.mark_cashtags,
    "unwrap_hashtags": clean.unwrap_hashtags,
    "drop_entities": clean.drop_entities,
    "squeeze_spaces": clean.squeeze_spaces,
    "clean_noise": clean.clean_noise,
    "straighten_apostrophes": clean.straighten_apostrophes,
    "expand_contractions": clean.expand_contractions,
    "strip_truncation": clean.strip_truncation,
    "drop_bare_urls": clean.drop_bare_urls,
    "strip_trailing": clean.strip_trailing,
    "fix_encoding": clean.fix_encoding,
    "fix_text": clean.fix_text,
    "eda_clean": clean.eda_clean,
    "near_duplicate_key": clean.near_duplicate_key,
}
OTHER_FUNCTIONS: dict[str, tuple[Callable[[Column], Column], str]] = {
    "has_misread": (clean.has_misread, "BOOLEAN"),
    "text_words": (clean.words, "ARRAY<STRING>"),
    "tweet_tokens": (clean.tokenize, "ARRAY<STRING>"),
    **{name: (fn, "INT") for name, fn in {
        "cashtag_count": surface.cashtag_count,
        "hashtag_count": surface.hashtag_count,
        "mention_count": surface.mention_count,
        "url_flag": surface.url_flag,
        "url_count": surface.url_count,
        "word_count": surface.word_count,
    }.items()},
    "caps_ratio": (surface.caps_ratio, "DOUBLE"),
    "reading_ease": (surface.reading_ease, "DOUBLE"),
}
ARGUMENT = "input_text"
# A literal, or a function that is named by signs or a keyword and called like any other: only the second is quoted.
_CALLS = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])([=<>!+\-*/%&|^]+|and|or|not|in)(?=\()", re.IGNORECASE | re.DOTALL)


def sql_text(column: Column) -> str:
    """The expression behind ``column`` as SQL."""
    return _CALLS.sub(lambda m: m[1] or f"`{m[2]}`", column._jc.node().sql())


def register_functions(spark: SparkSession, prefix: str = "ts_") -> list[str]:
    """Makes all functions known to the session's SQL, named ``prefix`` + name; returns the names.

    Each takes one STRING.  A null text gives what the column expression gives for a null.
    """
    made = []
    for name, (fn, kind) in {**{n: (f, "STRING") for n, f in TEXT_FUNCTIONS.items()}, **OTHER_FUNCTIONS}.items():
        body = sql_text(fn(F.col(ARGUMENT)))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({ARGUMENT} STRING) RETURNS {kind} RETURN {body}")
        made.append(prefix + name)
    return made
