"""The 14-column feature row, scaling and fusion."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from textsignal.functions.surface import surface_columns
from textsignal.operators.lexicon import lexicon_scores

LEXICON_COLUMNS = ["lex_pos", "lex_neg", "lex_neu", "lex_compound"]
SURFACE_COLUMNS = [
    "n_cashtags", "n_hashtags", "n_mentions", "has_url", "word_count", "char_count",
    "exclamation", "question", "all_caps_ratio", "flesch_score",
]
FEATURE_COLUMNS = LEXICON_COLUMNS + SURFACE_COLUMNS


def feature_rows(df: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fourteen named features per row; only numbers are joined, never the text."""
    surface = df.select(id_col, *[c.alias(n) for n, c in surface_columns(F.col(text_col)).items()])
    return surface.join(lexicon_scores(df, lexicon, id_col, text_col), id_col).select(id_col, *FEATURE_COLUMNS)


def to_vector_column(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    packed = F.array(*[F.col(c).cast("double") for c in columns])
    return df.withColumn(out, array_to_vector(packed)).drop(*columns)


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean and unit population deviation per column; constant columns become 0.

    All moments come from one aggregate that is read as a one-row subquery.
    """
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
        ).alias("stats")
    )
    with_stats = df.withColumn("_stats", stats.scalar())

    def scale(c: str):
        s = F.col("_stats")[f"s_{c}"]
        return ((F.col(c) - F.col("_stats")[f"m_{c}"]) / F.when(s > 0, s).otherwise(1.0)).alias(c)

    return with_stats.select(*[scale(c) if c in columns else F.col(c) for c in df.columns])


def fuse(left: DataFrame, right: DataFrame, id_col: str, left_col: str, right_col: str, out: str) -> DataFrame:
    """Concatenate two array feature blocks by id."""
    joined = left.select(id_col, left_col).join(right.select(id_col, right_col), id_col)
    return joined.select(id_col, F.concat(left_col, right_col).alias(out))
