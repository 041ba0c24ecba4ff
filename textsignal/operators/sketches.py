"""Approximate vocabulary sizes and heavy terms: mergeable sketches, stored per part of the corpus.

A sketch is a few kilobytes however many tokens it has seen, and sketches of parts merge into that of the whole.  So a
part that is added later is sketched on its own; nothing that was read before is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PRECISION = 14  # 2^14 registers: the standard error of a distinct count is under 1 %
TRACKED = 20_000  # terms that a heavy-term sketch keeps counts of


def token_sketches(tokens: DataFrame, part: Column | str, term: str = "term") -> DataFrame:
    """``(part, n_tokens, distinct_sketch, heavy_sketch)`` of a table of single tokens."""
    part = F.col(part) if isinstance(part, str) else part
    return tokens.groupBy(part.alias("part")).agg(
        F.count(term).alias("n_tokens"),
        F.hll_sketch_agg(term, PRECISION).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate({term}, {TRACKED})").alias("heavy_sketch"),
    )


def merge_sketches(sketches: DataFrame, part: Column | None = None) -> DataFrame:
    """Sketches of coarser parts, of the whole corpus by default, from stored ones."""
    part = F.lit("all") if part is None else part
    return sketches.groupBy(part.alias("part")).agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.expr(f"approx_top_k_combine(heavy_sketch, {TRACKED})").alias("heavy_sketch"),
    )


def vocabulary_size(sketches: DataFrame) -> DataFrame:
    """``(part, n_tokens, n_terms)``: the estimated number of distinct terms."""
    return sketches.select("part", "n_tokens", F.hll_sketch_estimate("distinct_sketch").alias("n_terms"))


def heavy_terms(sketches: DataFrame, k: int) -> DataFrame:
    """``(part, rank, term, n)``: the ``k`` most frequent terms by estimated count, ties by term."""
    top = F.expr(f"approx_top_k_estimate(heavy_sketch, {4 * k})")  # more than asked, so that ties at the end are all seen
    ordered = F.sort_array(F.transform(top, lambda e: F.struct((-e["count"]).alias("minus"), e["item"].alias("term"))))
    rows = sketches.select("part", F.posexplode(F.slice(ordered, 1, k)).alias("at", "e"))
    return rows.select("part", (F.col("at") + 1).alias("rank"), F.col("e.term").alias("term"), (-F.col("e.minus")).alias("n"))
