"""Packing: optimal length buckets, token-budget batches inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import box, gapless

BUCKETS = 16
TOKEN_BUDGET = 65_536  # padded tokens of a batch
EXACT = 4096  # lengths up to here are kept as they are, longer ones at 1024 steps per doubling


def word_tokens(text: Column) -> Column:
    """Whitespace-separated words: the token count used unless another is given."""
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "))
    return F.when(F.coalesce(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit("")) == "", 0).otherwise(words).cast("long")


def grain(length: Column) -> Column:
    """The length rounded up to where a bucket may end; bounds the histogram whatever the longest text."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(EXACT)).cast("double"))) - 10).cast("long")
    return F.when(length <= EXACT, length).otherwise(F.ceil(length / step).cast("long") * step)


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend, ``counts`` say how many rows have each.  cost(i, j) pads lengths i to j up to length j;
    the last column of dynamic programming over (buckets, lengths).  The cost obeys the quadrangle
    inequality, so the best split moves right with j and each row is filled by divide and conquer.
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    buckets = min(buckets, n)
    best = lengths * rows[1:] - tokens[1:]  # one bucket for lengths 0..j
    splits = []
    for k in range(1, buckets):
        now, cut = best.copy(), np.full(n, -1)
        todo = [(k, n - 1, k, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            starts = np.arange(first, min(last, j) + 1)  # first length of the last bucket
            cost = best[starts - 1] + lengths[j] * (rows[j + 1] - rows[starts]) - (tokens[j + 1] - tokens[starts])
            at = int(cost.argmin())
            if cost[at] <= now[j]:
                now[j], cut[j] = cost[at], starts[at]
            todo += [(low, j - 1, first, int(starts[at])), (j + 1, high, int(starts[at]), last)]
        splits.append(cut)
        best = now
    ends, j = [], n - 1
    for cut in reversed(splits):
        if j < 0:
            break
        if cut[j] < 0:
            continue
        ends.append(int(lengths[j]))
        j = int(cut[j]) - 1
    if j >= 0:
        ends.append(int(lengths[j]))
    return ends[::-1]


def pack(
    docs: DataFrame,
    row_id: Column,
    n_tokens: Column | None = None,
    text_col: str = "text",
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``bucket``, ``padded`` (its length in the batch), ``batch`` and ``place`` (in the batch).

    Bucket ends minimise the padding of all rows together.  The driver sees the histogram of lengths:
    every length up to 4096 and 1024 steps per doubling beyond, where padding to the step counts too.  A batch of a
    bucket holds as many rows as its end fits into ``token_budget``, one at least, all full but
    the last; batches are numbered per bucket.  Rows of a bucket are mixed by a hash of ``row_id``.

    Every row is packed once.  Null and empty texts have no tokens and join the first bucket; a null
    count is 0; repeated rows get places of their own; an empty table gives an empty table.  Columns named like a
    result are replaced, all others stay.  ``docs`` is read three times: store it if it is costly.
    """
    results = ["n_tokens", "bucket", "padded", "batch", "place"]
    counted = word_tokens(F.col(text_col)) if n_tokens is None else n_tokens.cast("long")
    tokens = F.greatest(F.coalesce(counted, F.lit(0)), F.lit(0)).alias("_tokens")
    sized = docs.select(box(docs, *results), tokens, row_id.alias("_row")).withColumn("_grain", grain(F.col("_tokens")))
    histogram = sorted((r["_grain"], r["count"]) for r in sized.groupBy("_grain").count().collect())
    lengths = np.array([g for g, _ in histogram], np.int64)
    counts = np.array([c for _, c in histogram], np.int64)
    ends = best_boundaries(lengths, counts, buckets)
    bucket = F.lit(None).cast("int")
    padded = F.lit(None).cast("long")
    for b in range(len(ends) - 1, -1, -1):
        bucket = F.when(F.col("_grain") <= ends[b], b).otherwise(bucket)
        padded = F.when(F.col("_grain") <= ends[b], ends[b]).otherwise(padded)
    dealt = sized.withColumn("bucket", bucket.cast("int")).withColumn("padded", padded.cast("long"))
    ranked = gapless(dealt, "bucket", [F.xxhash64("_row"), F.col("_row"), F.col("_tokens")], "_rank")
    rows = F.greatest(F.floor(token_budget / F.greatest("padded", F.lit(1))), F.lit(1)).cast("long")
    return ranked.select(
        "row.*",
        F.col("_tokens").alias("n_tokens"),
        "bucket",
        "padded",
        F.floor(F.col("_rank") / rows).cast("long").alias("batch"),
        (F.col("_rank") % rows).cast("long").alias("place"),
    )
