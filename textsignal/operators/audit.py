"""Corpus audit: balance, lengths, corruption, duplicates, overlap, shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.functions import clean, surface
from textsignal.operators.lexicon import lexicon_class
from textsignal.operators.split import head_per_group


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, n, share, imbalance)``; imbalance is the largest over the smallest class."""
    everyone = Window.partitionBy(F.lit(0))  # one row per class
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns(
        {
            "share": F.col("n") / F.sum("n").over(everyone),
            "imbalance": F.max("n").over(everyone) / F.min("n").over(everyone),
        }
    )


def describe_by(df: DataFrame, by: str, values: dict[str, Column]) -> DataFrame:
    """``(by, metric, count, mean, std, min, q25, q50, q75, max)`` with linear quartiles.

    Values are first merged into a histogram, so the exact percentiles run over
    distinct lengths and not over rows.
    """
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), c.cast("long").alias("v")) for k, c in values.items()])
    hist = df.select(by, F.inline(rows)).groupBy(by, "metric", "v").agg(F.count(F.lit(1)).alias("w"))
    total, s1 = F.sum("w"), F.sum(F.col("w") * F.col("v"))
    mean = s1 / total
    moments = hist.groupBy(by, "metric").agg(
        total.alias("count"),
        mean.alias("mean"),
        F.min("v").alias("min"),
        *[F.percentile("v", F.lit(q / 100), F.col("w")).alias(f"q{q}") for q in (25, 50, 75)],
        F.max("v").alias("max"),
        F.sum(F.col("w") * F.col("v") * F.col("v")).alias("_s2"),
        s1.alias("_s1"),
    )
    squares = F.col("_s2") - F.col("_s1") * F.col("_s1") / F.col("count")
    var = F.when(F.col("count") > 1, squares / F.nullif(F.col("count") - 1, F.lit(0)))  # one row has no deviation
    return moments.withColumn("std", F.when(F.col("count") > 1, F.sqrt(F.greatest(var, F.lit(0.0))))).drop("_s1", "_s2")


def surface_means(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Mean counts of hashtags, mentions, cashtags and links."""
    t = F.col(text)
    return df.groupBy(by).agg(
        F.avg(surface.hashtag_count(t)).alias("hashtags"),
        F.avg(surface.mention_count(t)).alias("mentions"),
        F.avg(surface.cashtag_count(t)).alias("cashtags"),
        F.avg(surface.url_count(t)).alias("urls"),
    )


def corruption_rates(df: DataFrame, by: str = "label", text: str = "text") -> DataFrame:
    """Corrupted rows per class and overall (null class)."""
    flagged = df.select(by, clean.has_misread(F.col(text)).alias("bad"))
    out = flagged.rollup(by).agg(F.count_if("bad").alias("corrupted"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("pct", 100 * F.col("corrupted") / F.col("total"))


def repair_examples(df: DataFrame, by: str, id_col: str, text: str = "text", n: int = 2, width: int = 100) -> DataFrame:
    """First ``n`` corrupted rows per class, before and after; unchanged ones dropped afterwards."""
    bad = df.filter(clean.has_misread(F.col(text)))
    heads = head_per_group(bad, [by], [id_col], n)
    fixed = clean.fix_encoding(F.col(text))
    return heads.filter(fixed != F.col(text)).select(
        by, id_col, clean.preview(F.col(text), width).alias("before"), clean.preview(fixed, width).alias("after")
    )


def _key(text: Column, normalised: bool) -> Column:
    """Fixed-width digest of a (normalised) text, so that whole texts are not shuffled."""
    return F.sha2(clean.near_duplicate_key(text) if normalised else text, 256)


def duplicate_groups(df: DataFrame, normalised: bool, text: str = "text", label: str | None = None) -> DataFrame:
    """``(key, n[, n_labels])`` per distinct text; copies are merged before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        aggs += [F.min(label).alias("lo"), F.max(label).alias("hi")]
    return df.select(_key(F.col(text), normalised).alias("key"), *([label] if label else [])).groupBy("key").agg(*aggs)


def exact_duplicates(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows beyond the first of each text, and how many texts repeat."""
    g = duplicate_groups(df, False, text)
    return g.agg(
        F.sum(F.col("n") - 1).alias("extra_rows"), F.count_if(F.col("n") > 1).alias("groups"), F.sum("n").alias("rows")
    )


def near_duplicates(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows in groups of more than one after normalising, and their percentage."""
    g = duplicate_groups(df, True, text)
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0))
    return g.agg(repeated.alias("rows_in_groups"), (100 * repeated / F.sum("n")).alias("pct"))


def conflicting_groups(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Near-duplicate groups that carry different labels."""
    g = duplicate_groups(df, True, text, label)
    return g.agg(F.count_if(F.col("lo") != F.col("hi")).alias("conflicting_groups"))


def overlap(left: DataFrame, right: DataFrame, normalised: bool, text: str = "text") -> DataFrame:
    """Rows of ``left`` whose text also occurs in ``right``.

    Both sides are counted by key in one aggregation, so a text with very many copies is a single row, and no join
    asks for keys that are not null, for which every key would be made a second time.
    """
    key = _key(F.col(text), normalised).alias("key")
    sides = left.select(key, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(right.select(key, F.lit(0).alias("a"), F.lit(1).alias("b")))
    found = sides.groupBy("key").agg(F.sum("a").alias("n"), F.max("b").alias("b"))
    hit = F.col("key").isNotNull() & (F.col("n") > 0) & (F.col("b") > 0)
    return found.agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rows"), F.count_if(hit).alias("texts"))


def shift_table(left: DataFrame, right: DataFrame, text: str = "text") -> DataFrame:
    """``(metric, a, b)`` of surface statistics of two tables."""

    def stats(df: DataFrame, side: str) -> DataFrame:
        t = F.col(text)
        pct = lambda c: 100 * F.avg(c.cast("double"))
        one = df.agg(
            F.avg(surface.word_count(t)).alias("mean_words"),
            F.max(surface.word_count(t)).cast("double").alias("max_words"),
            pct(surface.cashtag_count(t) > 0).alias("pct_cashtag"),
            pct(surface.url_flag(t) > 0).alias("pct_url"),
            pct(clean.has_misread(t)).alias("pct_misread"),
        )
        return one.unpivot([], one.columns, "metric", side)

    return stats(left, "a").join(stats(right, "b"), "metric")


def lexicon_histogram(df: DataFrame, by: str = "label", value: str = "lex_compound", bins: int = 30) -> DataFrame:
    """``(by, bin, n, mean)``: equal bins between the smallest and largest score of a class."""
    stats = df.groupBy(by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.avg(value).alias("mean"))
    rows = df.select(by, value).join(F.broadcast(stats), by)  # one row per class
    width = F.col("_hi") - F.col("_lo")
    place = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width) * bins)  # null if all scores are equal
    bin_id = F.when(width > 0, F.least(place, F.lit(bins - 1)))
    return rows.groupBy(by, F.coalesce(bin_id, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.max("mean").alias("mean")
    )


def lexicon_ambiguity(df: DataFrame, label_value: int, label: str = "label", value: str = "lex_compound") -> DataFrame:
    """How a lexicon with strict cut-offs calls the rows of one class."""
    rows = df.filter(F.col(label) == label_value).select(lexicon_class(F.col(value), strict=True).alias("c"))
    n = F.count(F.lit(1))
    one = rows.agg(n.alias("total"), *[F.count_if(F.col("c") == k).alias(v) for k, v in ((1, "positive"), (0, "negative"), (2, "neutral"))])
    pct = {f"{v}_pct": F.round(F.try_divide(100 * F.col(v), F.col("total")), 1) for v in ("positive", "negative", "neutral")}
    return one.withColumns(pct)


def share_containing(df: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    return df.agg((100 * F.avg(F.col(text).rlike(pattern).cast("double"))).alias("pct"))


def share_changed(df: DataFrame, cleaned: Column, text: str = "text") -> DataFrame:
    return df.agg((100 * F.avg((cleaned != F.col(text)).cast("double"))).alias("pct"))
