"""Benchmark decontamination: Wu-Manber search for many word windows at once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import box, store

WINDOW = 10
BLOCK_WORDS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # the words of ``words_of`` in lower-cased text, for Spark

# One pass over the bytes: A-Z to a-z, every ASCII byte that belongs to no word to a space.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)

RESULT = "n_words long, n_hit long, hit_spans array<struct<start:long,end:long>>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Patterns:
    """Wu-Manber tables for windows of one length ``m``, in words.

    A block is the last ``b`` words of the place looked at.  ``shift`` has for every
    block of a window its least distance to a window's end; a block in no window
    lets the search skip ``m - b + 1`` words.  Windows that end in a block stand in
    its bucket, keyed further by their first block, and are compared word by word.
    """

    def __init__(self, m: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.m, self.b = m, min(2, m)
        self.far = m - self.b + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for window, items in windows.items():
            for end in range(self.b, m + 1):
                block = self.block(window, end - 1)
                self.shift[block] = min(self.shift.get(block, self.far), m - end)
            suffix, prefix = self.block(window, m - 1), self.block(window, self.b - 1)
            self.buckets.setdefault(suffix, {}).setdefault(prefix, []).append((list(window), sorted(items)))

    def block(self, words, i: int):
        return (words[i - 1], words[i]) if self.b == 2 else words[i]

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """First word and items of every occurrence, overlapping ones included."""
        i, n, m, far, shift, block = self.m - 1, len(words), self.m, self.far, self.shift.get, self.block
        while i < n:
            here = (words[i - 1], words[i]) if self.b == 2 else words[i]
            step = shift(here, far)
            if step:
                i += step
                continue
            first = i - m + 1
            for window, items in self.buckets[here].get(block(words, first + self.b - 1), ()):
                if words[first : i + 1] == window:
                    yield first, items
            i += 1


def compile_patterns(items: list[tuple[str, str]], window: int = WINDOW) -> list[Patterns]:
    """Tables for ``(item, text)`` rows: one for full windows, one per length of shorter items."""
    by_length: dict[int, dict] = {}
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for s in range(len(words) - m + 1 if m else 0):
            by_length.setdefault(m, {}).setdefault(tuple(words[s : s + m]), set()).add(item)
    return [Patterns(m, windows) for m, windows in sorted(by_length.items())]


def search(words: list[bytes], tables: list[Patterns]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged word spans (end exclusive) and items."""
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for table in tables:
        for first, named in table.find(words):
            found.append((first, first + table.m))
            items.update(named)
    spans: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans, items


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> tuple[DataFrame, int]:
    """(item, text, block) of distinct items, and the number of blocks; a block holds about ``block_words`` words.

    An item longer than a block is cut into pieces that overlap by a window less one word, so no window is lost and
    no block is much longer than the others.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text")
    ).filter("text IS NOT NULL")
    items = items.distinct()
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)), F.lit(block_words))
    pieces = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, block_words + window - 1), " "))
    long = F.length("text") > block_words  # else it has fewer words than that, whatever they are
    cut = items.filter(long).withColumn("words", words).select("item", F.explode(pieces).alias("text"))
    items = store(items.filter(~long).unionByName(cut), "benchmark-items")
    size = items.agg(F.sum(F.length("text") / 6)).first()[0] or 0.0
    n = int(size // block_words) + 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with the words that repeat a window of a benchmark item.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  A window is
    ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window.  Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``hit_spans`` (merged
    word spans, end exclusive) and ``items`` (ids of the items found, sorted as strings).

    A benchmark of one block is searched for where the texts are read; texts never move.  A larger one is
    searched for block by block, one scan of the stored documents each: a block's tables are built, sent to the
    executors and taken back before the next, so neither driver nor executors ever hold more than one block's.

    A null or empty text has no words and no hits; null or wordless items match nothing; a null
    item id counts as ``null``; repeated items and repeated rows give repeated equal results;
    an empty benchmark leaves every count 0.  Other columns stay; a column with the
    name of a result is replaced.
    """
    results = ["n_words", "n_hit", "hit_spans", "items"]
    items, n = benchmark_blocks(benchmark, item_col, item_text_col, window, block_words)
    text = F.col("row").getField(text_col)
    boxed = docs.select(box(docs, *results))
    if n == 1:
        shared = _shared(items, window)
        out = boxed.withColumn("found", _searcher(shared)(text))
        return out.select("row.*", *[F.col("found")[f].alias(f) for f in results])
    rows = store(boxed.withColumn("number", F.monotonically_increasing_id()), "numbered")
    parts = None
    for block in range(n):
        shared = _shared(items.filter(F.col("block") == block), window)
        hits = rows.select("number", _searcher(shared)(text).alias("found")).filter("found.n_hit > 0")
        hits = store(hits.select("number", "found.hit_spans", "found.items"), "block-hits")
        shared.destroy()
        parts = hits if parts is None else parts.unionByName(hits)
    merged = parts.groupBy("number").agg(
        F.sort_array(F.flatten(F.collect_list("hit_spans"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.coalesce(_merged(F.col("spans")), none)
    out = rows.join(merged, "number", "left").withColumn("hit_spans", spans)
    n_words = F.size(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0)))
    return out.select(
        "row.*",
        n_words.cast("long").alias("n_words"),
        F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"]).alias("n_hit"),
        "hit_spans",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _shared(items: DataFrame, window: int):
    """Broadcast tables of one block."""
    rows = items.select("item", "text").collect()  # about block_words words
    return items.sparkSession.sparkContext.broadcast(compile_patterns([(r["item"], r["text"]) for r in rows], window))


def _merged(spans: Column) -> Column:
    """Sorted spans without overlaps."""

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))
        return F.when((F.size(acc) > 0) & (s["start"] <= last["end"]), joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), step)


def _searcher(shared):
    @F.pandas_udf(RESULT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                spans, items = search(words, tables)
                hit = sum(end - start for start, end in spans)
                rows.append((len(words), hit, [{"start": s, "end": e} for s, e in spans], sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "hit_spans", "items"])

    return find
