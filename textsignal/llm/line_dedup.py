"""Line dedup: a sharded minimal perfect hash indexes document counts of all distinct lines; documents probe it.

Documents are dealt to small groups.  A group holds each of its distinct line hashes once and sends it to the shard
that owns the hash; the shard's arrays answer with the number of documents.  So a line that a third of all documents
hold meets its shard once a group, not once a document, and no task ever holds more than one shard's arrays.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import store, without

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
SHARD_KEYS = 8192  # (group, line) pairs per shard on average: bounds the distinct lines of a shard, some 80 KB of arrays
GROUP_DOCS = 64  # documents that ask together
BITS_PER_KEY = 2  # bits of a level of the hash per key that is still to be placed
LEVELS = 64
RESULTS = ("n_lines", "n_dropped", "kept")
INDEX = "shard long, n_keys long, sizes array<long>, bits binary, prints binary, counts binary"


def line_digests(text: Column, min_chars: int) -> Column:
    """Distinct 128-bit hashes of the line keys of a text that have at least ``min_chars`` code points."""
    keys = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.translate(F.btrim(x, F.lit(SPACES)), UPPER, LOWER))
    return F.array_distinct(F.transform(F.filter(keys, lambda k: F.char_length(k) >= min_chars), lambda k: F.unhex(F.md5(k))))


def key_of(line: str) -> str:
    """The same key as in ``line_digests``, for the last pass over a text."""
    return line.strip(SPACES).translate(FOLD)


# ---- minimal perfect hash over 128-bit hashes, given as pairs of unsigned longs


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """A pseudo-random place below ``size`` for each key, another one on every level."""
    x = keys[:, 0] ^ (keys[:, 1] * np.uint64(2 * level + 0x9E3779B97F4A7C15)) ^ np.uint64(level)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, one after another.

    A key is placed on the first level where no other key left wants its bit; the number of set bits before that
    one is the key's slot, so n keys take the slots 0 to n - 1.
    """
    left, sizes, bits = np.arange(len(keys)), [], []
    for level in range(LEVELS):
        if not len(left):
            break
        sizes.append(64 * math.ceil(BITS_PER_KEY * len(left) / 64))
        places = _places(keys[left], level, sizes[-1])
        bits.append(np.bincount(places, minlength=sizes[-1]) == 1)
        left = left[~bits[-1][places]]
    if len(left):
        raise ValueError("keys of a perfect hash must differ")
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(keys: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each key; some slot or -1 for a key that was not placed."""
    found, left, start, rank = np.full(len(keys), -1), np.arange(len(keys)), 0, np.cumsum(bits) - 1
    for level, size in enumerate(sizes):
        places = start + _places(keys[left], level, size)
        hit = bits[places]
        found[left[hit]] = rank[places[hit]]
        left, start = left[~hit], start + size
    return found


def as_keys(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def prints_of(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 1] >> np.uint64(32)).astype("<u4")


# ---- the index as a table: a row per shard


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long"), F.lit(shards))


def line_index(asks: DataFrame, shards: int) -> DataFrame:
    """Index rows of all distinct ``digest``s of ``asks`` (digest, n): perfect hash, fingerprints and counts by slot.

    Counts are summed before they meet, so a shard gets one row per distinct line.  Counts end at 2^32 - 1.
    """

    def build(part: pd.DataFrame) -> pd.DataFrame:
        keys = as_keys(part["digest"])
        sizes, bits = perfect_hash(keys)
        at = slots(keys, sizes, bits)
        prints, counts = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u4")
        prints[at] = prints_of(keys)
        counts[at] = np.minimum(part["n"].to_numpy(), 2**32 - 1)
        row = (part["shard"].iloc[0], len(keys), sizes, np.packbits(bits).tobytes(), prints.tobytes(), counts.tobytes())
        return pd.DataFrame([row], columns=["shard", "n_keys", "sizes", "bits", "prints", "counts"])

    counted = asks.groupBy("digest").agg(F.sum("n").alias("n")).withColumn("shard", shard_of(F.col("digest"), shards))
    return counted.groupBy("shard").applyInPandas(build, INDEX)


class Shard:
    """Arrays of one index row."""

    def __init__(self, row):
        self.sizes = [int(x) for x in row.sizes]
        self.bits = np.unpackbits(np.frombuffer(row.bits, np.uint8), count=sum(self.sizes)).astype(bool)
        self.prints, self.counts = np.frombuffer(row.prints, "<u4"), np.frombuffer(row.counts, "<u4")

    def count(self, digests) -> np.ndarray:
        """Documents with each line; 0 for a line whose fingerprint the index does not hold."""
        keys = as_keys(digests)
        at = slots(keys, self.sizes, self.bits)
        safe = np.maximum(at, 0)
        return np.where((at >= 0) & (self.prints[safe] == prints_of(keys)), self.counts[safe], 0)


def probe(index: DataFrame, asks: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(grp, digest) of those ``asks`` that at least ``min_docs`` documents of the index hold.

    Index rows and questions are placed by shard, the index row first; a task goes through them as a stream and keeps
    the arrays of one shard.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, arrays = None, None
        for batch in batches:
            out = []
            for _, part in batch.groupby((batch["shard"] != batch["shard"].shift()).cumsum(), sort=False):
                if part["grp"].isna().iloc[0]:
                    head = part.iloc[0]
                    shard, arrays, part = head["shard"], Shard(head), part.iloc[1:]
                elif part["shard"].iloc[0] != shard:  # lines that only the asking table has
                    continue
                if len(part):
                    out.append(part.loc[arrays.count(part["digest"]) >= min_docs, ["grp", "digest"]])
            if out:
                yield pd.concat(out).astype({"grp": "int64"})

    no = lambda kind: F.lit(None).cast(kind)
    rows = index.select("shard", no("long").alias("grp"), no("binary").alias("digest"), "sizes", "bits", "prints", "counts")
    wanted = asks.select(
        shard_of(F.col("digest"), shards).alias("shard"),
        "grp",
        "digest",
        no("array<long>").alias("sizes"),
        *[no("binary").alias(c) for c in ("bits", "prints", "counts")],
    )
    placed = rows.unionByName(wanted).repartition("shard").sortWithinPartitions("shard", F.col("grp").asc_nulls_first())
    return placed.mapInPandas(answer, "grp long, digest binary")


def _without_lines(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    known: dict[bytes, set[bytes]] = {b"": set()}  # a batch knows few groups, so each list is cut up once
    out = []
    for text, joined in zip(texts, dropped, strict=True):
        joined = joined or b""
        if joined not in known:
            known[joined] = {joined[i : i + 16] for i in range(0, len(joined), 16)}
        drop, lines = known[joined], (text or "").split("\n")
        kept = [x for x in lines if not drop or hashlib.md5(key_of(x).encode()).digest() not in drop]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """``docs`` with ``n_lines`` (before), ``n_dropped`` and ``kept``: the text without lines of ``min_docs`` documents.

    A line's key is the line without spaces (U+0020, U+0009 to U+000D) at both ends, A-Z in lower case.  A document is
    a row: repeated rows, and rows that share or lack an id, count each; a document counts once for a line however
    often it has it.  Keys under ``min_chars`` code points stay.  Null and empty texts are one empty line, so
    ``n_lines`` is 1 and ``kept`` empty.  There are no ties: a line either reaches ``min_docs`` or not.  An empty
    table gives an empty table.  Any other columns may have any names; those named like a result are replaced.

    Lines are compared by 128-bit hashes.  Every line asked for is in the index, so a fingerprint never decides here;
    an index asked for lines of other tables is wrong for one unknown line in 2^32.

    One exchange of the texts (the last join); the others move 16 bytes a distinct line and group.  Rows that agree in
    all columns share a group; the join is an outer one of Spark, so adaptive execution splits a group of many copies.
    """
    docs = without(docs, *RESULTS)
    groups = max(1, math.ceil(docs.count() / GROUP_DOCS))
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    grp = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(groups)).alias("grp")
    boxed = docs.select(grp, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    lines = boxed.select("grp", F.explode(line_digests(F.col("row")[text], min_chars)).alias("digest"))
    asks = store(lines.groupBy("grp", "digest").agg(F.count(F.lit(1)).alias("n")), "line-asks")
    shards = max(1, math.ceil(asks.count() / SHARD_KEYS))
    index = store(line_index(asks, shards), "line-index")
    dropped = probe(index, asks, shards, min_docs).groupBy("grp").agg(F.listagg("digest").alias("dropped"))
    kept = F.pandas_udf(_without_lines, "n_lines long, n_dropped long, kept string")
    found = boxed.join(dropped, "grp", "left").select("row", kept(F.col("row")[text], F.col("dropped")).alias("found"))
    return found.select("row.*", "found.*")
