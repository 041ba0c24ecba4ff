"""Near-duplicate documents: SimHash linked through the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import store, without

SHINGLE = 4
RADIUS = 4
SEED = 42
CHUNK = 65_536  # shingles of one text whose bits are counted at a time

# A fingerprint is cut into two segments of 24 bits and one of 16.  Of at most 4 differing bits the
# first or the second segment holds at most 1, or the third holds none: 4 < (1 + 1) + (1 + 1) + 1.
SEGMENTS = ((40, 24, 1), (16, 24, 1), (0, 16, 0))  # shift, bits, differences sought
CODE = 15  # length of the perfect code; the other bits of a segment are their own anchor
COVER = 1  # its covering radius


def _hashed(text: str | None, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles of ``width`` words, a chunk at a time; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    if n == 1:
        starts, ends = [0], [len(joined)]
    else:
        ends_of = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends_of[: n - 1].tolist()]
        ends = (ends_of[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        yield np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """64-bit fingerprint, signed: a bit is set if it is set in over half the shingles' hashes."""
    n, votes = 0, np.zeros(64, np.int64)
    for hashes in _hashed(text):
        n += len(hashes)
        votes += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">i8")[0])


def fingerprints(text: Column) -> Column:
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return of(text)


def _near_codewords() -> tuple[np.ndarray, np.ndarray]:
    """For every word of the perfect code's length: the codewords within ``COVER`` + 1, and how far they are.

    Bit i has the parity i + 1; a word is a codeword if the parities of its set bits cancel.
    """
    space = np.arange(1 << CODE, dtype=np.int64)
    parity = np.zeros_like(space)
    for i in range(CODE):
        parity ^= np.where(space >> i & 1, i + 1, 0)
    flips = [(0, 0), *[(1, 1 << i) for i in range(CODE)]]
    flips += [(2, 1 << i | 1 << j) for i in range(CODE) for j in range(i)]
    found = np.full((len(space), 8), -1, np.int64)
    far = np.full((len(space), 8), 99, np.int64)
    used = np.zeros(len(space), np.int64)
    for d, flip in flips:
        rows = np.flatnonzero(parity[space ^ flip] == 0)
        found[rows, used[rows]], far[rows, used[rows]] = rows ^ flip, d
        used[rows] += 1
    return found, far


def anchors_of(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index, anchor, home): every anchor within covering radius plus threshold of each fingerprint.

    ``home`` marks anchors within the covering radius, each segment's nearest, which is one.
    """
    codewords, far = _near_codewords()
    every = np.arange(len(prints))
    for k, (shift, bits, sought) in enumerate(SEGMENTS):
        part = (prints.astype(np.uint64) >> np.uint64(shift)).astype(np.int64) & ((1 << bits) - 1)
        if not sought:  # the segment itself is the anchor: radius and threshold are 0
            yield every, part | k << 32, np.ones(len(prints), bool)
            continue
        free_bits = bits - CODE
        block, free = part >> free_bits, part & ((1 << free_bits) - 1)
        flips = [(0, 0), *[(1, 1 << i) for i in range(free_bits)]]
        flips += [(2, 1 << i | 1 << j) for i in range(free_bits) for j in range(i)]
        for slot in range(codewords.shape[1]):
            code, d = codewords[block, slot], far[block, slot]
            for extra, flip in flips:
                rows = np.flatnonzero(d + extra <= COVER + sought)
                home = (d[rows] <= COVER) & (extra == 0)
                yield rows, code[rows] << free_bits | (free[rows] ^ flip) | k << 32, home


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        prints, nodes = batch["fingerprint"].to_numpy(np.int64), batch["node"].to_numpy(np.int64)
        for rows, anchor, home in anchors_of(prints):
            if len(rows):
                yield pd.DataFrame({"anchor": anchor, "fingerprint": prints[rows], "node": nodes[rows], "home": home})


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): nodes whose distinct fingerprints differ in at most ``radius`` <= 4 bits.

    Of a linked pair one stands at its home anchor, the other visits it there; only these two roles
    meet, and only the pair's lower fingerprint counts as at home, so each anchor yields a link once.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the anchors cover {RADIUS} differing bits, not {radius}")
    rows = nodes.mapInPandas(_anchor_rows, "anchor long, fingerprint long, node long, home boolean")
    rows = store(rows, "anchors")
    home = rows.filter("home").select("anchor", F.col("fingerprint").alias("f"), F.col("node").alias("a"))
    visitor = rows.select("anchor", F.col("fingerprint").alias("g"), F.col("node").alias("b"))
    near = (F.col("f") < F.col("g")) & (F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
    return home.join(visitor, (home["anchor"] == visitor["anchor"]) & near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (a, b) reaches.

    Alternates large-star and small-star steps, each a join with the least neighbour per node;
    the edges of every round are stored, so neither lineage nor driver grows.  A hub's edges are a
    skewed join key, which adaptive execution splits.
    """
    edges = store(
        edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u < v").distinct(), "links"
    )
    mark = _mark(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
        large = both.filter("u < v").join(least, F.col("u") == F.col("at")).select(F.col("m").alias("u"), "v")
        large = large.filter("u < v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("at"), "m")
        small = large.join(low, F.col("v") == F.col("at"))
        small = small.select(F.col("m").alias("u"), F.col("u").alias("v")).union(small.select(F.col("m").alias("u"), "v"))
        edges = store(small.filter("u < v").distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    # Now every node hangs on the least of its component.
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select("u", "u").distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum((F.xxhash64("u", "v") % 1_000_003))).first())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    Fingerprints are made where a text is read; texts never move.  Equal fingerprints become one node,
    named by the least id, before any pair is sought, so copies cost nothing.  Anchors are
    those of a covering code (perfect code of length 15 beside free bits): each node is replicated to all
    anchors within covering radius plus threshold, and nodes are compared per anchor.

    ``component_id`` is the least id reachable over links of at most ``radius`` bits, itself included.  Null, empty
    and wordless texts have fingerprint 0 and are linked like any other.  A null id gets a
    fingerprint and the component of its fingerprint, if a row with an id has it, else null.
    Repeated rows give repeated equal results; an empty table gives an empty table.  Ids are integers.
    """
    rows = without(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")), id_col)
    prints = store(rows.select(F.col("_id").alias(id_col), fingerprints(F.col("_text")).alias("fingerprint")), "prints")
    nodes = store(
        prints.filter(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).alias("node")), "nodes"
    )
    found = components(links(nodes, radius))
    named = nodes.join(found, "node", "left").select(
        F.col("fingerprint").alias("_f"), F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(named, F.col("fingerprint") == F.col("_f"), "left").select(id_col, "fingerprint", "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose id is the least of its near-duplicates; columns stay as they are.

    Ids of representatives find their rows again by a join on ids; what meets texts is (id, fingerprint) rows.  Ids
    that occur in several rows are rare and keep one row each, the first by text and fingerprint.  A row
    with a null id stays unless its fingerprint is that of a row with an id; of several such rows with
    equal texts one stays.
    """
    found = near_duplicates(docs, id_col, text_col, radius).select(F.col(id_col).alias("id"), "fingerprint", "component_id")
    found = store(found, "components")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))  # names inside a struct clash with none
    own, text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    twice = found.groupBy("id").count().filter("count > 1").select("id")
    kept = found.filter("id = component_id").select("id").distinct()
    single = rows.join(kept.join(twice, "id", "left_anti"), own == F.col("id"), "left_semi")
    many = kept.join(twice, "id", "left_semi")
    if many.isEmpty() and found.filter("id IS NULL").isEmpty():
        return single.select("row.*")
    repeated = rows.join(many, own == F.col("id"), "left_semi").groupBy(own.alias("id"))
    repeated = repeated.agg(F.min_by("row", F.xxhash64(text)).alias("row")).select("row")
    taken = store(found.filter("id IS NOT NULL").select(F.col("fingerprint").alias("taken")).distinct(), "taken")
    loose = rows.filter(own.isNull()).withColumn("print", fingerprints(text)).join(taken, F.col("print") == F.col("taken"), "left_anti")
    loose = loose.withColumn("text", text).dropDuplicates(["text"]).select("row")
    return single.union(repeated).union(loose).select("row.*")
