"""SimHash fingerprints and Hamming search by permuted block tables, in DataFrame operations only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F



BITS = 64
_TWO_LANES = (1 << 32) | 1  # counts bit j in the low and bit j + 32 in the high half of a long


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def simhash(df: DataFrame, keys: list[str], text: Column, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per ``keys`` with ``fingerprint`` (long) and the columns of ``keep``.

    Terms are a word with its follower; each occurrence votes with the term's length on
    every bit of the term's hash, for set bits plus, else minus.  A bit is set if plus prevails.

    Two bits are counted in each long, so 32 sums serve all 64 bits; texts of up to 2**31
    characters fit.  Partial sums are made where a text is read, so what moves is one row of
    counts per text.  Null and empty texts give 0.  Rows that agree in ``keys`` must have
    equal texts; they give one row, with ``copies``, their number.
    """
    listed = df.select(*keys, words(text).alias("_w"), *[c.alias(n) for n, c in (keep or {}).items()])
    follower = F.slice("_w", F.lit(2), F.greatest(F.size("_w"), F.lit(1)))
    terms = listed.select(
        *keys, *(keep or {}), F.posexplode_outer(F.arrays_zip(F.col("_w").alias("a"), follower.alias("b"))).alias("_i", "_t")
    )
    a, b = F.col("_t")["a"], F.col("_t")["b"]
    weight = F.coalesce(F.length(a), F.lit(0)) + F.coalesce(F.length(b), F.lit(0))
    terms = terms.select(
        *keys,
        *(keep or {}),
        F.xxhash64(a, b).alias("_h"),
        weight.cast("long").alias("_n"),
        F.when(F.coalesce(F.col("_i"), F.lit(0)) == 0, 1).otherwise(0).alias("_first"),
    )
    votes = [
        F.sum(F.shiftrightunsigned("_h", j).bitwiseAND(F.lit(_TWO_LANES)) * F.col("_n")).alias(f"_v{j}") for j in range(32)
    ]
    total = terms.groupBy(*keys).agg(
        *votes,
        F.sum("_n").alias("_n"),
        F.sum("_first").cast("int").alias("copies"),
        *[F.first(n).alias(n) for n in keep or {}],
    )
    low = F.lit((1 << 32) - 1)

    def bit(j: int) -> Column:
        count = F.col(f"_v{j}").bitwiseAND(low) if j < 32 else F.shiftrightunsigned(f"_v{j - 32}", 32)
        mask = 1 << j if j < 63 else -(1 << 63)
        return F.when(2 * count > F.col("_n"), F.lit(mask)).otherwise(F.lit(0).cast("long"))

    fingerprint = reduce(lambda x, y: x.bitwiseOR(y), [bit(j) for j in range(BITS)])
    return total.select(*keys, fingerprint.alias("fingerprint"), "copies", *(keep or {}))


def hex16(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Cosine that the number of differing bits stands for, 0 where it is negative."""
    angle = distance(a, b) * F.lit(3.141592653589793 / BITS)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.cos(angle), F.lit(0.0)))


def block_tables(radius: int, blocks: int) -> list[int]:
    """Masks of the tables: every choice of ``blocks - radius`` of the blocks leads the key.

    At most ``radius`` blocks hold a difference, so fingerprints within the radius agree on
    the leading blocks of one table at least.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def within_radius(queries: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(query, found, distance): all fingerprints of ``table`` within ``radius`` of each query.

    Both inputs have a long column ``fingerprint`` and are reduced to distinct values first, so copies
    never meet as pairs.  A pair is kept in the first table that holds it, so nothing is found
    twice and no pass over the pairs is needed.  More ``blocks`` mean longer keys and more
    tables: 6 give 32-bit keys in 20 tables at radius 3.  Null fingerprints find nothing.
    """
    masks = [F.lit(signed(m)) for m in block_tables(radius, blocks)]

    def keyed(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct()
        rows = F.posexplode(F.array(*[F.col(name).bitwiseAND(m) for m in masks]))
        return distinct.select(name, rows.alias("table", "key"))

    differ = F.col("query").bitwiseXOR(F.col("found"))
    pairs = keyed(queries, "query").join(keyed(table, "found"), ["table", "key"]).filter(F.bit_count(differ) <= radius)
    holds = F.array_position(F.array(*[(differ.bitwiseAND(m) == 0) for m in masks]), True) - 1
    return pairs.filter(holds == F.col("table")).select("query", "found", F.bit_count(differ).alias("distance"))


def successors(ids: DataFrame, col: str) -> DataFrame:
    """(``col``, next_id): the next greater value, after the greatest the least; nulls have none.

    Values that agree but for their low bits form small ranges: at most 1024 values or
    ranges meet in a window, on the topmost level 2**20, so no task sees all ids.
    """
    base = ids.select(F.col(col).cast("long").alias("first")).filter("first IS NOT NULL").distinct()
    levels = [base]
    for bits in (10, 20, 40):
        levels.append(levels[-1].groupBy(F.shiftright("first", bits).alias("range")).agg(F.min("first").alias("first")).select("first"))
    top = Window.partitionBy(F.lit(0)).orderBy("first")
    after = levels[3].select(
        F.shiftright("first", 40).alias("range"),
        F.coalesce(F.lead("first").over(top), F.min("first").over(Window.partitionBy(F.lit(0)))).alias("after"),
    )
    for level, bits in ((2, 40), (1, 20), (0, 10)):
        ranged = levels[level].withColumn("range", F.shiftright("first", bits))
        inside = ranged.withColumn("next", F.lead("first").over(Window.partitionBy("range").orderBy("first")))
        found = inside.join(after, "range").select("first", F.coalesce("next", "after").alias("next"))
        if level:
            after = found.select(F.shiftright("first", 20 if level == 2 else 10).alias("range"), F.col("next").alias("after"))
    return found.select(F.col("first").alias(col), F.col("next").alias("next_id"))


def edited_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, text_key, edited): the last quarter of a text replaced by the start of the next document.

    ``places`` has doc_id, text_key, quarter, next_id and next_key for every id that is not null.  Whole texts move once,
    placed by doc_id for both joins; of the next document only the part that is used moves.  A
    row with a null id keeps its text.
    """
    every = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = every.filter("doc_id IS NOT NULL")  # the same on both sides, so one exchange serves both joins
    wanted = places.groupBy("next_id", "next_key").agg(F.max("quarter").alias("most"), F.first("doc_id").alias("for_id"))
    wanted = wanted.select(F.col("next_id").alias("doc_id"), "next_key", "most", "for_id")
    # Not an equality of the two sides: it would become a join key, and the exchange another one.
    heads = rows.join(wanted, "doc_id").filter(F.xxhash64("text").bitwiseXOR(F.col("next_key")) == 0)
    heads = heads.select(F.col("for_id").alias("doc_id"), F.expr("left(text, most)").alias("head"))
    heads = heads.groupBy("doc_id").agg(F.first("head").alias("head"))
    joined = rows.join(heads, "doc_id")
    kept = F.expr("left(text, cast(length(text) - length(text) div 4 AS int))")
    tail = F.expr("left(head, cast(length(text) div 4 AS int))")
    edited = joined.select("doc_id", F.xxhash64("text").alias("text_key"), F.concat(kept, tail).alias("edited"))
    unplaced = every.filter("doc_id IS NULL").select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").alias("edited"))
    return edited.union(unplaced)
