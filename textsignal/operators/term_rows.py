"""Terms of whole texts counted inside their row.

Texts are never exploded into term rows: a batch of texts gives the sums that a vocabulary is made of, or, with
a vocabulary, the known terms of each text as indices and counts, a few bytes a term.  Only these leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from textsignal.operators.joins import stored_side

PIECE = 1 << 24  # bytes of text that are counted at a time; a longer text is one piece
CHAR_PIECE = 1 << 21  # a word has many grams
PARTED = "\ue000"  # stands between the texts of an id that comes more than once
GAPS = r"[^\p{L}\p{N}_]+"  # between tokens
PARTED_GAPS = r"[^\p{L}\p{N}_\x{e000}]+"
SPACES = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"  # between words


@dataclass
class TermRows:
    """``rows`` has ``id_col`` and ``text``, which Arrow's own functions take apart in the task that counts it.

    A text leaves the JVM as one string; lists of tokens would be made and copied token by token.
    """

    rows: DataFrame
    kind: str  # "char": grams of words; "bigram": tokens of two signs and more, and pairs of neighbours; "word": words; else tokens
    id_col: str
    merged: bool = False  # rows of one id were put together, with ``PARTED`` between them


def repeated_ids(rows: DataFrame, id_col: str) -> DataFrame:
    """``_id``: those that come more than once, and null; ids alone are shuffled to find them."""
    found = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) | F.col(id_col).isNull())
    return stored_side(found.select(F.col(id_col).alias("_id")), "repeated-ids")


def one_row_per_id(rows: DataFrame, kind: str, id_col: str) -> TermRows:
    """Texts of an id that repeats, or of none, count as one document."""
    again = repeated_ids(rows, id_col)
    if again.isEmpty():
        return TermRows(rows, kind, id_col)
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    rows = rows.select(id_col, F.translate("text", PARTED, " ").alias("text")) if kind == "bigram" else rows.select(id_col, "text")
    between = f" {PARTED} " if kind == "bigram" else " "
    texts = rows.join(again, same, "left_semi").groupBy(id_col)
    whole = texts.agg(F.array_join(F.collect_list("text"), between).alias("text"))
    return TermRows(rows.join(again, same, "left_anti").unionByName(whole), kind, id_col, True)


# --- counting in batches ---------------------------------------------------------------
def _pieces(batch: pa.RecordBatch, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``PIECE`` bytes of text."""
    most = CHAR_PIECE if kind == "char" else PIECE
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _runs(row: np.ndarray, code: np.ndarray, n: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, sum of n) by row and code; without ``n`` every cell counts once."""
    key = row * max(width, 1) + code
    if n is None:
        key.sort()
    else:
        order = np.argsort(key)
        key, n = key[order], n[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    sums = np.diff(first, append=len(key)) if n is None or not len(first) else np.add.reduceat(n, first)
    return key[first] // max(width, 1), key[first] % max(width, 1), sums


def _char_grams(words: pa.Array, low: int = 3, high: int = 5) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Grams of words padded by one space: how many each word has, their codes word by word, and the grams."""
    text = "".join(f" {word} " for word in words.to_pylist())
    alphabet, sign = np.unique(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), return_inverse=True)
    wide = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    word = np.repeat(np.arange(len(words)), wide)
    room = np.repeat(np.cumsum(wide), wide) - np.arange(len(text))  # signs to the end of the word
    owners, codes, grams, before = [], [], [], sign.astype(np.int64)
    for n in range(2, high + 1):  # a gram is the gram before it and one sign more
        at = np.flatnonzero(room >= n)
        _, first, code = np.unique(before[at] * len(alphabet) + sign[at + n - 1], return_index=True, return_inverse=True)
        before = np.zeros(len(text), dtype=np.int64)
        before[at] = code
        if n >= low:
            owners.append(word[at])
            codes.append(code + len(grams))
            grams.extend([text[i : i + n] for i in at[first].tolist()])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.bincount(owner, minlength=len(words)), np.concatenate(codes)[order], pa.array(grams, pa.string())


def _counted(texts: pa.Array, kind: str, merged: bool, known: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, term, tf) of texts in the order of rows and terms, and the terms that the numbers stand for: ``known``, if given."""
    plain = kind in ("char", "word")
    gaps = SPACES if plain else PARTED_GAPS if merged and kind == "bigram" else GAPS
    lists = pc.split_pattern(pc.replace_substring_regex(texts, gaps, " "), " ")
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    encoded = lists.flatten().dictionary_encode()
    said = encoded.dictionary.cast(pa.string())
    token = pc.utf8_length(said).to_numpy(zero_copy_only=False) >= (1 if plain else 2)
    parted = pc.equal(said, PARTED).to_numpy(zero_copy_only=False) & ~token
    number = np.where(token, np.cumsum(token) - 1, np.where(parted, -1, -2))  # -2: no token
    code = number[encoded.indices.to_numpy(zero_copy_only=False)]
    row, code, terms = row[code > -2], code[code > -2], said.filter(pa.array(token))
    pairs = row[:0], code[:0]
    if kind == "bigram":
        near = (row[1:] == row[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0)
        pair, at = np.unique(code[:-1][near] * max(len(terms), 1) + code[1:][near], return_inverse=True)
        left, right = np.divmod(pair, max(len(terms), 1))
        joined = pc.binary_join_element_wise(terms.take(pa.array(left)), terms.take(pa.array(right)), " ")
        pairs = row[:-1][near], at + len(terms)
        terms = pa.concat_arrays([terms, joined])
    said = code >= 0
    row, code = np.concatenate([row[said], pairs[0]]), np.concatenate([code[said], pairs[1]])
    sizes = None
    if kind == "char":
        sizes, grams, terms = _char_grams(terms)
    if known is not None:
        number = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        terms = known
        if sizes is None:
            code = number[code]
            row, code = row[code >= 0], code[code >= 0]
        else:
            grams = number[grams]
            held = np.concatenate([[0], np.cumsum(grams >= 0)])
            ends = np.cumsum(sizes)
            sizes, grams = held[ends] - held[ends - sizes], grams[grams >= 0]
    if sizes is None:
        return *_runs(row, code, None, len(terms)), terms
    row, code, n = _runs(row, code, None, len(sizes))  # equal words of a text are cut up once
    wide = sizes[code]
    at = np.repeat((np.cumsum(sizes) - sizes)[code] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
    return *_runs(np.repeat(row, wide), grams[at], np.repeat(n, wide), len(terms)), terms


def term_sums(counted: TermRows) -> DataFrame:
    """``(term, df, total)``: in how many documents a term is, and how often."""
    kind, merged = counted.kind, counted.merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch, kind):
                _, term, tf, terms = _counted(piece.column("text"), kind, merged)
                df = np.bincount(term, minlength=len(terms))
                total = np.bincount(term, weights=tf, minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(total)], names=["term", "df", "total"])

    sums = counted.rows.select("text").mapInArrow(run, "term string, df long, total long")
    return sums.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def term_counts(counted: TermRows) -> DataFrame:
    """``(id, term, tf)``, a row for each term of each row; texts stay where they are."""
    kind, merged, id_col = counted.kind, counted.merged, counted.id_col
    schema = T.StructType([counted.rows.schema[id_col]]).add("term", T.StringType()).add("tf", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch, kind):
                row, term, tf, terms = _counted(piece.column("text"), kind, merged)
                columns = [piece.column(id_col).take(pa.array(row)), terms.take(pa.array(term)), pa.array(tf.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "term", "tf"])

    return counted.rows.select(id_col, "text").mapInArrow(run, schema)


def fold_sums(counted: TermRows, k: int) -> DataFrame:
    """``(term, fold, df, total)`` of the rows outside each of ``k`` folds (column ``fold``), from one pass over the texts.

    Every id comes once.  A term's sums outside a fold are those of all folds without the fold's own.
    """
    kind, merged = counted.kind, counted.merged

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch, kind):
                row, term, tf, terms = _counted(piece.column("text"), kind, merged)
                cell = term * k + piece.column("fold").to_numpy()[row]
                df = np.bincount(cell, minlength=len(terms) * k)
                total = np.bincount(cell, weights=tf, minlength=len(terms) * k).astype(np.int64)
                held = np.flatnonzero(df)
                columns = [terms.take(pa.array(held // k)), pa.array(held % k), pa.array(df[held]), pa.array(total[held])]
                yield pa.RecordBatch.from_arrays(columns, names=["term", "fold", "df", "total"])

    cells = counted.rows.select("fold", "text").mapInArrow(run, "term string, fold long, df long, total long")
    own = lambda c, f: F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}")
    sums = cells.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("df", "total")], *[own(c, f) for c in ("df", "total") for f in range(k)])
    rest = lambda c, f: (F.col(c) - F.col(f"{c}{f}")).alias(c)
    folds = F.array(*[F.struct(F.lit(f).alias("fold"), rest("df", f), rest("total", f)) for f in range(k)])
    return sums.select("term", F.inline(folds)).filter("df > 0")


def _lists(row: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def place_type(n_terms: int) -> type:
    return np.uint16 if n_terms <= 1 << 16 else np.uint32


def unpacked(values: list, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers each value of bytes has, and all of them."""
    lengths = np.array([len(v) if v else 0 for v in values], dtype=np.int64)
    return lengths // np.dtype(dtype).itemsize, np.frombuffer(b"".join(v for v in values if v), dtype)


def pack_counts(tf: np.ndarray) -> np.ndarray:
    """A byte for each count; those over 254 follow, four bytes each."""
    many = tf[tf >= 255].astype(np.uint32)
    return np.concatenate([np.minimum(tf, 255).astype(np.uint8), many.view(np.uint8)])


def unpack_counts(values: list, lengths: np.ndarray) -> np.ndarray:
    """Counts of texts whose numbers of cells are ``lengths``."""
    plain = np.array([len(v) if v else 0 for v in values], dtype=np.int64) == lengths
    tf = np.frombuffer(b"".join(v if p else v[:n] for v, n, p in zip(values, lengths, plain) if v), np.uint8)
    if plain.all():
        return tf
    tf = tf.astype(np.int64)
    tf[tf == 255] = np.concatenate([np.frombuffer(bytes(v[n:]), np.uint32) for v, n, p in zip(values, lengths, plain) if not p])
    return tf


def _packed(row: np.ndarray, index: np.ndarray, tf: np.ndarray, n: int, squares: np.ndarray) -> list[pa.Array]:
    """Indices, counts and lengths of ``n`` texts as bytes."""
    ends = np.cumsum(np.bincount(row, minlength=n))
    cut = lambda v, pack=lambda x: x: [pack(v[a:b]).tobytes() for a, b in zip([0, *ends[:-1]], ends)]
    squared = (1 + np.log(tf)) ** 2
    sizes = np.sqrt(np.stack([np.bincount(row, squared * column[index], n) for column in squares.T], axis=1))
    return [pa.array(v, pa.binary()) for v in (cut(index.astype(place_type(len(squares)))), cut(tf, pack_counts), [v.tobytes() for v in sizes])]


def _packed_schema(cells: DataFrame, keep: list[str]) -> T.StructType:
    schema = T.StructType([cells.schema[c] for c in keep])
    return schema.add("indices", T.BinaryType()).add("tf", T.BinaryType()).add("sizes", T.BinaryType())


def known_cells(counted: TermRows, terms: list[str], keep: list[str] | None = None, squares: np.ndarray | None = None) -> DataFrame:
    """``(id, [keep], indices, tf)``: the listed terms of each document by their places in the list.

    With ``squares``, a column of squared idf for each of several models, ``indices``, ``tf`` and ``sizes`` are bytes, which
    cross to Python whole and not number by number; ``sizes`` has a text's length under each model, 0 without a known term.
    """
    kind, merged, columns = counted.kind, counted.merged, [counted.id_col, *(keep or [])]
    schema = T.StructType([counted.rows.schema[c] for c in columns])
    schema = schema.add("indices", T.ArrayType(T.IntegerType())).add("tf", T.ArrayType(T.IntegerType()))
    schema = schema if squares is None else _packed_schema(counted.rows, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            for piece in _pieces(batch, kind):
                row, term, tf, _ = _counted(piece.column("text"), kind, merged, known)
                if squares is None:
                    cells = [_lists(row, len(piece), v.astype(np.int32)) for v in (term, tf)]
                else:
                    cells = _packed(row, term, tf, len(piece), squares)
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in columns], *cells], names=schema.names)

    return counted.rows.select(*columns, "text").mapInArrow(run, schema)


def pack_cells(cells: DataFrame, keep: list[str], squares: np.ndarray) -> DataFrame:
    """Cells of ``known_cells`` as it packs them."""
    schema = _packed_schema(cells, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *_packed(*_cells(part), len(part), squares)], names=schema.names)

    return cells.select(*keep, "indices", "tf").mapInArrow(run, schema)


# --- weights ---------------------------------------------------------------------------
def _cells(batch: pa.RecordBatch, n_terms: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, tf) of a batch of ``known_cells``, packed or not; a null list has none."""
    if pa.types.is_binary(batch.column("indices").type):
        lengths, index = unpacked(batch.column("indices").to_pylist(), place_type(n_terms))
        return np.repeat(np.arange(len(batch)), lengths), index, unpack_counts(batch.column("tf").to_pylist(), lengths).astype(np.int64)
    lengths = pc.fill_null(pc.list_value_length(batch.column("indices")), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(batch), dtype=np.int64), lengths)
    return row, batch.column("indices").flatten().to_numpy(), batch.column("tf").flatten().to_numpy()


def _weights(row: np.ndarray, index: np.ndarray, tf: np.ndarray, idf: np.ndarray, n: int, sublinear: bool) -> np.ndarray:
    """TF-IDF with unit L2 norm per row."""
    w = (1 + np.log(tf) if sublinear else tf) * idf[index]
    return w / np.sqrt(np.bincount(row, weights=w * w, minlength=n))[row]


def weight_rows(cells: DataFrame, terms: list[str], idf: np.ndarray, id_col: str, sublinear: bool = True) -> DataFrame:
    """``(id, term, weight)``, one row a cell."""
    schema = T.StructType([cells.schema[id_col], T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                row, index, tf = _cells(part)
                weight = _weights(row, index, tf, idf, len(part), sublinear)
                columns = [part.column(id_col).take(pa.array(row)), known.take(pa.array(index)), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "term", "weight"])

    return cells.select(id_col, "indices", "tf").mapInArrow(run, schema)


def weight_vectors(
    cells: DataFrame, idf: np.ndarray, size: int, keep: list[str], sublinear: bool = True, places: np.ndarray | None = None
) -> DataFrame:
    """``(keep, features)`` with MLlib's sparse vectors; rows without a known term get a vector of zeros.

    ``places`` maps an index of ``cells`` to that of ``idf``, -1 if it has none, and keeps the order.
    """
    schema = T.StructType([cells.schema[c] for c in keep]).add("features", VectorUDT())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, (row, index, tf) = len(batch), _cells(batch, 0 if places is None else len(places))
            if places is not None:
                held = places[index] >= 0
                row, index, tf = row[held], places[index[held]], tf[held]
            values = _weights(row, index, tf, idf, n, sublinear)
            fields = [pa.array(np.zeros(n, dtype=np.int8)), pa.array(np.full(n, size, dtype=np.int32)), _lists(row, n, index), _lists(row, n, values)]
            vector = pa.StructArray.from_arrays(fields, names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], vector], names=[*keep, "features"])

    return cells.select(*keep, "indices", "tf").mapInArrow(run, schema)
