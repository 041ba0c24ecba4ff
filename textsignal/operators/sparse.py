"""Sparse text vectors as long tables ``(doc_id, term, tf, weight)``.

A fitted model is a table ``(term, df, total, idf)``; it never holds more rows
than ``max_features``, which is what makes broadcasting it safe.
"""

from __future__ import annotations

from copy import copy
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from textsignal.functions.clean import each
from textsignal.operators.joins import place_by
from textsignal.operators.split import head_per_group, top_per_group
from textsignal.operators.term_rows import (
    TermRows, fold_sums, known_cells, one_row_per_id, pack_cells, repeated_ids, term_sums, weight_rows, weight_vectors,
)
from textsignal.session import drop_stored, scratch_path

# --- fixed values: token patterns ---------------------------------------------------
WORD_TOKEN = r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_]{2,}"
ALPHA_TOKEN = r"(?<![\p{L}\p{N}_])[a-zA-Z][a-zA-Z]+(?![\p{L}\p{N}_])"


# --- fixed values: vectoriser presets -------------------------------------------------
PRESETS = {
    "unigram": dict(max_features=20000, min_df=2, max_df=0.8),
    "bigram": dict(max_features=50000, min_df=2, max_df=0.8),
    "char": dict(max_features=30000),
    "ablation": dict(max_features=10000),
    "binary": dict(max_features=20000, min_df=2, binary=True),
}


def word_tokens(text: Column, pattern: str = WORD_TOKEN) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def with_bigrams(tokens: Column) -> Column:
    """Unigrams followed by space-joined bigrams; ``tokens`` should be a column."""
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(tokens, F.lit(1), n), F.slice(tokens, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(tokens, pairs)


def char_gram_rows(counted: DataFrame, keep: list[str], low: int = 3, high: int = 5) -> DataFrame:
    """``(keep, term)``: grams of ``word`` padded by one space on both sides.

    One row per start position, then one per length that still fits; both steps
    are generated code.
    """
    padded = counted.select(*keep, F.concat(F.lit(" "), "word", F.lit(" ")).alias("_w"))
    starts = F.explode(F.sequence(F.lit(1), F.length("_w") - low + 1))
    rows = padded.select(*keep, "_w", starts.alias("_i"))
    room = F.length("_w") - F.col("_i") + 1
    pieces = F.array(*[F.when(room >= n, F.substr("_w", "_i", F.lit(n))) for n in range(low, high + 1)])
    return rows.select(*keep, F.explode(pieces).alias("term")).filter(F.col("term").isNotNull())


def word_term_counts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bigrams: bool = False,
    pattern: str = WORD_TOKEN,
    stop_words: list[str] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``(id, [keep], term, tf)``.

    Texts are placed by id once, before they are exploded; counting per document
    and the later row norm then need no shuffle of tokens.
    """
    keep = keep or []
    placed = place_by(df.select(id_col, *keep, F.col(text_col)), id_col)
    toks = placed.select(id_col, *keep, word_tokens(F.col(text_col), pattern).alias("_t"))
    if stop_words:
        toks = toks.withColumn("_t", F.filter("_t", lambda t: ~t.isin(stop_words)))
    if bigrams:
        toks = toks.withColumn("_t", with_bigrams(F.col("_t")))
    exploded = each(toks, F.col("_t"), "term", id_col, *keep)
    return exploded.groupBy(id_col, *keep, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_rows(df: DataFrame, kind: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> TermRows:
    """Texts as a published vectoriser reads them, one row an id."""
    return one_row_per_id(df.select(id_col, *(keep or []), F.lower(text_col).alias("text")), kind, id_col)


def fit_vocabulary(
    sums: DataFrame,
    n_docs: DataFrame,
    max_features: int,
    min_df: int = 1,
    max_df: float = 1.0,
    binary: bool = False,
) -> DataFrame:
    """``(term, df, total, idf)`` from the terms' sums: document-frequency limits, then the most frequent
    terms of the corpus, ties by term.  ``n_docs`` is a one-row table of the corpus size."""
    per_term = sums.select("term", "df", F.col("df" if binary else "total").alias("total"))
    sized = per_term.withColumn("_n", n_docs.scalar())
    kept = sized.filter((F.col("df") >= min_df) & (F.col("df") <= F.col("_n") * F.lit(float(max_df))))
    top = most_frequent(kept, max_features)
    idf = F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1
    return top.select("term", "df", "total", idf.alias("idf"))


def most_frequent(terms: DataFrame, n: int, salts: int = 64) -> DataFrame:
    """The ``n`` greatest by total, ties by term.

    Each salt keeps its own head first, so whatever the number of partitions the last sort
    sees ``salts * n`` rows at most.
    """
    salt = F.pmod(F.xxhash64("term"), F.lit(salts))
    order = [F.desc("total"), F.col("term")]
    head = terms.withColumn("_r", F.row_number().over(Window.partitionBy(salt).orderBy(*order))).filter(F.col("_r") <= n)
    return head.drop("_r").orderBy(*order).limit(n)


def corpus_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def numbered(vocabulary: DataFrame) -> tuple[list[str], np.ndarray]:
    """Terms in alphabetical order and their idf; ``max_features`` at most, so the driver can hold them."""
    rows = vocabulary.select("term", "idf").orderBy("term").collect()
    return [r["term"] for r in rows], np.array([r["idf"] for r in rows], dtype=np.float64)


def bag_of_words(counted: TermRows, vocabulary: DataFrame) -> DataFrame:
    """Binary presence of the vocabulary terms."""
    terms, idf = numbered(vocabulary)
    found = weight_rows(known_cells(counted, terms), terms, idf, counted.id_col)
    return found.select(counted.id_col, "term", F.lit(1).alias("present"))


def tfidf(counted: TermRows, vocabulary: DataFrame, sublinear: bool = True) -> DataFrame:
    """``(id, term, weight)`` with unit L2 norm per row; unseen terms are dropped."""
    terms, idf = numbered(vocabulary)
    return weight_rows(known_cells(counted, terms), terms, idf, counted.id_col, sublinear)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Term counts are read by the vocabulary, by the weights and by the corpus size: written once, read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fit_tfidf(df: DataFrame, kind: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[TermRows, DataFrame]:
    """``(rows, vocabulary)`` with the presets of the four published vectorisers."""
    counted = term_rows(df, kind, id_col, text_col)
    return counted, fit_vocabulary(term_sums(counted), corpus_size(df), **PRESETS[kind])


def top_terms_per_class(
    df: DataFrame,
    stop_words: list[str],
    k: int = 12,
    max_features: int = 3000,
    max_df: float = 0.8,
    id_col: str = "doc_id",
    label_col: str = "label",
    text_col: str = "text",
) -> DataFrame:
    """``(label, rank, term, score)``: summed TF-IDF with a vocabulary fitted per class."""
    counts = word_term_counts(
        df, id_col, text_col, bigrams=True, pattern=ALPHA_TOKEN, stop_words=stop_words, keep=[label_col]
    )
    counts = stored(counts, "counts-per-class")
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    per_term = counts.groupBy(label_col, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    kept = per_term.join(F.broadcast(sizes), label_col).filter(F.col("df") <= F.col("_n") * max_df)
    vocab = top_per_group(kept, [label_col], [F.desc("total"), "term"], max_features, ["term"])
    vocab = vocab.select(label_col, "term", (F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1).alias("idf"))
    # classes * max_features rows at most
    raw = counts.join(F.broadcast(vocab), [label_col, "term"]).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    scores = (
        raw.withColumn("_u", F.col("_w") / norm).groupBy(label_col, "term").agg(F.round(F.sum("_u"), 6).alias("score"))
    )
    ranked = Window.partitionBy(label_col).orderBy(F.desc("score"), "term")
    top = head_per_group(scores, [label_col], [F.desc("score"), "term"], k)
    return top.select(label_col, F.row_number().over(ranked).alias("rank"), "term", "score")


def top_words_per_class(df: DataFrame, k: int = 80, label_col: str = "label", text_col: str = "text") -> DataFrame:
    """``(label, word, n)``: the most frequent words of each class."""
    word = F.explode(word_tokens(F.col(text_col)))
    counts = df.select(label_col, word.alias("word")).groupBy(label_col, "word").agg(F.count(F.lit(1)).alias("n"))
    return head_per_group(counts, [label_col], [F.desc("n"), "word"], k)


def tfidf_vectors(
    rows: DataFrame, vocabulary: tuple[list[str], np.ndarray], kind: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``(id, [keep], features)``: TF-IDF as MLlib's sparse vectors over the ``numbered`` vocabulary of a preset.

    Indices and counts are stored, a few bytes a term; weights are made whenever the rows are read.  Rows without a
    known term get a vector of zeros.
    """
    keep, (terms, idf) = [id_col, *(keep or [])], vocabulary
    cells = text_cells(rows, terms, kind, id_col, text_col, keep[1:])
    return weight_vectors(stored(cells, f"cells-{kind}"), idf, PRESETS[kind]["max_features"], keep)


def text_cells(rows: DataFrame, terms: list[str], kind: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``known_cells`` of every row; rows of one id have those of all its texts."""
    counted = term_rows(rows, kind, id_col, text_col, keep)
    if counted.merged:
        return rows.select(id_col, *(keep or [])).join(known_cells(counted, terms), id_col, "left")
    return known_cells(counted, terms, keep)


class FoldVectors:
    """TF-IDF vectors of ``doc_id, label, fold, text`` with a vocabulary per fold, fitted on the other folds' rows.

    Texts are read twice, however many folds there are: once for every fold's sums, once for the terms that any fold
    knows, stored as indices and counts.  Texts of an id that repeats count as one document of a fold's training or test
    rows; only these few are fitted and counted again for each fold.  The driver holds ``k * max_features`` terms at most.

    ``cells`` has a row for each use of a text: ``use`` below ``k`` trains every fold's model but its own's, ``k + f``
    only that of fold ``f``, and -1 none; ``test`` says whether the model of ``fold`` scores it.
    """

    def __init__(self, rows: DataFrame, kind: str, k: int):
        self.kind, self.k, self.keep, preset = kind, k, ["doc_id", "label", "fold"], PRESETS[kind]
        self.sizes = [(r["fold"], r["label"], r["n"]) for r in rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()]
        again = repeated_ids(rows, "doc_id")
        self.repeated = None
        if not again.isEmpty():
            same = F.col("doc_id").eqNullSafe(F.col("_id"))
            self.repeated = stored(rows.select(*self.keep, "text").join(again, same, "left_semi"), f"repeated-{kind}")
            rows = rows.join(again, same, "left_anti")
        counted = TermRows(rows.select(*self.keep, F.lower("text").alias("text")), kind, "doc_id")
        self.vocabularies = self._fitted(fold_sums(counted, k), k, **preset)
        self.terms = sorted(set().union(*[terms for terms, _ in self.vocabularies]))
        number = {t: i for i, t in enumerate(self.terms)}
        self.places = [np.array([number[t] for t in terms], dtype=np.int64) for terms, _ in self.vocabularies]
        squares = np.zeros((len(self.terms), k))
        for f, (_, idf) in enumerate(self.vocabularies):
            squares[self.places[f], f] = idf**2
        both = lambda df, use, test: df.withColumns({"use": use, "test": F.lit(test)})
        cells = both(known_cells(counted, self.terms, self.keep[1:], squares), F.col("fold").cast("int"), True)
        for f in range(k) if self.repeated is not None else []:
            for test, use in ((False, k + f), (True, -1)):
                side = self.repeated.filter(F.col("fold") == f if test else F.col("fold") != f)
                made = pack_cells(text_cells(side, self.terms, kind, keep=self.keep[1:]), self.keep, squares)
                cells = cells.unionByName(both(made, F.lit(use), test))
        self.cells = stored(cells, f"cells-{kind}")
        self.dense = None

    def beside(self, more: DataFrame, moments: list[tuple[np.ndarray, np.ndarray]]) -> FoldVectors:
        """The same texts with the array ``more`` of ``(doc_id, fold, more)`` behind their terms, a row for each pair of equal ids.

        ``moments`` are each fold's means and spreads; a spread of 0 makes a number 0.
        """
        found = copy(self)
        more = more.select(F.col("doc_id").alias("_id"), F.col("fold").alias("_fold"), "more")
        side = F.when(F.col("use") >= self.k, F.col("_fold") != F.col("use") - self.k).otherwise(F.col("_fold") == F.col("fold"))
        found.cells = stored(self.cells.join(more, (F.col("doc_id") == F.col("_id")) & side).drop("_id", "_fold"), f"beside-{self.kind}")
        found.dense = moments
        return found

    def weights(self, fold: int) -> dict[int, float]:
        """Weight n / (k * count) of each class of the fold's training rows."""
        n, sizes = self.n_train(fold), {}
        for f, label, m in self.sizes:
            if f != fold:
                sizes[label] = sizes.get(label, 0) + m
        return {label: n / (len(sizes) * m) for label, m in sizes.items()}

    def drop(self) -> None:
        """Removes what is stored here, once no model is fitted on it any more."""
        for table in (self.cells, self.repeated):
            if table is not None:
                drop_stored(table)

    def n_train(self, fold: int) -> int:
        return sum(n for f, _, n in self.sizes if f != fold)

    def _fitted(self, sums: DataFrame, k: int, max_features: int, min_df: int = 1, max_df: float = 1.0) -> list[tuple[list[str], np.ndarray]]:
        """Terms in alphabetical order and their idf, per fold, as ``fit_vocabulary`` finds them in the training rows."""
        if self.repeated is not None:
            parts = [term_sums(term_rows(self.repeated.filter(F.col("fold") != f), self.kind)).select("term", F.lit(f).alias("fold"), "df", "total") for f in range(k)]
            sums = reduce(DataFrame.unionByName, parts, sums).groupBy("term", "fold").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        n = F.element_at(F.array(*[F.lit(self.n_train(f)).cast("long") for f in range(k)]), F.col("fold") + 1)
        kept = sums.filter((F.col("df") >= min_df) & (F.col("df") <= n * F.lit(float(max_df))))
        top = top_per_group(kept, ["fold"], [F.desc("total"), "term"], max_features, ["term"])
        found = top.select("fold", "term", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf")).collect()
        fitted = []
        for f in range(k):
            idf = {r["term"]: r["idf"] for r in found if r["fold"] == f}
            terms = sorted(idf)
            fitted.append((terms, np.array([idf[t] for t in terms], dtype=np.float64)))
        return fitted

    def vectors(self, fold: int, train: bool) -> DataFrame:
        """``(doc_id, label, fold, features)`` of the rows outside the fold, or of those inside."""
        terms, idf = self.vocabularies[fold]
        places = np.full(len(self.terms), -1, dtype=np.int32)
        places[self.places[fold]] = np.arange(len(terms))
        side = F.col("fold") != fold if train else F.col("fold") == fold
        cells = self.cells.filter(side & F.col("use").between(0, self.k - 1))
        made = weight_vectors(cells, idf, PRESETS[self.kind]["max_features"], self.keep, places=places)
        if self.repeated is not None:
            made = made.unionByName(tfidf_vectors(self.repeated.filter(side), (terms, idf), self.kind, keep=self.keep[1:]))
        return made
