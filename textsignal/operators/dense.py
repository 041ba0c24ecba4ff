"""Dense document vectors: training, pooling, similarity, PCA, oversampling."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from textsignal.constants import SEED
from textsignal.functions.hashing import digest, uniform
from textsignal.operators.joins import stored_side
from textsignal.operators.knn import knn, unit_vector
from textsignal.operators.neighbour_index import build_index, search_index
from textsignal.operators.split import distributed_rank
from textsignal.operators.term_rows import TermRows, term_counts


def mean_pool(df: DataFrame, vectors: DataFrame, dim: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Mean word vector per text; a text without a known word gets zeros.

    Tokens are counted inside their text before they meet the vectors, and the mean is a
    weighted, partially aggregated summary.
    """
    texts = df.select(id_col, F.col(text_col).alias("text"))
    counts = term_counts(TermRows(texts, "word", id_col)).select(id_col, F.col("term").alias("word"), F.col("tf").cast("double").alias("n"))
    hits = counts.join(stored_side(vectors), "word").select(
        id_col, "n", array_to_vector(F.col("vector").cast("array<double>")).alias("v")
    )
    pooled = hits.groupBy(id_col).agg(vector_to_array(Summarizer.mean(F.col("v"), F.col("n"))).alias("vector"))
    zeros = F.array_repeat(F.lit(0.0), dim)
    ids = df.select(id_col)
    return ids.join(pooled, id_col, "left").select(id_col, F.coalesce("vector", zeros).alias("vector"))


def most_similar(vectors: DataFrame, terms: list, n: int, id_col: str = "word", vec_col: str = "vector") -> DataFrame:
    """The ``n`` nearest rows of each listed term, itself excluded."""
    return knn(vectors.filter(F.col(id_col).isin(terms)), vectors, n, id_col, vec_col)


def analogy(
    vectors: DataFrame, positive: list, negative: list, n: int, id_col: str = "word", vec_col: str = "vector"
) -> DataFrame:
    """Rows nearest to the signed sum of unit vectors; the query terms are excluded."""
    asked = positive + negative
    sign = F.when(F.col(id_col).isin(negative), -1.0).otherwise(1.0)
    unit = vectors.filter(F.col(id_col).isin(asked)).select(
        sign.alias("s"), F.posexplode(unit_vector(F.col(vec_col))).alias("i", "x")
    )
    # one value per dimension
    summed = unit.groupBy("i").agg(F.sum(F.col("s") * F.col("x")).alias("x"))
    target = summed.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias(vec_col))
    id_type = vectors.schema[id_col].dataType
    query = target.withColumn(id_col, F.lit(None).cast(id_type)).withColumn("_q", F.lit(-1))
    base = vectors.filter(~F.col(id_col).isin(asked)).withColumn("_q", F.lit(0))
    return knn(query, base, n, id_col, vec_col, ban="_q").drop(id_col)


def hashing_encoder(dim: int = 64) -> Callable[[pd.Series], np.ndarray]:
    """Default batch encoder: signed feature hashing of words, stable across runs."""

    def encode(texts: pd.Series) -> np.ndarray:
        out = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            toks = text.lower().split()
            if toks:
                h = pd.util.hash_array(np.array(toks, dtype=object))
                np.add.at(out[row], (h % dim).astype(int), np.where((h >> 32) & 1, 1.0, -1.0))
        return out

    return encode


def embed(
    df: DataFrame,
    encoder: Callable[[pd.Series], np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: bool = True,
) -> DataFrame:
    """``(id, vector)`` from a batch encoder; one Arrow batch is one encoder batch."""
    schema = T.StructType(
        [df.schema[id_col], T.StructField("vector", T.ArrayType(T.DoubleType()))]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({id_col: pdf[id_col], "vector": list(encoder(pdf[text_col].fillna("")))})

    out = df.select(id_col, text_col).mapInPandas(run, schema)
    return out.withColumn("vector", unit_vector(F.col("vector"))) if normalise else out


def pca_2d(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """``(id, x, y)`` and a one-row table of explained-variance shares.

    The sign of an axis is fixed so that its largest loading is positive.
    """
    vec = df.select(id_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("raw"))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="raw", outputCol="v").fit(vec).transform(vec)
    model = PCA(k=2, inputCol="v", outputCol="c").fit(centred)
    load = model.pc.toArray()
    sign = np.sign(load[np.abs(load).argmax(axis=0), range(2)])
    c = vector_to_array("c")
    points = model.transform(centred).select(
        id_col, (c[0] * float(sign[0])).alias("x"), (c[1] * float(sign[1])).alias("y")
    )
    share = [float(v) for v in model.explainedVariance.toArray()]
    return points, df.sparkSession.createDataFrame([(share[0], share[1])], "share_x double, share_y double")


def _indexed_near(seeds: DataFrame, base: DataFrame, id_col: str, label_col: str, vec_col: str, k: int) -> DataFrame:
    """Neighbours within the class from one index per class."""
    parts = []
    for row in base.select(label_col).distinct().collect():  # a row per class
        same = F.col(label_col).eqNullSafe(F.lit(row[0]))
        parts.append(search_index(build_index(base.filter(same), k, id_col, vec_col), seeds.filter(same), id_col, vec_col))
    return reduce(DataFrame.unionByName, parts) if parts else knn(seeds, base, k, id_col, vec_col)


def smote(
    df: DataFrame, id_col: str, label_col: str, vec_col: str, k: int = 5, seed: int = SEED, indexed: bool = False
) -> DataFrame:
    """``(id, copy, label, vector)``: new rows between a row and one of its ``k``
    nearest rows of the same class, until all classes are as large as the largest.

    How many copies a row gives follows from its rank in its class; neighbour and
    gap come from digests, so the same rows are made on every run.  ``indexed`` finds the neighbours by the index of
    random planes, for classes too large for the exact search.
    """
    everyone = Window.partitionBy(F.lit(0))  # one row per class
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    need = counts.withColumn("_need", F.max("_n").over(everyone) - F.col("_n"))
    small = df.join(F.broadcast(need.filter("_need > 0")), label_col)
    ranked = distributed_rank(small, [label_col], digest(seed, "smote", F.col(id_col)), [id_col], "_rank")
    extra = (F.col("_rank") <= F.col("_need") % F.col("_n")).cast("long")
    copies = F.floor(F.col("_need") / F.col("_n")) + extra
    seeds = ranked.withColumn("_copies", copies).filter("_copies > 0")
    jobs = seeds.select(
        id_col, label_col, F.col(vec_col).alias("_a"), F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy")
    )
    jobs = jobs.withColumn("rank", F.floor(uniform(seed, "nn", F.col(id_col), F.col("copy")) * k).cast("int") + 1)
    near = _indexed_near(seeds, small, id_col, label_col, vec_col, k) if indexed else knn(seeds, small, k, id_col, vec_col, within=label_col)
    near = near.select(id_col, "neighbour", "rank")
    # a class with fewer than k + 1 rows has fewer neighbours: wrap around
    found = near.groupBy(id_col).agg(F.max("rank").alias("_k"))
    jobs = jobs.join(found, id_col).withColumn("rank", (F.col("rank") - 1) % F.col("_k") + 1).drop("_k")
    partner = small.select(F.col(id_col).alias("neighbour"), F.col(vec_col).alias("_b"))
    gap = uniform(seed, "gap", F.col(id_col), F.col("copy"))
    between = F.zip_with("_a", "_b", lambda a, b: a + F.col("_g") * (b - a))
    return (
        jobs.join(near, [id_col, "rank"])
        .join(partner, "neighbour")
        .withColumn("_g", gap)
        .select(id_col, "copy", label_col, "neighbour", between.alias("vector"))
    )
