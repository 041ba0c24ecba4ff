"""Batch prediction with a stored artefact: loaded once per Python worker, applied to Arrow batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

BATCH = 4096


@dataclass(frozen=True)
class LinearArtefact:
    """Weights (inputs x outputs) and offsets of a linear model; what ``apply`` does with the sums is by ``kind``.

    ``softmax`` gives class probabilities, ``unit`` a vector of length one (zeros stay), ``plain`` the sums.
    """

    weights: np.ndarray
    offsets: np.ndarray
    kind: str = "plain"

    def apply(self, inputs: np.ndarray) -> np.ndarray:
        sums = inputs @ self.weights + self.offsets
        if self.kind == "softmax":
            grown = np.exp(sums - sums.max(axis=1, keepdims=True))
            return grown / grown.sum(axis=1, keepdims=True)
        if self.kind == "unit":
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            return np.divide(sums, size, out=np.zeros_like(sums), where=size > 0)
        return sums


def artefact_from_table(rows: DataFrame, kind: str) -> LinearArtefact:
    """From a table ``(output, input, weight)``; input -1 is the offset.  A model is as small as one machine's memory."""
    table = rows.toPandas()
    inner = table[table["input"] >= 0]
    weights = inner.pivot(index="input", columns="output", values="weight").fillna(0.0).sort_index()
    offsets = table[table["input"] < 0].set_index("output")["weight"].reindex(weights.columns).fillna(0.0)
    return LinearArtefact(weights.to_numpy(float), offsets.to_numpy(float), kind)


def predict_vectors(
    df: DataFrame, artefact, vec_col: str, out_col: str, dim: int, batch: int = BATCH, keep: list[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default) and ``out_col``: the artefact's output for each row's vector of ``dim`` numbers.

    ``artefact`` is anything with ``apply(inputs) -> outputs`` on two-dimensional arrays.  It is broadcast, so an executor
    gets it once, and each Python worker takes it up once however many batches it scores.  A null vector has a
    null output.
    """
    shipped = df.sparkSession.sparkContext.broadcast(artefact)

    def load() -> Callable[[np.ndarray], np.ndarray]:
        model = shipped.value
        return lambda inputs: model.apply(inputs.astype(float))

    score = predict_batch_udf(load, return_type=T.ArrayType(T.DoubleType()), batch_size=batch, input_tensor_shapes=[[dim]])
    vector = F.col(vec_col).cast("array<double>")
    zeros = F.array_repeat(F.lit(0.0), dim)
    scored = F.when(vector.isNotNull(), score(F.coalesce(vector, zeros)))
    return df.select(*(keep if keep is not None else df.columns), scored.alias(out_col))
