"""Stored models: a fitted pipeline with the fold, parameters and columns it was fitted with."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession, functions as F

from textsignal.session import scratch_path

CARD = "name string, fold int, path string, params string, inputs array<string>"


def save_models(spark: SparkSession, models: dict[int, Transformer], name: str, params: dict, inputs: list[str], folder: str | None = None) -> str:
    """Stores one fitted model per fold and a table of what they are; returns the folder.

    The table is written last: a folder with a table has all its models.
    """
    folder = folder or scratch_path(spark, f"models-{name}")
    cards = []
    for fold, model in models.items():
        whole = model if isinstance(model, PipelineModel) else PipelineModel([model])
        path = f"{folder}/fold={fold}"
        whole.write().overwrite().save(path)
        cards.append((name, fold, path, json.dumps(params, sort_keys=True), inputs))
    spark.createDataFrame(cards, CARD).coalesce(1).write.mode("overwrite").parquet(f"{folder}/cards")
    return folder


def model_cards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/cards")


def load_models(spark: SparkSession, folder: str) -> dict[int, PipelineModel]:
    return {r.fold: PipelineModel.load(r.path) for r in model_cards(spark, folder).collect()}  # a row per fold


def predict_by_fold(models: dict[int, Transformer], rows: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Every row scored by the model that was fitted without its fold."""
    parts = [model.transform(rows.filter(F.col(fold_col) == fold)) for fold, model in sorted(models.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
