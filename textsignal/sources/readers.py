"""Reading tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from textsignal.sources import schemas


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a table of few splits to all cores before heavy per-row work.

    Large tables have more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(2 * cores, key)


def read_text_csv(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Text corpus with quoted, possibly multi-line fields."""
    schema = schemas.LABELLED if labelled else schemas.UNLABELLED
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_probabilities(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Probability table: arrays from parquet, p0/p1/p2 columns from CSV."""
    if fmt == "parquet":
        table = spark.read.parquet(path)
        return table.select("*", *[F.col("proba")[i].alias(f"p{i}") for i in range(3)])
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType())] + [T.StructField(f"p{i}", T.DoubleType()) for i in range(3)]
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def align_probabilities(probs: DataFrame, gold: DataFrame) -> DataFrame:
    """Attach gold labels by id."""
    return probs.join(gold.select("doc_id", "label"), "doc_id")


def shape_check(probs: DataFrame, gold: DataFrame, n_classes: int = 3) -> DataFrame:
    """One row: row counts of both sides, unmatched ids, rows of a wrong width."""
    width = F.size("proba") if "proba" in probs.columns else F.lit(n_classes)
    left = probs.select("doc_id", F.lit(1).alias("in_probs"), (width != n_classes).cast("int").alias("bad"))
    right = gold.select("doc_id", F.lit(1).alias("in_gold"))
    both = left.join(right, "doc_id", "full_outer")
    return both.agg(
        F.count("in_probs").alias("n_probs"),
        F.count("in_gold").alias("n_gold"),
        F.count_if(F.col("in_probs").isNull() | F.col("in_gold").isNull()).alias("unmatched"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_width"),
    )


def read_run_records(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Run records of a folder; broken ones are dropped, missing keys get defaults."""
    raw = (
        spark.read.schema(schemas.RUN_RECORD)
        .option("multiLine", not one_per_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
        .withColumn("stem", F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", ""))
    )
    good = raw.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    text_or = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    score = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0.0))
    return good.select(
        F.coalesce("tag", "stem").alias("tag"),
        text_or(F.col("model_id")).alias("model_id"),
        score("F1-macro").alias("f1_macro"),
        score("F1-weighted").alias("f1_weighted"),
        score("Accuracy").alias("accuracy"),
        text_or(F.col("recipe.epochs")).alias("epochs"),
        text_or(F.col("recipe.lr")).alias("lr"),
        text_or(F.col("recipe.label_smoothing")).alias("label_smoothing"),
        text_or(F.col("recipe.schedule")).alias("schedule"),
        "per_fold_f1",
        "test_dist",
        "stem",
    )
