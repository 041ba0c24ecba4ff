"""Registered queries: sources and sinks, each written and read back."""

from pyspark.sql import functions as F

from textsignal.operators import metrics as m
from textsignal.plans.evaluation import preds, preds_folds, records, rounded, sql_scores, PREDS
from textsignal.plans.registry import query
from textsignal.session import scratch_path
from textsignal.sources import readers, writers


@query("a01_read_csv", "SELECT doc_id, text, label FROM corpus", "corpus")
def a01(t):
    path = scratch_path(t.spark, "corpus-csv")
    rows = t.corpus.select("doc_id", "text", "label")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return readers.read_text_csv(t.spark, path)


@query("a02_align", "SELECT doc_id, label, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2 FROM probs WHERE model = 'a'", "probs")
def a02(t):
    path = scratch_path(t.spark, "probs-csv")
    t.probs.filter("model = 'a'").select("doc_id", "p0", "p1", "p2").write.option("header", True).csv(path)
    table = readers.read_probabilities(t.spark, path, "csv")
    return rounded(readers.align_probabilities(table, t.gold))


@query(
    "a02_shape_check",
    "SELECT count(*) AS n_probs, (SELECT count(*) FROM gold) AS n_gold, CAST(0 AS BIGINT) AS unmatched, CAST(0 AS BIGINT) AS bad_width FROM probs WHERE model = 'a'",
    "probs",
)
def a02b(t):
    table = t.probs.filter("model = 'a'").select("doc_id", F.array("p0", "p1", "p2").alias("proba"))
    return readers.shape_check(table, t.gold)


def _write_records(t, path: str) -> None:
    """One JSON record per model, some keys missing, and one broken file."""
    per_fold = m.score(preds_folds(t), ["model", "fold"]).groupBy("model").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "f1_macro"))), lambda s: s["f1_macro"]).alias("per_fold_f1")
    )
    rows = records(t).withColumnRenamed("tag", "model").join(per_fold, "model")
    recipe = F.when(F.col("model") != "d", F.struct(F.lit(10).alias("epochs"), F.lit("cosine").alias("schedule")))
    rows.select(
        F.col("model").alias("tag"),
        F.col("f1_macro").alias("F1-macro"),
        F.col("f1_weighted").alias("F1-weighted"),
        F.when(F.col("model") != "c", F.col("accuracy")).alias("Accuracy"),
        "per_fold_f1",
        recipe.alias("recipe"),
    ).repartition("tag").write.option("ignoreNullFields", True).json(path)
    broken = t.gold.limit(1).select(F.lit('{"tag": "broken", ').alias("value"))
    broken.write.mode("append").text(path)


@query(
    "a03_run_records",
    f"WITH {sql_scores(PREDS, 'model')} SELECT model AS tag, '?' AS model_id, round(f1_macro, 6) AS f1_macro, round(f1_weighted, 6) AS f1_weighted,"
    " round(CASE WHEN model = 'c' THEN 0 ELSE accuracy END, 6) AS accuracy, CASE WHEN model = 'd' THEN '?' ELSE '10' END AS epochs,"
    " '?' AS lr, CASE WHEN model = 'd' THEN '?' ELSE 'cosine' END AS schedule, 10 AS folds FROM scores",
    "preds",
)
def a03(t):
    path = scratch_path(t.spark, "records")
    _write_records(t, path)
    got = readers.read_run_records(t.spark, path, one_per_line=True)
    return rounded(
        got.select("tag", "model_id", "f1_macro", "f1_weighted", "accuracy", "epochs", "lr", "schedule", F.size("per_fold_f1").alias("folds"))
    )


@query("a04_write_predictions", "SELECT doc_id AS id, pred AS label FROM preds WHERE model = 'a'", "preds")
def a04(t):
    path = scratch_path(t.spark, "predictions")
    writers.write_predictions(preds(t).filter("model = 'a'").select(F.col("doc_id").alias("id"), F.col("pred").alias("label")), path)
    from textsignal.sources.schemas import PREDICTIONS

    return t.spark.read.schema(PREDICTIONS).option("header", True).csv(path)


@query(
    "a05_write_probabilities",
    "SELECT doc_id, model, fold, round(p0, 6) AS p0, round(p1, 6) AS p1, round(p2, 6) AS p2 FROM probs JOIN folds USING (doc_id) WHERE model = 'b' AND fold = 3",
    "probs folds",
)
def a05(t):
    path = scratch_path(t.spark, "probabilities")
    rows = t.probs.join(t.folds.select("doc_id", "fold"), "doc_id")
    writers.write_probabilities(rows.select("doc_id", "model", "fold", F.array("p0", "p1", "p2").alias("proba")), path)
    back = readers.read_probabilities(t.spark, path).filter("model = 'b' and fold = 3")
    return rounded(back.select("doc_id", "model", "fold", "p0", "p1", "p2"))


@query(
    "a06_write_run_record",
    f"WITH {sql_scores(PREDS, 'model')} SELECT model AS tag, round(f1_macro, 6) AS f1_macro, round(accuracy, 6) AS accuracy FROM scores WHERE model = 'a'",
    "preds",
)
def a06(t):
    path = scratch_path(t.spark, "record")
    one = records(t).filter("tag = 'a'").select("tag", F.col("f1_macro").alias("F1-macro"), F.col("accuracy").alias("Accuracy"))
    writers.write_run_record(one, path)
    return rounded(readers.read_run_records(t.spark, path).select("tag", "f1_macro", "accuracy"))


@query("a07_load_or_compute", "SELECT label, count(*) AS n FROM gold GROUP BY label", "gold")
def a07(t):
    path = scratch_path(t.spark, "counts")
    build = lambda: t.gold.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    writers.materialise(t.spark, path, build)

    def never():
        raise AssertionError("a stored table must not be built again")

    return writers.materialise(t.spark, path, never)


@query(
    "a08_append_missing",
    f"WITH {sql_scores(PREDS, 'model')} SELECT model AS tag, CASE WHEN model IN ('a', 'b') THEN 'old' END AS state, round(f1_macro, 6) AS f1_macro FROM scores",
    "preds",
)
def a08(t):
    table = records(t).select("tag", "f1_macro")
    old = table.filter("tag in ('a', 'b')").withColumn("state", F.lit("old"))
    return rounded(writers.append_missing(old, table, "tag"))
