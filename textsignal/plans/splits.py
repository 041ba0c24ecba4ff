"""Registered queries: folds, samples and weights."""

from pyspark.sql import DataFrame, functions as F

from textsignal.operators import metrics as m
from textsignal.operators import split as sp
from textsignal.plans.evaluation import FOLD_PREDS, preds_folds, rounded, sql_scores
from textsignal.plans.registry import query
from textsignal.plans.views import sql_uniform


@query("f01_folds", "SELECT doc_id, label, fold FROM folds", "folds")
def f01(t):
    return t.folds.select("doc_id", "label", "fold")


def sql_sample(source: str, total: str) -> str:
    """Largest-remainder quotas and the first rows in digest order."""
    return f"""n AS (SELECT label, count(*) AS n FROM {source} GROUP BY label),
    x AS (SELECT label, {total} * n / sum(n) OVER () AS exact FROM n),
    q AS (SELECT label, CAST(floor(exact) + (row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, label)
        <= round({total.replace('(SELECT ', '(SELECT ')}) - sum(floor(exact)) OVER ())::INT AS BIGINT) AS quota FROM x),
    ranked AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|sample|'||doc_id), doc_id) AS rn FROM {source})
    SELECT doc_id, label FROM ranked JOIN q USING (label) WHERE rn <= quota"""


@query("f02_holdout", "WITH " + sql_sample("gold", "ceil(0.2::DOUBLE * (SELECT count(*) FROM gold))"), "gold")
def f02(t):
    return sp.stratified_sample(t.gold, "doc_id", "label", share=0.2).select("doc_id", "label")


@query("f02_fixed_sample", "WITH " + sql_sample("gold", "400.0::DOUBLE"), "gold")
def f02b(t):
    return sp.stratified_sample(t.gold, "doc_id", "label", size=400).select("doc_id", "label")


@query(
    "f03_class_weights",
    "SELECT label, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight FROM gold GROUP BY label",
    "gold",
)
def f03(t):
    return rounded(sp.balanced_class_weights(t.gold, "label"))


@query(
    "f04_first_per_class",
    "SELECT doc_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM gold) WHERE rn <= 2",
    "gold",
)
def f04(t):
    return sp.head_per_group(t.gold, ["label"], ["doc_id"], 2).select("doc_id", "label")


def fold_probabilities(t) -> DataFrame:
    """Answers of five fold models for every document, derived from one model's table."""
    base = t.probs.filter("model = 'a'").select("doc_id", F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("fold_model"))
    from textsignal.functions.hashing import uniform

    raw = base.withColumns({f"u{c}": uniform(F.col("doc_id"), F.col("fold_model"), c) + 0.01 for c in range(3)})
    total = F.col("u0") + F.col("u1") + F.col("u2")
    return raw.select("doc_id", "fold_model", *[(F.col(f"u{c}") / total).alias(f"p{c}") for c in range(3)])


@query(
    "f05_average_folds",
    "WITH raw AS (SELECT doc_id, k, "
    + ", ".join(f"{sql_uniform(f"doc_id||'|'||k||'|{c}'")} + 0.01::DOUBLE AS u{c}" for c in range(3))
    + " FROM gold, range(5) r(k)) SELECT doc_id, "
    + ", ".join(f"round(avg(u{c} / (u0 + u1 + u2)), 6) AS p{c}" for c in range(3))
    + " FROM raw GROUP BY doc_id",
    "gold",
)
def f05(t):
    return rounded(sp.average_over_folds(fold_probabilities(t), ["doc_id"]))


@query(
    "f06_first_folds",
    f"WITH {sql_scores(FOLD_PREDS, 'model, fold')} SELECT model, count(*) AS folds, round(avg(f1_macro), 6) AS mean,"
    " round(stddev_pop(f1_macro), 6) AS std FROM scores WHERE fold < 3 GROUP BY model",
    "preds folds",
)
def f06(t):
    proxy = preds_folds(t).filter("fold < 3")
    return rounded(m.fold_summary(m.score(proxy, ["model", "fold"]), ["model"]))
