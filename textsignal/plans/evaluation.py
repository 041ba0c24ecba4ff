"""Registered queries: scores, calibration, tests and report tables."""

from pyspark.sql import DataFrame, functions as F

from textsignal.constants import NOISE_THRESHOLDS, TEMPERATURES
from textsignal.functions.proba import argmax_array, confidence_of, pred_of, soften3
from textsignal.operators import metrics as m
from textsignal.operators import stats as st
from textsignal.plans.registry import query
from textsignal.plans.views import sql_uniform

SQL_ARGMAX = "CASE WHEN {a}>={b} AND {a}>={c} THEN 0 WHEN {b}>={c} THEN 1 ELSE 2 END"


def preds(t) -> DataFrame:
    return t.probs.withColumns({"pred": pred_of(), "conf": confidence_of()})


def preds_folds(t) -> DataFrame:
    return preds(t).join(t.folds.select("doc_id", "fold"), "doc_id")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


# --- oracle pieces: scores from per-class counts, grouped by ``by`` --------------------
def sql_scores(source: str, by: str) -> str:
    """CTEs ending in ``scores(by, n, accuracy, f1_macro, ...)``."""
    return f"""
    base AS ({source}),
    grp AS (SELECT DISTINCT {by} FROM base),
    cls AS (SELECT grp.*, c FROM grp, (VALUES (0), (1), (2)) v(c)),
    per AS (SELECT {', '.join('cls.' + b.strip() for b in by.split(','))}, cls.c,
        count(*) FILTER (label = cls.c) AS sup, count(*) FILTER (pred = cls.c) AS prd,
        count(*) FILTER (label = cls.c AND pred = cls.c) AS tp
        FROM cls JOIN base USING ({by}) GROUP BY ALL),
    ratios AS (SELECT *, CASE WHEN prd > 0 THEN tp / prd ELSE 0 END AS prec, CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS rec,
        CASE WHEN sup + prd > 0 THEN 2 * tp / (sup + prd) ELSE 0 END AS f1 FROM per),
    scores AS (SELECT {by}, CAST(sum(sup) AS BIGINT) AS n, sum(tp) / sum(sup) AS accuracy,
        sum(f1) / count(*) FILTER (sup + prd > 0) AS f1_macro, sum(f1 * sup) / sum(sup) AS f1_weighted,
        sum(prec) / count(*) FILTER (sup + prd > 0) AS precision_macro,
        sum(rec) / count(*) FILTER (sup + prd > 0) AS recall_macro,
        sum(prec * sup) / sum(sup) AS precision_weighted, sum(rec * sup) / sum(sup) AS recall_weighted
        FROM ratios GROUP BY {by})"""


SCORE_LIST = ", ".join(
    f"round({c}, 6) AS {c}" for c in ("accuracy", "f1_macro", "f1_weighted", "precision_macro", "recall_macro")
)
PREDS = "SELECT model, label, pred FROM preds"
FOLD_PREDS = "SELECT model, fold, p.label, pred FROM preds p JOIN folds USING (doc_id)"


@query("h01_argmax", "SELECT doc_id, model, pred FROM preds", "preds")
def h01(t):
    return t.probs.select("doc_id", "model", argmax_array(F.array("p0", "p1", "p2")).alias("pred"))


@query(
    "h02_confusion",
    """SELECT g.model, CAST(l AS INTEGER) AS label, CAST(p AS INTEGER) AS pred, count(preds.doc_id) AS n,
       round(count(preds.doc_id) / sum(count(preds.doc_id)) OVER (PARTITION BY g.model, l), 6) AS share
       FROM (SELECT DISTINCT model FROM preds) g, range(3) a(l), range(3) b(p)
       LEFT JOIN preds ON preds.model = g.model AND preds.label = l AND preds.pred = p GROUP BY g.model, l, p""",
    "preds",
)
def h02(t):
    return rounded(m.confusion_long(preds(t), ["model"]))


@query(
    "h03_report",
    f"""WITH {sql_scores(PREDS, 'model')}
    SELECT model, CASE c WHEN 0 THEN 'Bearish' WHEN 1 THEN 'Bullish' ELSE 'Neutral' END AS row, round(prec, 6) AS precision,
      round(rec, 6) AS recall, round(f1, 6) AS f1, sup AS support FROM ratios
    UNION ALL SELECT model, 'macro', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), n FROM scores
    UNION ALL SELECT model, 'weighted', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), n FROM scores""",
    "preds",
)
def h03(t):
    return rounded(m.class_report(preds(t), ["model"]))


@query(
    "h04_fold_scores",
    f"WITH {sql_scores(FOLD_PREDS, 'model, fold')} SELECT model, count(*) AS folds, round(avg(f1_macro), 6) AS mean,"
    " round(stddev_pop(f1_macro), 6) AS std FROM scores GROUP BY model",
    "preds folds",
)
def h04(t):
    return rounded(m.fold_summary(m.score(preds_folds(t), ["model", "fold"]), ["model"]))


@query("h05_pooled_scores", f"WITH {sql_scores(PREDS, 'model')} SELECT model, n, {SCORE_LIST} FROM scores", "preds")
def h05(t):
    return rounded(m.score(preds(t), ["model"]))


def train_test(t):
    """Two models as a train and a test side of one run."""
    rows = preds_folds(t)
    return rows.filter("model = 'a'"), rows.filter("model = 'b'")


@query(
    "h06_overfit_gap",
    f"WITH {sql_scores(FOLD_PREDS, 'model, fold')}"
    " SELECT 'run' AS run, round(avg(f1_macro) FILTER (model = 'b'), 6) AS f1_macro, round(avg(f1_macro) FILTER (model = 'a'), 6)"
    " AS train_f1_macro, round(avg(f1_macro) FILTER (model = 'a') - avg(f1_macro) FILTER (model = 'b'), 6) AS overfit_gap FROM scores",
    "preds folds",
)
def h06(t):
    train, test = train_test(t)
    mark = lambda df: m.score(df, ["fold"]).withColumn("run", F.lit("run"))
    rec = m.metric_record(mark(train), mark(test), ["run"])
    return rounded(rec.select("run", "f1_macro", "train_f1_macro", "overfit_gap"))


@query(
    "h07_distribution",
    """SELECT g.model, CAST(p AS INTEGER) AS pred, count(preds.doc_id) AS n,
       round(count(preds.doc_id) / sum(count(preds.doc_id)) OVER (PARTITION BY g.model), 6) AS share
       FROM (SELECT DISTINCT model FROM preds) g, range(3) b(p)
       LEFT JOIN preds ON preds.model = g.model AND preds.pred = p GROUP BY g.model, p""",
    "preds",
)
def h07(t):
    return rounded(m.class_distribution(preds(t), ["model"]))


@query("h08_error_types", "SELECT model, label, pred, count(*) AS n FROM preds WHERE label <> pred GROUP BY ALL", "preds")
def h08(t):
    return m.error_types(preds(t), ["model"])


@query(
    "h09_error_examples",
    """WITH kinds AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY n DESC, label, pred) AS rank FROM
         (SELECT model, label, pred, count(*) AS n FROM preds WHERE label <> pred GROUP BY ALL)),
       ex AS (SELECT *, row_number() OVER (PARTITION BY model, label, pred ORDER BY doc_id) AS rn FROM preds WHERE label <> pred)
       SELECT model, label, pred, n, CAST(rank AS INTEGER) AS rank, doc_id FROM ex JOIN kinds USING (model, label, pred) WHERE rank <= 4 AND rn <= 2""",
    "preds",
)
def h09(t):
    return m.error_examples(preds(t), ["model"], "doc_id").select("model", "label", "pred", "n", "rank", "doc_id")


@query(
    "h10_validate",
    """WITH p AS (SELECT doc_id AS id, pred AS label FROM preds WHERE model = 'a'), s AS (SELECT doc_id AS id FROM gold)
       SELECT (SELECT count(*) FROM p) = (SELECT count(*) FROM s) AS row_count_ok, true AS columns_ok,
         (SELECT list_sort(list(DISTINCT label)) = [0, 1, 2] FROM p) AS labels_ok,
         (SELECT count(*) = count(label) FROM p) AS no_nulls, (SELECT count(*) = count(DISTINCT id) FROM p) AS ids_unique,
         (SELECT count(*) FROM (SELECT id FROM p EXCEPT SELECT id FROM s)) + (SELECT count(*) FROM (SELECT id FROM s EXCEPT SELECT id FROM p)) = 0 AS ids_match,
         (SELECT min(n) > 0.01 * (SELECT count(*) FROM p) FROM (SELECT count(*) AS n FROM p GROUP BY label)) AS no_collapse""",
    "preds",
)
def h10(t):
    mine = preds(t).filter("model = 'a'").select(F.col("doc_id").alias("id"), F.col("pred").alias("label"))
    return m.validate_predictions(mine, t.gold.select(F.col("doc_id").alias("id")))


@query(
    "h11_reliability",
    """SELECT model, upper, round(avg((pred = label)::INT), 6) AS accuracy, count(*) AS n FROM (SELECT *,
       CASE WHEN conf <= 0.5::DOUBLE THEN 0.5::DOUBLE WHEN conf <= 0.6::DOUBLE THEN 0.6::DOUBLE WHEN conf <= 0.7::DOUBLE THEN 0.7::DOUBLE
       WHEN conf <= 0.8::DOUBLE THEN 0.8::DOUBLE WHEN conf <= 0.9::DOUBLE THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS upper FROM preds)
       GROUP BY model, upper""",
    "preds",
)
def h11(t):
    return rounded(m.reliability_table(preds(t), ["model"]))


EDGES = m.calibration_edges()


@query(
    "h12_calibration_curve",
    "SELECT model, CAST(bin AS INTEGER) AS bin, round(avg((pred = label)::INT), 6) AS accuracy, count(*) AS n FROM preds JOIN (VALUES "
    + ", ".join(f"({i}, {EDGES[i]}::DOUBLE, {EDGES[i + 1]}::DOUBLE)" for i in range(10))
    + ") e(bin, lo, hi) ON conf >= lo AND conf < hi GROUP BY model, bin HAVING count(*) >= 20",
    "preds",
)
def h12(t):
    return rounded(m.calibration_curve(preds(t), ["model"]))


def sql_soft(temp: str, p: str = "p") -> str:
    raw = ", ".join(f"ln({p}{i} + 1e-9::DOUBLE) / {temp} AS z{i}" for i in range(3))
    exps = ", ".join(f"exp(z{i} - greatest(z0, z1, z2)) AS x{i}" for i in range(3))
    return f"SELECT *, x0/(x0+x1+x2) AS s0, x1/(x0+x1+x2) AS s1, x2/(x0+x1+x2) AS s2 FROM (SELECT *, {exps} FROM (SELECT *, {raw} FROM {{src}}))"


@query(
    "h13_temperature",
    "SELECT doc_id, model, round(s0, 6) AS s0, round(s1, 6) AS s1, round(s2, 6) AS s2 FROM ("
    + sql_soft("2.0::DOUBLE").format(src="probs")
    + ")",
    "probs",
)
def h13(t):
    s = soften3([F.col(f"p{i}") for i in range(3)], 2.0)
    return t.probs.select("doc_id", "model", *[F.round(c, 6).alias(f"s{i}") for i, c in enumerate(s)])


TEMPS = "(VALUES " + ", ".join(f"({t}::DOUBLE)" for t in TEMPERATURES) + ") g(t)"


@query(
    "h14_temperature_search",
    "WITH soft AS ("
    + sql_soft("t").format(src=f"(SELECT * FROM probs, {TEMPS})")
    + f"), {sql_scores('SELECT model, t, label, ' + SQL_ARGMAX.format(a='s0', b='s1', c='s2') + ' AS pred FROM soft', 'model, t')}, "
    "plain AS (SELECT model, f1_macro AS base_f1 FROM scores WHERE t = 1.0), "
    "best AS (SELECT model, t, f1_macro FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(f1_macro, 12) DESC, t) AS rn FROM scores) WHERE rn = 1)"
    " SELECT model, round(base_f1, 6) AS base_f1, CASE WHEN f1_macro > base_f1 + 1e-12 THEN t ELSE 1.0::DOUBLE END AS best_t,"
    " round(greatest(f1_macro, base_f1), 6) AS best_f1, round(greatest(f1_macro - base_f1, 0), 6) AS gain FROM best JOIN plain USING (model)",
    "probs",
)
def h14(t):
    return rounded(m.temperature_search(t.probs, ["model"]))


PRIORS = [(1.0, 1.0, 1.0)] + [(a, b, 1.0) for a in (0.8, 1.0, 1.25) for b in (0.8, 1.0, 1.25) if (a, b) != (1.0, 1.0)]


@query(
    "h15_prior_scaling",
    "WITH cfg AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for i, (a, b, c) in enumerate(PRIORS))
    + ") v(config, m0, m1, m2)), "
    + sql_scores(
        "SELECT model, half, config, label, "
        + SQL_ARGMAX.format(a="p0*m0", b="p1*m1", c="p2*m2")
        + " AS pred FROM (SELECT *, CASE WHEN "
        + sql_uniform("'half|'||doc_id")
        + " < 0.5 THEN 0 ELSE 1 END AS half FROM probs), cfg",
        "model, half, config",
    )
    + ", best AS (SELECT * FROM (SELECT model, half, config, row_number() OVER (PARTITION BY model, half ORDER BY round(f1_macro, 12) DESC, config) AS rn FROM scores) WHERE rn = 1)"
    " SELECT b.model, b.half AS tuned_on, b.config, round(s.f1_macro - z.f1_macro, 6) AS held_out_gain FROM best b"
    " JOIN scores s ON s.model = b.model AND s.half = 1 - b.half AND s.config = b.config"
    " JOIN scores z ON z.model = b.model AND z.half = 1 - b.half AND z.config = 0",
    "probs",
)
def h15(t):
    return rounded(m.prior_scaling(t.probs, ["model"], PRIORS))


@query(
    "h16_signed_rank",
    f"""WITH {sql_scores(FOLD_PREDS, 'model, fold')},
    d AS (SELECT * FROM (SELECT round(a.f1_macro - b.f1_macro, 12) AS d FROM scores a JOIN scores b ON a.fold = b.fold AND a.model = 'b' AND b.model = 'c') WHERE d <> 0),
    r AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2 AS r, row_number() OVER (ORDER BY abs(d), d) - 1 AS i FROM d),
    w AS (SELECT count(*) AS n, coalesce(sum(r) FILTER (d > 0), 0) AS w FROM r),
    sums AS (SELECT s, sum(r * ((s >> i) & 1)) AS total FROM r, (SELECT unnest(range(0, (1 << (SELECT n FROM w))::BIGINT)) AS s) GROUP BY s)
    SELECT n, round(w, 6) AS w_plus, round((SELECT count(*) FROM sums WHERE total >= w - 1e-9) / (SELECT count(*) FROM sums), 6) AS p_value FROM w""",
    "preds folds",
)
def h16(t):
    per_fold = m.score(preds_folds(t).filter("model in ('b', 'c')"), ["fold", "model"])
    pairs = per_fold.groupBy("fold").agg(
        F.max(F.when(F.col("model") == "b", F.col("f1_macro"))).alias("first"),
        F.max(F.when(F.col("model") == "c", F.col("f1_macro"))).alias("second"),
    )
    return rounded(st.signed_rank(pairs, "first", "second"))


def paired_preds(t) -> DataFrame:
    """(doc_id, label, pa, pb): the classes that models a and b give."""
    rows = preds(t).filter("model in ('a', 'b')")
    return rows.groupBy("doc_id", "label").agg(
        F.max(F.when(F.col("model") == "a", F.col("pred"))).alias("pa"),
        F.max(F.when(F.col("model") == "b", F.col("pred"))).alias("pb"),
    )


@query("h17_bootstrap")
def h17(t):
    return rounded(st.bootstrap_difference(paired_preds(t), "label", "pa", "pb"))


SQL_WEIGHT = " + ".join(
    f"(cast(('0x' || substr(d, 8 * nth + 1, 8)) AS UBIGINT) / 4294967296.0::DOUBLE >= {bound!r}::DOUBLE)::INT" for bound in st.POISSON_BOUNDS
)


def sql_macro(pred: str) -> str:
    sizes = [f"coalesce(sum(w) FILTER (label = {c}), 0) + coalesce(sum(w) FILTER ({pred} = {c}), 0)" for c in range(3)]
    parts = [f"CASE WHEN {n} > 0 THEN 2.0::DOUBLE * coalesce(sum(w) FILTER (label = {c} AND {pred} = {c}), 0) / ({n}) ELSE 0 END" for c, n in enumerate(sizes)]
    return f"({' + '.join(parts)}) / ({' + '.join(f'({n} > 0)::INT' for n in sizes)})"


@query(
    "h17_poisson_bootstrap",
    f"""WITH pairs AS (SELECT doc_id, label, max(pred) FILTER (model = 'a') AS pa, max(pred) FILTER (model = 'b') AS pb FROM preds
      WHERE model IN ('a', 'b') GROUP BY ALL),
    digests AS (SELECT *, md5('42|poisson|' || doc_id || '|' || block) AS d FROM pairs, (SELECT unnest(range(250)) AS block)),
    drawn AS (SELECT label, pa, pb, block * 4 + nth AS replicate, {SQL_WEIGHT} AS w FROM digests, (SELECT unnest(range(4)) AS nth)),
    diffs AS (SELECT replicate, {sql_macro('pa')} - {sql_macro('pb')} AS d FROM
      (SELECT * FROM drawn UNION ALL SELECT label, pa, pb, -1, 1 FROM pairs) GROUP BY replicate)
    SELECT count(*) FILTER (replicate >= 0) AS replicates, round(quantile_cont(d, 0.025) FILTER (replicate >= 0), 6) AS ci_low,
      round(quantile_cont(d, 0.975) FILTER (replicate >= 0), 6) AS ci_high, round(max(d) FILTER (replicate < 0), 6) AS observed FROM diffs""",
    "preds",
)
def h17b(t):
    return rounded(st.poisson_bootstrap(paired_preds(t), "doc_id", "label", "pa", "pb"))


@query(
    "h18_label_noise",
    "SELECT model, threshold, count(*) FILTER (pred <> label AND conf >= threshold) AS n,"
    " round(100 * count(*) FILTER (pred <> label AND conf >= threshold) / count(*), 6) AS pct FROM preds, (VALUES "
    + ", ".join(f"({x}::DOUBLE)" for x in NOISE_THRESHOLDS)
    + ") v(threshold) GROUP BY model, threshold",
    "preds",
)
def h18(t):
    return rounded(m.label_noise(preds(t), ["model"]))


def records(t) -> DataFrame:
    """One run record per model from its pooled scores."""
    return m.score(preds(t), ["model"]).withColumnRenamed("model", "tag")


@query(
    "h19_leaderboard",
    f"WITH {sql_scores(PREDS, 'model')} SELECT model AS tag, round(f1_macro, 4) AS f1_macro, round(f1_weighted, 4) AS f1_weighted,"
    " round(accuracy, 4) AS accuracy FROM scores ORDER BY f1_macro DESC, tag LIMIT 3",
    "preds",
)
def h19(t):
    return m.leaderboard(records(t), 3).select("tag", "f1_macro", "f1_weighted", "accuracy")


@query(
    "h20_ablation",
    f"WITH {sql_scores(FOLD_PREDS, 'model, fold')} SELECT model, fold, round(f1_macro, 4) AS f1,"
    " round(round(f1_macro, 4) - lag(round(f1_macro, 4)) OVER (PARTITION BY model ORDER BY fold), 4) AS delta FROM scores",
    "preds folds",
)
def h20(t):
    per = m.score(preds_folds(t), ["model", "fold"]).select("model", "fold", F.round("f1_macro", 4).alias("f1"))
    return m.ablation_table(per, "model", "fold", "f1")


@query(
    "h21_gain",
    f"WITH {sql_scores(PREDS, 'model')} SELECT model AS tag, round(f1_macro, 6) AS f1_macro,"
    " round(f1_macro - (SELECT f1_macro FROM scores WHERE model = 'd'), 6) AS gain FROM scores",
    "preds",
)
def h21(t):
    return rounded(m.gain_over(records(t).select("tag", "f1_macro"), "tag", "f1_macro", "d"))


@query(
    "h22_summary",
    f"WITH {sql_scores(PREDS, 'model')} SELECT s.model, round(f1_macro, 6) AS f1_macro, round(accuracy, 6) AS accuracy,"
    " round(max(f1) FILTER (c = 0), 6) AS f1_bearish, round(max(f1) FILTER (c = 1), 6) AS f1_bullish, round(max(f1) FILTER (c = 2), 6) AS f1_neutral,"
    " max(prd) FILTER (c = 0) AS n0, max(prd) FILTER (c = 1) AS n1, max(prd) FILTER (c = 2) AS n2"
    " FROM scores s JOIN ratios r ON r.model = s.model GROUP BY ALL",
    "preds",
)
def h22(t):
    s = m.run_summary(preds(t), ["model"])
    flat = s.select(
        "model", "f1_macro", "accuracy",
        *[F.col("per_class_f1")[n].alias(f"f1_{n.lower()}") for n in ("Bearish", "Bullish", "Neutral")],
        *[F.col("test_dist")[i].alias(f"n{i}") for i in range(3)],
    )
    return rounded(flat)


