"""Registered queries: votes, weight search and soft targets."""

from pyspark.sql import functions as F

from textsignal.functions.proba import pred_of
from textsignal.operators import ensemble as en
from textsignal.plans.evaluation import SQL_ARGMAX, rounded, sql_scores, sql_soft
from textsignal.plans.registry import query

KEYS = ["doc_id", "label"]
FIXED = {"a": 1.0, "b": 0.75, "c": 0.25, "z": 0.5}  # z is not in the table
W_SQL = "(VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in FIXED.items()) + ") w(model, weight)"
ROUND_P = ", ".join(f"round(p{i}, 6) AS p{i}" for i in range(3))
ARG = SQL_ARGMAX.format(a="p0", b="p1", c="p2")


def sql_vote(weights: str, extra: str = "") -> str:
    """Weighted vote over a (model, weight) relation, with optional group columns."""
    lead = f"{extra}, " if extra else ""
    sums = ", ".join(f"sum(weight * p{i}) / sum(weight) AS p{i}" for i in range(3))
    return f"SELECT {lead}doc_id, label, {sums} FROM probs JOIN {weights} USING (model) GROUP BY {lead}doc_id, label"


EQUAL = "SELECT doc_id, label, avg(p0) AS p0, avg(p1) AS p1, avg(p2) AS p2 FROM probs GROUP BY doc_id, label"
OWN = f"{sql_scores('SELECT model, label, pred FROM preds', 'model')}, own AS (SELECT model, f1_macro AS weight FROM scores)"


@query("i01_equal_vote", f"SELECT doc_id, label, {ROUND_P} FROM ({EQUAL})", "probs")
def i01(t):
    return rounded(en.equal_vote(t.probs, KEYS))


@query("i02_score_weighted_vote", f"WITH {OWN} SELECT doc_id, label, {ROUND_P} FROM ({sql_vote('own')})", "preds")
def i02(t):
    return rounded(en.score_weighted_vote(t.probs, KEYS))


@query(
    "i03_better_vote",
    f"""WITH {OWN}, both_votes AS (SELECT 'equal' AS config, * FROM ({EQUAL}) UNION ALL SELECT 'weighted', * FROM ({sql_vote('own')})),
    {sql_scores(f'SELECT config, label, {ARG} AS pred FROM both_votes', 'config').replace('base AS', 'base2 AS').replace('FROM base)', 'FROM base2)').replace('JOIN base ', 'JOIN base2 ').replace('grp', 'grp2').replace('cls', 'cls2').replace('per AS', 'per2 AS').replace('FROM per)', 'FROM per2)').replace('ratios', 'ratios2').replace('scores AS', 'scores2 AS')},
    pick AS (SELECT CASE WHEN (SELECT f1_macro FROM scores2 WHERE config = 'weighted') > (SELECT f1_macro FROM scores2 WHERE config = 'equal')
      THEN 'weighted' ELSE 'equal' END AS config)
    SELECT config, doc_id, label, {ROUND_P} FROM both_votes JOIN pick USING (config)""",
    "preds",
)
def i03(t):
    return rounded(en.better_vote(t.probs, KEYS))


@query("i04_weighted_vote", f"SELECT doc_id, label, {ROUND_P}, {ARG} AS pred FROM ({sql_vote(W_SQL)})", "probs")
def i04(t):
    return rounded(en.weighted_vote(t.probs, FIXED, KEYS).withColumn("pred", pred_of()))


BASE = {"a": 1.0, "b": 0.5}
CAND = [("base", "a", 1.0), ("base", "b", 0.5)]
CAND += [(n, m, w) for n, c in (("full", 1.0), ("half", 0.5)) for m, w in (("a", 1.0), ("b", 0.5), ("c", c))]
CAND_SQL = "(VALUES " + ", ".join(f"('{n}', '{m}', {w}::DOUBLE)" for n, m, w in CAND) + ") w(config, model, weight)"


@query(
    "i05_candidate_test",
    f"""WITH v AS ({sql_vote(CAND_SQL, 'config')}), {sql_scores(f'SELECT config, label, {ARG} AS pred FROM v', 'config')},
    f AS (SELECT max(f1_macro) FILTER (config = 'base') AS b, max(f1_macro) FILTER (config = 'full') AS u, max(f1_macro) FILTER (config = 'half') AS h FROM scores),
    s AS (SELECT *, u > b + 1e-4 AS take_full FROM f),
    pick AS (SELECT CASE WHEN h > (CASE WHEN take_full THEN u ELSE b END) + 1e-4 THEN 'half' WHEN take_full THEN 'full' ELSE 'base' END AS best FROM s)
    SELECT config, round(f1_macro, 6) AS f1_macro, config = best AS accepted FROM scores, pick""",
    "probs",
)
def i05(t):
    return rounded(en.candidate_test(t.probs, BASE, "c", KEYS))


@query("i06_coordinate_ascent")
def i06(t):
    weights, f1 = en.coordinate_ascent(t.probs, {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0}, KEYS)
    return t.spark.createDataFrame([(m, w, round(f1, 6)) for m, w in weights.items()], "model string, weight double, f1_macro double")


GRID_SQL = "(SELECT unnest(range(0, 5)) AS {x})"
SEARCH = f"""
  cfg AS (SELECT ka, kb, kc, kd FROM {GRID_SQL.format(x='ka')}, {GRID_SQL.format(x='kb')}, {GRID_SQL.format(x='kc')}, {GRID_SQL.format(x='kd')}
          WHERE gcd(gcd(ka, kb), gcd(kc, kd)) = 1),
  wide AS (SELECT doc_id, label, {', '.join(f"max(p{i}) FILTER (model = '{m}') AS p{i}_{m}" for i in range(3) for m in 'abcd')} FROM probs GROUP BY ALL),
  voted AS (SELECT ka, kb, kc, kd, label, {', '.join(f"(p{i}_a * ka + p{i}_b * kb + p{i}_c * kc + p{i}_d * kd) / (ka + kb + kc + kd) AS p{i}" for i in range(3))} FROM wide, cfg)"""


@query(
    "i07_weight_search",
    f"WITH {SEARCH}, {sql_scores(f'SELECT ka, kb, kc, kd, label, {ARG} AS pred FROM voted', 'ka, kb, kc, kd')}"
    " SELECT ka * 0.25::DOUBLE AS w_a, kb * 0.25::DOUBLE AS w_b, kc * 0.25::DOUBLE AS w_c, kd * 0.25::DOUBLE AS w_d, round(f1_macro, 6) AS f1_macro FROM scores",
    "probs",
)
def i07(t):
    return rounded(en.weight_search(t.probs, list("abcd"), KEYS).drop("config"))


TEACHER = sql_soft("2.0::DOUBLE").format(src=f"({sql_vote(W_SQL)})")


@query(
    "i08_soft_targets",
    f"SELECT doc_id, label, round(s0, 6) AS s0, round(s1, 6) AS s1, round(s2, 6) AS s2 FROM ({TEACHER})",
    "probs",
)
def i08(t):
    return rounded(en.soft_targets(t.probs, FIXED, KEYS))


CLASS_W = [2.2, 1.6, 0.5]
OWN_W = "(CASE label WHEN 0 THEN 2.2::DOUBLE WHEN 1 THEN 1.6::DOUBLE ELSE 0.5::DOUBLE END)"
OWN_LOG = "ln(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)"


def sql_kd(alpha: float, temp: float) -> str:
    student = sql_soft(f"{temp}::DOUBLE").format(src="probs")
    teacher = sql_soft(f"{temp}::DOUBLE").format(src=f"({sql_vote(W_SQL)})")
    kl = " + ".join(f"t.s{i} * (ln(t.s{i}) - ln(s.s{i}))" for i in range(3))
    return (
        f"SELECT s.model, (1 - {alpha}::DOUBLE) * sum(-{OWN_W.replace('label', 's.label')} * {OWN_LOG.replace('label', 's.label').replace('p0', 's.p0').replace('p1', 's.p1').replace('p2', 's.p2')}) / sum({OWN_W.replace('label', 's.label')})"
        f" + {alpha}::DOUBLE * {temp}::DOUBLE * {temp}::DOUBLE * avg({kl}) AS loss FROM ({student}) s JOIN ({teacher}) t ON t.doc_id = s.doc_id GROUP BY s.model"
    )


@query("i09_distillation_loss", f"SELECT model, round(loss, 6) AS loss FROM ({sql_kd(0.5, 2.0)})", "probs")
def i09(t):
    teacher = en.soft_targets(t.probs, FIXED, ["doc_id"])
    return rounded(en.distillation_loss(t.probs, teacher, ["model"], "doc_id", CLASS_W))


@query(
    "i10_symmetric_kl",
    "SELECT round(0.5 * (avg(ab) + avg(ba)), 6) AS divergence FROM (SELECT "
    + " + ".join(f"a.p{i} * (ln(a.p{i}) - ln(b.p{i}))" for i in range(3))
    + " AS ab, "
    + " + ".join(f"b.p{i} * (ln(b.p{i}) - ln(a.p{i}))" for i in range(3))
    + " AS ba FROM probs a JOIN probs b ON a.doc_id = b.doc_id AND a.model = 'a' AND b.model = 'b')",
    "probs",
)
def i10(t):
    return rounded(en.symmetric_kl(t.probs.filter("model = 'a'"), t.probs.filter("model = 'b'"), "doc_id"))


@query(
    "i11_smoothed_loss",
    f"SELECT model, round(sum(0.95::DOUBLE * -{OWN_W} * {OWN_LOG} + 0.05::DOUBLE * -(2.2::DOUBLE * ln(p0) + 1.6::DOUBLE * ln(p1) + 0.5::DOUBLE * ln(p2)) / 3)"
    f" / sum({OWN_W}), 6) AS loss FROM probs GROUP BY model",
    "probs",
)
def i11(t):
    return rounded(en.smoothed_cross_entropy(t.probs, ["model"], CLASS_W, 0.05))


KD_GRID = [(0.5, 2.0), (0.7, 2.0), (0.9, 2.0), (0.5, 3.0), (0.7, 3.0), (1.0, 2.0)]


@query(
    "i12_grid_report",
    "WITH r AS ("
    + " UNION ALL ".join(
        f"SELECT 'a={a},T={x}' AS config, -loss AS score FROM ({sql_kd(a, x)}) WHERE model = 'b'" for a, x in KD_GRID
    )
    + ") SELECT config, round(score, 6) AS score, round(score - (SELECT score FROM r WHERE config = 'a=0.5,T=2.0'), 6) AS change,"
    " score = (SELECT max(score) FROM r) AS best FROM r",
    "probs",
)
def i12(t):
    student = t.probs.filter("model = 'b'")
    parts = None
    for a, x in KD_GRID:
        teacher = en.soft_targets(t.probs, FIXED, ["doc_id"], x)
        one = en.distillation_loss(student, teacher, ["model"], "doc_id", CLASS_W, a, x)
        one = one.select(F.lit(f"a={a},T={x}").alias("config"), (-F.col("loss")).alias("score"))
        parts = one if parts is None else parts.unionByName(one)
    return rounded(en.grid_report(parts, "config", "score", "a=0.5,T=2.0"))


