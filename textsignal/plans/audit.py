"""Registered queries: corpus audit."""

from pyspark.sql import functions as F

from textsignal.functions import clean, surface
from textsignal.operators import audit as au
from textsignal.operators.lexicon import lexicon_scores
from textsignal.plans.evaluation import rounded
from textsignal.plans.features import LEXICON_SQL, sql_count
from textsignal.plans.registry import query

WORDS = "len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''))"


@query(
    "j01_class_balance",
    "SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share,"
    " round(max(count(*)) OVER () / min(count(*)) OVER (), 6) AS imbalance FROM gold GROUP BY label",
    "gold",
)
def j01(t):
    return rounded(au.class_balance(t.gold))


def _describe(col: str) -> str:
    return (
        f"SELECT label, '{col}' AS metric, count(*) AS count, round(avg({col}), 2) AS mean, round(stddev_samp({col}), 2) AS std, min({col}) AS min,"
        f" round(quantile_cont({col}, 0.25), 2) AS q25, round(quantile_cont({col}, 0.5), 2) AS q50, round(quantile_cont({col}, 0.75), 2) AS q75, max({col}) AS max FROM m GROUP BY label"
    )


@query(
    "j02_length_summary",
    f"WITH m AS (SELECT label, CAST({WORDS} AS BIGINT) AS word_count, length(text) AS char_count FROM corpus)"
    f" {_describe('word_count')} UNION ALL {_describe('char_count')}",
    "corpus",
)
def j02(t):
    text = F.col("text")
    values = {"word_count": surface.word_count(text), "char_count": surface.char_count(text)}
    return rounded(au.describe_by(t.corpus, "label", values), 2)


@query(
    "j03_surface_means",
    "SELECT label, "
    + ", ".join(
        f"round(avg({sql_count(p)}), 6) AS {n}"
        for n, p in [
            ("hashtags", "#[\\pL\\pN_]+"),
            ("mentions", "@[\\pL\\pN_]+"),
            ("cashtags", "\\$[A-Z]{1,5}"),
            ("urls", "https?://\\S+"),
        ]
    )
    + " FROM social_gold GROUP BY label",
    "social_gold",
)
def j03(t):
    return rounded(au.surface_means(t.social_gold, "label"))


BAD = "bad AS (SELECT doc_id, label, f.text, enc, (enc <> f.text OR contains(f.text, '�')) AS bad FROM fixed_enc f JOIN gold USING (doc_id))"


@query(
    "j04_corruption",
    f"WITH {BAD} SELECT label, count(*) FILTER (bad) AS corrupted, count(*) AS total, round(100 * count(*) FILTER (bad) / count(*), 6) AS pct"
    " FROM bad GROUP BY ROLLUP (label)",
    "fixed_enc gold",
)
def j04(t):
    return rounded(au.corruption_rates(t.social_gold))


@query(
    "j05_repair_examples",
    f"WITH {BAD} SELECT label, doc_id, substr(text, 1, 100) AS before, substr(enc, 1, 100) AS after FROM"
    " (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id) AS rn FROM bad WHERE bad) WHERE rn <= 2 AND enc <> text",
    "fixed_enc gold",
)
def j05(t):
    return au.repair_examples(t.social_gold, "label", "doc_id")


@query(
    "j06_exact_duplicates",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS extra_rows, count(*) FILTER (n > 1) AS groups, CAST(sum(n) AS BIGINT) AS rows FROM"
    " (SELECT text, count(*) AS n FROM documents GROUP BY text)",
)
def j06(t):
    return au.exact_duplicates(t.documents)


@query(
    "j07_near_duplicates",
    "SELECT CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_in_groups, round(100 * coalesce(sum(n) FILTER (n > 1), 0) / sum(n), 6) AS pct FROM"
    " (SELECT lower(fixed) AS k, count(*) AS n FROM fixed GROUP BY 1)",
    "fixed",
)
def j07(t):
    return rounded(au.near_duplicates(t.social))


@query(
    "j08_conflicting_labels",
    "SELECT count(*) AS conflicting_groups FROM (SELECT lower(fixed) FROM fixed JOIN gold USING (doc_id) GROUP BY 1 HAVING count(DISTINCT label) > 1)",
    "fixed gold",
)
def j08(t):
    return au.conflicting_groups(t.social_gold)


def _overlap(key: str) -> str:
    return (
        f"SELECT count(*) AS rows, count(DISTINCT {key}) AS texts FROM split_pair WHERE in_a AND {key} IN (SELECT {key} FROM split_pair WHERE NOT in_a)"
    )


@query("j09_exact_overlap", _overlap("text"), "split_pair")
def j09(t):
    return au.overlap(t.split_a, t.split_b, False)


@query("j10_normalised_overlap", _overlap("lower(fixed)"), "split_pair")
def j10(t):
    return au.overlap(t.split_a, t.split_b, True)


@query(
    "j11_shift",
    f"""WITH m AS (SELECT in_a, {WORDS} AS w, {sql_count('\\$[A-Z]{1,5}')} > 0 AS c, regexp_matches(text, 'https?://') AS u,
         (enc <> text OR contains(text, '�')) AS b FROM (SELECT s.*, e.enc FROM split_pair s JOIN fixed_enc e USING (doc_id))),
       s AS (SELECT in_a, avg(w) AS mean_words, max(w)::DOUBLE AS max_words, 100 * avg(c::INT) AS pct_cashtag, 100 * avg(u::INT) AS pct_url,
         100 * avg(b::INT) AS pct_misread FROM m GROUP BY in_a),
       l AS (UNPIVOT s ON mean_words, max_words, pct_cashtag, pct_url, pct_misread INTO NAME metric VALUE v)
       SELECT metric, round(max(v) FILTER (in_a), 6) AS a, round(max(v) FILTER (NOT in_a), 6) AS b FROM l GROUP BY metric""",
    "split_pair",
)
def j11(t):
    return rounded(au.shift_table(t.split_a, t.split_b))


@query(
    "j12_lexicon_histogram",
    "WITH "
    + LEXICON_SQL
    + """, v AS (SELECT label, lex_compound AS x FROM lex JOIN gold USING (doc_id)),
    s AS (SELECT label, min(x) AS lo, max(x) AS hi, avg(x) AS mean FROM v GROUP BY label)
    SELECT label, CAST(least(floor((x - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n, round(max(mean), 6) AS mean
    FROM v JOIN s USING (label) GROUP BY 1, 2""",
    "social lexicon gold",
)
def j12(t):
    scored = lexicon_scores(t.social, t.lexicon).join(t.gold, "doc_id")
    return rounded(au.lexicon_histogram(scored))


@query(
    "j12_lexicon_ambiguity",
    "WITH "
    + LEXICON_SQL
    + """, v AS (SELECT lex_compound AS x FROM lex JOIN gold USING (doc_id) WHERE label = 1)
    SELECT count(*) AS total, count(*) FILTER (x > 0.05) AS positive, count(*) FILTER (x < -0.05) AS negative,
      count(*) FILTER (x BETWEEN -0.05 AND 0.05) AS neutral, round(100 * count(*) FILTER (x > 0.05) / count(*), 1) AS positive_pct,
      round(100 * count(*) FILTER (x < -0.05) / count(*), 1) AS negative_pct,
      round(100 * count(*) FILTER (x BETWEEN -0.05 AND 0.05) / count(*), 1) AS neutral_pct FROM v""",
    "social lexicon gold",
)
def j12b(t):
    scored = lexicon_scores(t.social, t.lexicon).join(t.gold, "doc_id")
    return au.lexicon_ambiguity(scored, 1)


@query("j13_share_containing", "SELECT round(100 * avg(regexp_matches(text, '\\$[A-Z]{1,5}')::INT), 6) AS pct FROM social", "social")
def j13(t):
    return rounded(au.share_containing(t.social, r"\$[A-Z]{1,5}"))


@query("j14_share_changed", "SELECT round(100 * avg((fixed <> text)::INT), 6) AS pct FROM fixed", "fixed")
def j14(t):
    return rounded(au.share_changed(t.social, clean.fix_text(F.col("text"))))


