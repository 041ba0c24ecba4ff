"""Registered queries: hand-made numeric features."""

from pyspark.sql import functions as F

from textsignal.functions import surface as s
from textsignal.operators import lexicon as lx
from textsignal.operators.classify import stored
from textsignal.operators.features import FEATURE_COLUMNS, SURFACE_COLUMNS, feature_rows, standardise
from textsignal.plans.registry import query

SQL_WORDS = "list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> '')"
W = SQL_WORDS.format(x="text")


def sql_count(pattern: str, x: str = "text") -> str:
    return f"CAST(len(regexp_extract_all({x}, '{pattern}')) AS INTEGER)"


SURFACE_SQL = {
    "n_cashtags": sql_count("\\$[A-Z]{1,5}"),
    "n_hashtags": sql_count("#[\\pL\\pN_]+"),
    "n_mentions": sql_count("@[\\pL\\pN_]+"),
    "has_url": "CAST(regexp_matches(text, 'https?://') AS INTEGER)",
    "word_count": f"CAST(len({W}) AS INTEGER)",
    "char_count": "CAST(length(text) AS INTEGER)",
    "exclamation": sql_count("!"),
    "question": sql_count("\\?"),
    "all_caps_ratio": f"round(len(list_filter({W}, lambda w: w = upper(w) AND w <> lower(w)))"
    f"::DOUBLE / greatest(len({W}), 1), 6)",
    "flesch_score": "round(206.835::DOUBLE - 1.015::DOUBLE * (greatest(len({w}), 1)::DOUBLE / greatest({s}, 1))"
    " - 84.6::DOUBLE * (coalesce(list_sum(list_transform({w}, lambda w:"
    " greatest(len(regexp_extract_all(w, '[aeiouy]+')), 1))), 0)::DOUBLE / greatest(len({w}), 1)), 6)".format(
        w=SQL_WORDS.format(x="lower(text)"), s=sql_count("[.!?]+")
    ),
}
CODES = {
    "c02_cashtags": ["n_cashtags"],
    "c03_hashtags": ["n_hashtags"],
    "c04_mentions": ["n_mentions"],
    "c06_word_count": ["word_count"],
    "c07_char_count": ["char_count"],
    "c08_marks": ["exclamation", "question"],
    "c09_caps_ratio": ["all_caps_ratio"],
    "c10_reading_ease": ["flesch_score"],
}


def _rounded(name, col):
    return F.round(col, 6).alias(name) if name in ("all_caps_ratio", "flesch_score") else col.alias(name)


def _surface(name, columns):
    sql = ", ".join(f"{SURFACE_SQL[c]} AS {c}" for c in columns)

    @query(name, f"SELECT doc_id, {sql} FROM social", "social")
    def run(t):
        cols = s.surface_columns(F.col("text"))
        return t.social.select("doc_id", *[_rounded(c, cols[c]) for c in columns])


for _name, _columns in CODES.items():
    _surface(_name, _columns)


@query(
    "c05_url_flag_and_count",
    f"SELECT page_id, CAST(regexp_matches(url, 'https?://') AS INTEGER) AS has_url,"
    f" {sql_count('https?://' + chr(92) + 'S+', 'html')} AS n_urls FROM pages",
)
def c05(t):
    return t.read("pages").select(
        "page_id", s.url_flag(F.col("url")).alias("has_url"), s.url_count(F.col("html")).alias("n_urls")
    )


def _in(col: str, values: list[str]) -> str:
    return f"{col} IN (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _boost_sql(col: str) -> str:
    return f"(CASE WHEN {_in(col, lx.UP)} THEN 0.293::DOUBLE WHEN {_in(col, lx.DOWN)} THEN -0.293::DOUBLE ELSE 0 END)"


def _neg_sql(col: str) -> str:
    return f"(CASE WHEN {_in(col, lx.NEGATIONS)} OR ends_with({col}, 'n''t') THEN -0.74::DOUBLE ELSE 1 END)"


LEXICON_SQL = f"""
  toks AS (SELECT doc_id, text, unnest(ws) AS raw, generate_subscripts(ws, 1) AS pos FROM
           (SELECT doc_id, text, {W} AS ws FROM social)),
  bare AS (SELECT *, regexp_replace(raw, '^[\\pP\\pS]+|[\\pP\\pS]+$', '', 'g') AS core FROM toks),
  cased AS (SELECT doc_id, pos, text, CASE WHEN length(core) > 2 THEN core ELSE raw END AS tok FROM bare),
  ctx AS (SELECT doc_id, pos, text, lower(tok) AS token, (tok = upper(tok) AND tok <> lower(tok)) AS caps,
          lag(lower(tok), 1) OVER w AS l1, lag(lower(tok), 2) OVER w AS l2, lag(lower(tok), 3) OVER w AS l3
          FROM cased WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
  per_doc AS (SELECT doc_id, count(*) AS n, count(*) FILTER (caps) AS n_caps, min(pos) FILTER (token = 'but') AS but_at,
          least(length(any_value(text)) - length(replace(any_value(text), '!', '')), 4) AS bang,
          length(any_value(text)) - length(replace(any_value(text), '?', '')) AS ask FROM ctx GROUP BY doc_id),
  vals AS (SELECT ctx.doc_id, coalesce(
          ((valence + (CASE WHEN caps AND n_caps > 0 AND n_caps < n THEN sign(valence) * 0.733::DOUBLE ELSE 0 END)
          + sign(valence) * {_boost_sql('l1')} + sign(valence) * {_boost_sql('l2')} * 0.95::DOUBLE
          + sign(valence) * {_boost_sql('l3')} * 0.9::DOUBLE)
          * {_neg_sql('l1')} * {_neg_sql('l2')} * {_neg_sql('l3')})
          * (CASE WHEN pos < but_at THEN 0.5::DOUBLE WHEN pos > but_at THEN 1.5::DOUBLE ELSE 1 END), 0) AS v,
          bang * 0.292::DOUBLE + (CASE WHEN ask > 3 THEN 0.96::DOUBLE WHEN ask > 1 THEN ask * 0.18::DOUBLE ELSE 0 END) AS emph
          FROM ctx JOIN per_doc USING (doc_id) LEFT JOIN lexicon USING (token)),
  sums AS (SELECT doc_id, max(emph) AS emph, sum(v) AS s, coalesce(sum(v + 1) FILTER (v > 0), 0) AS p0,
          coalesce(sum(1 - v) FILTER (v < 0), 0) AS n0, count(*) FILTER (v = 0) AS neu FROM vals GROUP BY doc_id),
  amped AS (SELECT doc_id, neu, s + sign(round(s, 9)) * emph AS s,
          p0 + (CASE WHEN round(p0 - n0, 9) > 0 THEN emph ELSE 0 END) AS pos,
          n0 + (CASE WHEN round(p0 - n0, 9) < 0 THEN emph ELSE 0 END) AS neg FROM sums),
  lex AS (SELECT doc_id, round(pos / (pos + neg + neu), 3) AS lex_pos, round(neg / (pos + neg + neu), 3) AS lex_neg,
          round(neu / (pos + neg + neu), 3) AS lex_neu, round(s / sqrt(s * s + 15), 4) AS lex_compound FROM amped)
"""


@query("c01_lexicon", "WITH " + LEXICON_SQL + " SELECT * FROM lex", "social lexicon")
def c01(t):
    return lx.lexicon_scores(t.social, t.lexicon)


@query(
    "c11_feature_row",
    "WITH "
    + LEXICON_SQL
    + " SELECT lex.*, "
    + ", ".join(f"{SURFACE_SQL[c]} AS {c}" for c in SURFACE_COLUMNS)
    + " FROM social JOIN lex USING (doc_id)",
    "social lexicon",
)
def c11(t):
    rows = feature_rows(t.social, t.lexicon)
    return rows.select("doc_id", *[_rounded(c, F.col(c)) for c in FEATURE_COLUMNS])


@query(
    "e08_standardise",
    "WITH f AS (SELECT doc_id, "
    + ", ".join(f"{SURFACE_SQL[c]} AS {c}" for c in SURFACE_COLUMNS)
    + ") SELECT doc_id, ".replace(")", " FROM social)")
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () > 0 THEN"
        f" stddev_pop({c}) OVER () ELSE 1 END), 5) AS {c}"
        for c in SURFACE_COLUMNS
    )
    + " FROM f",
    "social",
)
def e08(t):
    cols = s.surface_columns(F.col("text"))
    base = t.social.select("doc_id", *[_rounded(c, cols[c]) for c in SURFACE_COLUMNS])
    scaled = standardise(stored(base, "surface"), SURFACE_COLUMNS)  # texts are read once, moments and rows come from the numbers
    return scaled.select("doc_id", *[F.round(c, 5).alias(c) for c in SURFACE_COLUMNS])
