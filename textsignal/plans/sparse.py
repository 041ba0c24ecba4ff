"""Registered queries: sparse text vectors."""

from pyspark.sql import functions as F

from textsignal.constants import STOP_WORDS
from textsignal.functions.clean import eda_clean, words
from textsignal.functions.hashing import uniform
from textsignal.operators import sparse as sp
from textsignal.plans.registry import query
from textsignal.plans.views import sql_uniform

# --- oracle pieces ------------------------------------------------------------------
TOKENS = "regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')"
UNI = f"toks AS (SELECT doc_id, unnest({TOKENS}) AS term FROM documents)"
BI = f"""flat AS (SELECT doc_id, unnest(ts) AS tok, generate_subscripts(ts, 1) AS pos FROM
            (SELECT doc_id, {TOKENS} AS ts FROM documents)),
  toks AS (SELECT doc_id, tok AS term FROM flat UNION ALL
           SELECT doc_id, tok || ' ' || nxt FROM
             (SELECT doc_id, tok, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM flat) WHERE nxt IS NOT NULL)"""
CHARS = """ws AS (SELECT doc_id, ' ' || w || ' ' AS w FROM (SELECT doc_id,
            unnest(string_split_regex(lower(text), '\\s+')) AS w FROM documents) WHERE w <> ''),
  wn AS (SELECT doc_id, w, count(*) AS n FROM ws GROUP BY ALL),
  grams AS (SELECT doc_id, n, substr(w, i, k) AS term FROM
             (SELECT doc_id, w, n, k, unnest(range(1, length(w) - k + 2)) AS i FROM wn, (VALUES (3), (4), (5)) t(k)
              WHERE length(w) >= k))"""
COUNTS = "counts AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL)"
CHAR_COUNTS = "counts AS (SELECT doc_id, term, CAST(sum(n) AS BIGINT) AS tf FROM grams GROUP BY ALL)"


def vocab(limit: int, min_df: int = 1, max_df: float = 1.0, total: str = "sum(tf)") -> str:
    return f"""nd AS (SELECT count(*) AS n FROM documents),
  vocab AS (SELECT term, df, CAST(total AS BIGINT) AS total, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM
            (SELECT term, count(*) AS df, {total} AS total FROM counts GROUP BY term), nd
            WHERE df >= {min_df} AND df <= n * {max_df}::DOUBLE ORDER BY total DESC, term LIMIT {limit})"""


WEIGHTS = """raw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM counts JOIN vocab USING (term)),
  weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
SUMMARY = "SELECT term, count(*) AS n_docs, round(sum(weight), 5) AS total_weight FROM weights GROUP BY term"


def _summary(weights):
    return weights.groupBy("term").agg(
        F.count(F.lit(1)).alias("n_docs"), F.round(F.sum("weight"), 5).alias("total_weight")
    )


@query("d01_ngrams", f"WITH {BI} SELECT term, count(*) AS n FROM toks GROUP BY term")
def d01(t):
    rows = t.documents.select(F.lower("text").alias("text"))
    return sp.term_sums(sp.TermRows(rows, "bigram", "doc_id")).select("term", F.col("total").alias("n"))


@query("d02_char_grams", f"WITH {CHARS} SELECT term, CAST(sum(n) AS BIGINT) AS n FROM grams GROUP BY term")
def d02(t):
    counted = t.documents.select(F.explode(words(F.lower("text"))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )
    return sp.char_gram_rows(counted, ["n"]).groupBy("term").agg(F.sum("n").alias("n"))


@query("d03_vocabulary", f"WITH {UNI}, {COUNTS}, {vocab(20000, 2, 0.8)} SELECT term, df, total, round(idf, 6) AS idf FROM vocab")
def d03(t):
    _, v = sp.fit_tfidf(t.documents, "unigram")
    return v.select("term", "df", "total", F.round("idf", 6).alias("idf"))


@query(
    "d04_bag_of_words",
    f"WITH {UNI}, {COUNTS}, {vocab(20000, 2, 1.0, 'count(*)')}"
    " SELECT doc_id, term, 1 AS present FROM counts SEMI JOIN vocab USING (term)",
)
def d04(t):
    counts, v = sp.fit_tfidf(t.documents, "binary")
    return sp.bag_of_words(counts, v)


@query(
    "d05_tfidf_unigram",
    f"WITH {UNI}, {COUNTS}, {vocab(20000, 2, 0.8)}, {WEIGHTS} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
)
def d05(t):
    counts, v = sp.fit_tfidf(t.documents, "unigram")
    return sp.tfidf(counts, v).withColumn("weight", F.round("weight", 6))


@query("d06_tfidf_bigram", f"WITH {BI}, {COUNTS}, {vocab(50000, 2, 0.8)}, {WEIGHTS} {SUMMARY}")
def d06(t):
    return _summary(sp.tfidf(*sp.fit_tfidf(t.documents, "bigram")))


@query("d07_tfidf_char", f"WITH {CHARS}, {CHAR_COUNTS}, {vocab(30000)}, {WEIGHTS} {SUMMARY}")
def d07(t):
    return _summary(sp.tfidf(*sp.fit_tfidf(t.documents, "char")))


@query("d08_tfidf_ablation", f"WITH {UNI}, {COUNTS}, {vocab(10000)}, {WEIGHTS} {SUMMARY}")
def d08(t):
    return _summary(sp.tfidf(*sp.fit_tfidf(t.documents, "ablation")))


U = sql_uniform("'split|'||doc_id")


@query(
    "d09_fit_transform_other",
    f"""WITH train AS (SELECT * FROM documents WHERE {U} < 0.8), test AS (SELECT * FROM documents WHERE {U} >= 0.8),
    {UNI.replace('FROM documents', 'FROM train')}, {COUNTS}, {vocab(20000, 2, 0.8).replace('FROM documents', 'FROM train')},
    other AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM test) GROUP BY ALL),
    raw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM other JOIN vocab USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def d09(t):
    u = uniform(F.lit("split"), F.col("doc_id"))
    train, test = t.documents.filter(u < 0.8), t.documents.filter(u >= 0.8)
    _, v = sp.fit_tfidf(train, "unigram")
    return sp.tfidf(sp.term_rows(test, "unigram"), v).withColumn("weight", F.round("weight", 6))


STOPS_SQL = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"
EDA_SQL = (
    "lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'https?://\\S+|www\\.\\S+', ' ', 'g'),"
    " '@[\\pL\\pN_]+', ' ', 'g'), '\\$([A-Za-z]{1,5})\\b', ' \\1 ', 'g'), '#([\\pL\\pN_]+)', ' \\1 ', 'g'))"
)


@query(
    "d10_top_terms",
    f"""
    WITH flat0 AS (SELECT doc_id, label, unnest(ts) AS tok, generate_subscripts(ts, 1) AS pos FROM
      (SELECT doc_id, label, regexp_extract_all({EDA_SQL}, '[\\pL\\pN_]+') AS ts FROM social_gold)),
    flat AS (SELECT * FROM flat0 WHERE regexp_full_match(tok, '[a-z]{{2,}}') AND tok NOT IN {STOPS_SQL}),
    toks AS (SELECT doc_id, label, tok AS term FROM flat UNION ALL SELECT doc_id, label, tok || ' ' || nxt FROM
      (SELECT *, lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM flat) WHERE nxt IS NOT NULL),
    counts AS (SELECT doc_id, label, term, count(*) AS tf FROM toks GROUP BY ALL),
    sizes AS (SELECT label, count(*) AS n FROM social_gold GROUP BY label),
    vocab AS (SELECT label, term, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM
      (SELECT *, row_number() OVER (PARTITION BY label ORDER BY total DESC, term) AS rn FROM
        (SELECT label, term, count(*) AS df, sum(tf) AS total FROM counts GROUP BY ALL) JOIN sizes USING (label)
        WHERE df <= n * 0.8::DOUBLE) WHERE rn <= 3000),
    raw AS (SELECT doc_id, label, term, tf * idf AS w FROM counts JOIN vocab USING (label, term)),
    scores AS (SELECT label, term, round(sum(u), 6) AS score FROM
      (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS u FROM raw) GROUP BY ALL)
    SELECT label, CAST(rank AS INTEGER) AS rank, term, score FROM
      (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, term) AS rank FROM scores) WHERE rank <= 12
    """,
    "social_gold",
)
def d10(t):
    base = t.social_gold.withColumn("text", eda_clean(F.col("text")))
    return sp.top_terms_per_class(base, STOP_WORDS)


@query(
    "d11_top_words",
    f"""
    SELECT label, word, n FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rn FROM
      (SELECT label, word, count(*) AS n FROM (SELECT label, unnest({TOKENS}) AS word FROM corpus) GROUP BY ALL))
    WHERE rn <= 80
    """,
    "corpus",
)
def d11(t):
    return sp.top_words_per_class(t.corpus)
