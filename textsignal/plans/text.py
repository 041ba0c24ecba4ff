"""Registered queries: cleaning and token operators."""

from pyspark.sql import functions as F

from textsignal.constants import KEPT_NEGATIONS, STOP_WORDS
from textsignal.functions import clean as c
from textsignal.operators.tokens import IRREGULAR_NOUNS, NOUN_ENDINGS, full_pipeline, lemmatize, noun_lemmas, stem_vocabulary
from textsignal.plans.registry import query


# --- oracle expressions -------------------------------------------------------------
def gsub(x: str, pattern: str, by: str) -> str:
    pattern, by = pattern.replace("'", "''"), by.replace("'", "''")
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def sql_tickers(x: str) -> str:
    gaps = f"string_split_regex({x}, '\\$[A-Za-z]{{1,5}}\\b')"
    hits = f"regexp_extract_all({x}, '\\$([A-Za-z]{{1,5}})\\b', 1)"
    pieces = f"list_transform(list_zip({gaps}, {hits}), lambda z: z[1] || coalesce(' TICKER_' || upper(z[2]) || ' ', ''))"
    return f"array_to_string({pieces}, '')"


def sql_clean_noise(x: str) -> str:
    x = gsub(x, r"https?://\S+|www\.\S+", " URL ")
    x = gsub(x, r"@[\pL\pN_]+", " USER ")
    x = gsub(sql_tickers(x), r"#([\pL\pN_]+)", r" \1 ")
    x = gsub(x, "&amp;|&lt;|&gt;", " ")
    return f"trim({gsub(x, chr(92) + 's+', ' ')})"


def sql_expand(x: str) -> str:
    for pattern, by in [("won't", "will not"), ("can't", "can not"), ("n't", " not")]:
        x = gsub(x, f"(?i){pattern}", by)
    return x


def sql_ascii(x: str) -> str:
    """Latin subset: accents stripped, the two compatibility signs of the view spelled out."""
    x = f"replace(replace({x}, '…', '...'), '™', 'TM')"
    return f"lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"


def sql_cap_runs(x: str) -> str:
    chars = "abcdefghijklmnopqrstuvwxyz0123456789_éèêàçùñáíóúüöäß"
    for ch in chars:
        x = f"regexp_replace({x}, '{ch}{{4,}}', '{ch * 3}', 'g')"
    for ch in r"""!"#$%&()*+,-./:;<=>?@[]^{|}~""":
        x = f"regexp_replace({x}, '\\{ch}{{4,}}', '{ch * 3}', 'g')"
    return x


SQL_TOKEN = c.TOKEN.replace("'", "''")


def sql_tokens(x: str) -> str:
    x = f"regexp_replace(lower({x}), '(^|[^\\w@#$%*&])@\\w{{1,20}}([^\\w]|$)', '\\1 \\2', 'g')"
    return f"regexp_extract_all({sql_cap_runs(x)}, '{SQL_TOKEN}')"


def sql_wordlike(x: str) -> str:
    return f"list_filter({x}, lambda t: length(t) > 1 AND regexp_matches(t, '^[a-z_]'))"


SQL_STOPS = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS if w not in KEPT_NEGATIONS) + "]"


def sql_unstopped(x: str) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({SQL_STOPS}, t))"


SQL_NORM = sql_ascii(sql_expand("translate({x}, '‘’', '''''')"))
SQL_PIPELINE = sql_unstopped(sql_wordlike(sql_tokens(SQL_NORM.replace("{x}", sql_clean_noise("text")))))

# --- one query per scalar operator ----------------------------------------------------
SCALAR = {
    "b01_urls": (c.mark_urls, gsub("text", r"https?://\S+|www\.\S+", " URL ")),
    "b02_mentions": (c.mark_mentions, gsub("text", r"@[\pL\pN_]+", " USER ")),
    "b03_cashtags": (c.mark_cashtags, sql_tickers("text")),
    "b04_hashtags": (c.unwrap_hashtags, gsub("text", r"#([\pL\pN_]+)", r" \1 ")),
    "b05_entities": (c.drop_entities, gsub("text", "&amp;|&lt;|&gt;", " ")),
    "b06_spaces": (c.squeeze_spaces, f"trim({gsub('text', chr(92) + 's+', ' ')})"),
    "b07_clean_noise": (c.clean_noise, sql_clean_noise("text")),
    "b08_apostrophes": (c.straighten_apostrophes, "translate(text, '‘’', '''''')"),
    "b09_contractions": (c.expand_contractions, sql_expand("text")),
    "b10_fold_ascii": (c.fold_ascii, sql_ascii("text")),
    "b11_tokenize": (lambda t: F.array_join(c.tokenize(t), " "), f"array_to_string({sql_tokens('text')}, ' ')"),
    "b12_wordlike": (
        lambda t: F.array_join(c.keep_wordlike(c.tokenize(t)), " "),
        f"array_to_string({sql_wordlike(sql_tokens('text'))}, ' ')",
    ),
    "b13_stop_words": (
        lambda t: F.array_join(c.remove_stop_words(c.words(F.lower(t))), " "),
        "array_to_string("
        + sql_unstopped("list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '')")
        + ", ' ')",
    ),
    "b18_truncation": (c.strip_truncation, "regexp_replace(text, '[�…°]+\\s*(https?://\\S*)?$', '')"),
    "b19_bare_urls": (c.drop_bare_urls, gsub("text", r"https?://\S+", "")),
    "b20_trailing": (c.strip_trailing, "trim(regexp_replace(text, '[\\s\\-–:]+$', ''), E' \\t\\n\\r')"),
    "b24_eda_clean": (
        c.eda_clean,
        "lower("
        + gsub(
            gsub(
                gsub(gsub("text", r"https?://\S+|www\.\S+", " "), r"@[\pL\pN_]+", " "),
                r"\$([A-Za-z]{1,5})\b",
                r" \1 ",
            ),
            r"#([\pL\pN_]+)",
            r" \1 ",
        )
        + ")",
    ),
    "b27_preview": (lambda t: c.preview(t, 70), "substr(text, 1, 70)"),
}


def _scalar(name, fn, sql):
    @query(name, f"SELECT doc_id, {sql} AS out FROM social", "social")
    def run(t):
        return t.social.select("doc_id", fn(F.col("text")).alias("out"))


for _name, (_fn, _sql) in SCALAR.items():
    _scalar(_name, _fn, _sql)


@query(
    "b14_lemmatize",
    """
    WITH toks AS (
      SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '') AS ts FROM documents),
    flat AS (SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM toks),
    vocab AS (SELECT DISTINCT token FROM flat),
    dict AS (
      SELECT v.token, b.token AS lemma FROM vocab v JOIN vocab b ON b.token || 's' = v.token
      WHERE length(v.token) > 3)
    SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS out
    FROM flat LEFT JOIN dict USING (token) GROUP BY doc_id
    """,
)
def b14(t):
    """Dictionary from the corpus itself: plurals whose singular also occurs."""
    toks = t.documents.select("doc_id", c.words(F.lower("text")).alias("tokens"))
    vocab = toks.select(F.explode("tokens").alias("token")).distinct()
    plural = vocab.filter((F.length("token") > 3) & F.col("token").endswith("s")).withColumn(
        "lemma", F.expr("substring(token, 1, length(token) - 1)")
    )
    dictionary = plural.join(vocab.select(F.col("token").alias("lemma")), "lemma", "left_semi")
    out = lemmatize(toks, "doc_id", "tokens", dictionary)
    return out.select("doc_id", F.array_join("tokens", " ").alias("out"))


SQL_ENDINGS = ", ".join(f"('{end}', '{to}')" for end, to in NOUN_ENDINGS)
SQL_IRREGULAR = ", ".join(f"('{token}', '{lemma}')" for token, lemma in IRREGULAR_NOUNS.items())


@query(
    "b14_noun_lemmas",
    f"""
    WITH toks AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '') AS ts FROM documents),
    flat AS (SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) AS pos FROM toks),
    vocab AS (SELECT DISTINCT token FROM flat),
    irregular(token, lemma) AS (VALUES {SQL_IRREGULAR}),
    forms AS (SELECT token, token AS lemma FROM vocab UNION
      SELECT token, left(token, length(token) - length(e)) || r FROM vocab, (VALUES {SQL_ENDINGS}) AS x(e, r) WHERE ends_with(token, e)),
    best AS (SELECT token, min((length(lemma), lemma)) AS b FROM forms WHERE lemma IN (SELECT token FROM vocab)
      AND token NOT IN (SELECT token FROM irregular) GROUP BY token),
    dict AS (SELECT token, b[2] AS lemma FROM best UNION ALL SELECT token, lemma FROM irregular)
    SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS out FROM flat LEFT JOIN dict USING (token) GROUP BY doc_id
    """,
)
def b14n(t):
    """Plural nouns by their base form, wherever the corpus knows it."""
    toks = t.documents.select("doc_id", c.words(F.lower("text")).alias("tokens"))
    lemmas = noun_lemmas(toks.select(F.explode("tokens").alias("token")))
    return lemmatize(toks, "doc_id", "tokens", lemmas).select("doc_id", F.array_join("tokens", " ").alias("out"))


@query("b15_stem")
def b15(t):
    toks = t.social.select(c.pipeline_tokens(F.col("text")).alias("tokens"))
    return stem_vocabulary(toks, "tokens").select("token", F.col("target").alias("stem"))


@query("b16_full_clean", f"SELECT doc_id, array_to_string({SQL_PIPELINE}, ' ') AS clean FROM social", "social")
def b16(t):
    return full_pipeline(t.social, use_lemmatize=False)


@query("b16_full_clean_stemmed")
def b16s(t):
    return full_pipeline(t.social, use_stem=True)


@query(
    "b17_clean_column",
    f"SELECT conv_id, turn, array_to_string({SQL_PIPELINE}, ' ') AS clean FROM conversations",
)
def b17(t):
    return t.read("conversations").select(
        "conv_id", "turn", F.array_join(c.pipeline_tokens(F.col("text")), " ").alias("clean")
    )


@query("b21_repair", "SELECT doc_id, enc AS out FROM fixed_enc", "fixed_enc")
def b21(t):
    return t.social.select("doc_id", c.fix_encoding(F.col("text")).alias("out"))


@query("b22_fix_text", "SELECT doc_id, fixed AS out FROM fixed", "fixed")
def b22(t):
    return t.social.select("doc_id", c.fix_text(F.col("text")).alias("out"))


@query("b23_has_misread", "SELECT doc_id, (enc <> text OR contains(text, '�')) AS bad FROM fixed_enc", "fixed_enc")
def b23(t):
    return t.social.select("doc_id", c.has_misread(F.col("text")).alias("bad"))


@query(
    "b25_cashtag_variants",
    "SELECT doc_id, text AS intact, "
    + gsub("text", r"\$[A-Za-z]{1,5}\b", "TICKER")
    + " AS generic, "
    + gsub("text", r"\$[A-Za-z]{1,5}\b", "")
    + " AS removed FROM social",
    "social",
)
def b25(t):
    return t.social.select(
        "doc_id", *[c.cashtag_variant(F.col("text"), m).alias(m) for m in ("intact", "generic", "removed")]
    )


@query("b26_near_duplicate_key", "SELECT doc_id, lower(fixed) AS out FROM fixed", "fixed")
def b26(t):
    return t.social.select("doc_id", c.near_duplicate_key(F.col("text")).alias("out"))


@query(
    "b28_words",
    "SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_words, array_to_string(ws, '|') AS out FROM (SELECT doc_id,"
    " list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '') AS ws FROM social)",
    "social",
)
def b28(t):
    return t.social.select("doc_id", c.words(F.col("text")).alias("ws")).select(
        "doc_id", F.size("ws").alias("n_words"), F.array_join("ws", "|").alias("out")
    )
