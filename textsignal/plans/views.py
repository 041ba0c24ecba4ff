"""Input views of the registered queries, derived from the given tables.

Every view exists twice: as a DataFrame and as a CTE for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textsignal.functions.hashing import uniform
from textsignal.operators.split import stratified_folds
from textsignal.sources.readers import read_table, spread

# Model -> skill of the derived probability tables.
SKILLS = {"a": 0.6, "b": 0.5, "c": 0.45, "d": 0.3}
N_FOLDS = 10


def sql_uniform(expr: str) -> str:
    return f"(cast(('0x'||substr(md5({expr}),1,8)) as ubigint)/4294967296.0)"


class Tables:
    """The given tables of one folder and the views derived from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path, name)

    @property
    def documents(self) -> DataFrame:
        return spread(self.read("documents"), "doc_id")

    @property
    def embeddings(self) -> DataFrame:
        return self.read("embeddings")

    @property
    def gold(self) -> DataFrame:
        label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 1).otherwise(2)
        return self.read("labels").select("doc_id", label.alias("label"))

    @property
    def corpus(self) -> DataFrame:
        return self.gold.join(self.documents.select("doc_id", "text"), "doc_id")

    @property
    def folds(self) -> DataFrame:
        return stratified_folds(self.gold, "doc_id", "label", N_FOLDS)

    def probabilities(self, base: DataFrame | None = None) -> DataFrame:
        """One row per document and model with normalised p0, p1, p2."""
        base = self.gold if base is None else base
        models = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("skill")) for m, s in SKILLS.items()])
        rows = base.select("*", F.inline(models))

        def raw(c: int) -> Column:
            hit = F.when(F.col("label") == c, F.col("skill")).otherwise(F.lit(0.0))
            return uniform(F.col("model"), F.col("doc_id"), c) + hit + F.lit(0.01)

        rows = rows.withColumns({f"u{c}": raw(c) for c in range(3)})
        total = F.col("u0") + F.col("u1") + F.col("u2")
        return rows.withColumns({f"p{c}": F.col(f"u{c}") / total for c in range(3)}).drop(
            "skill", "u0", "u1", "u2"
        )

    @property
    def probs(self) -> DataFrame:
        return self.probabilities()

    @property
    def social(self) -> DataFrame:
        """Whole documents with the noise of social posts around them."""
        i = F.col("doc_id")

        def every(n: int, piece: Column | str) -> Column:
            piece = F.lit(piece) if isinstance(piece, str) else piece
            return F.when(i % n == 0, piece).otherwise(F.lit(""))

        ticker = (
            F.when(i % 4 == 0, "AAPL").when(i % 4 == 1, "tsla").when(i % 4 == 2, "TOOLONG").otherwise("GE")
        )
        text = F.concat(
            every(3, F.concat(F.lit("@user"), i.cast("string"), F.lit(" "))),
            every(5, F.concat(F.lit("$"), ticker, F.lit(" "))),
            F.col("text"),
            every(7, " #earnings"),
            every(9, " Can’t stop WON'T stop"),
            every(11, " they don't"),
            every(17, " Pelotonâ€™s cafÃ© &amp; more"),
            every(19, " sooooooo GOOD!!!! ok?? :)"),
            every(2, F.concat(F.lit(" https://t.co/x"), i.cast("string"))),
            every(13, " …"),
        )
        return self.documents.select("doc_id", text.alias("text"))

    @property
    def social_gold(self) -> DataFrame:
        return self.gold.join(self.social, "doc_id")

    @property
    def split_a(self) -> DataFrame:
        return self.social.filter(uniform(F.lit("split"), F.col("doc_id")) < 0.8)

    @property
    def split_b(self) -> DataFrame:
        return self.social.filter(uniform(F.lit("split"), F.col("doc_id")) >= 0.8)

    @property
    def scores(self) -> DataFrame:
        """Per document: lexicon compound and the answers of two further tools."""
        p = self.probs.filter(F.col("model").isin("a", "b"))
        pick = lambda m, c: F.max(F.when(F.col("model") == m, F.col(f"p{c}")))
        wide = p.groupBy("doc_id", "label").agg(
            *[pick("b", c).alias(f"b{c}") for c in range(3)],
            *[pick("a", c).alias(f"e{c}") for c in range(3)],
        )
        compound = F.round(2 * uniform(F.lit("lex"), F.col("doc_id")) - 1, 4)
        return wide.withColumn("compound", compound)

    @property
    def lexicon(self) -> DataFrame:
        """Valences for about one in twenty tokens of the corpus vocabulary."""
        token = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0)))
        vocab = self.documents.select(token.alias("token")).distinct()
        return vocab.filter(uniform(F.lit("in"), F.col("token")) < 0.05).select(
            "token", F.round(8 * uniform(F.lit("val"), F.col("token")) - 4, 1).alias("valence")
        )

    @property
    def word_vectors(self) -> DataFrame:
        """Vectors for words: the n-th word in hash order of those found in at
        least three documents takes the n-th vector."""
        from textsignal.operators.joins import stored_side
        from textsignal.operators.split import distributed_rank
        from textsignal.operators.term_rows import TermRows, term_sums

        vocab = term_sums(TermRows(self.documents.select("text"), "word", "doc_id")).filter("df >= 3").select(F.col("term").alias("word"))
        vocab = stored_side(vocab, "words")  # ranks are made from two passes over the words
        ranked = distributed_rank(vocab, [], F.md5("word"), ["word"], "rank")
        vectors = self.embeddings.select((F.col("vec_id") + 1).alias("rank"), F.col("embedding").alias("vector"))
        return ranked.join(vectors, "rank").select("word", "vector")


VIEWS: dict[str, tuple[str, str]] = {
    "gold": (
        "",
        "SELECT doc_id, CASE WHEN toxic=1 THEN 0 WHEN quality=1 THEN 1 ELSE 2 END AS label FROM labels",
    ),
    "corpus": ("gold", "SELECT doc_id, label, text FROM gold JOIN documents USING (doc_id)"),
    "folds": (
        "gold",
        "SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('42|'||doc_id), doc_id) - 1)"
        f" % {N_FOLDS} AS INTEGER) AS fold FROM gold",
    ),
    "probs": (
        "gold",
        "SELECT doc_id, label, model, u0/(u0+u1+u2) AS p0, u1/(u0+u1+u2) AS p1, u2/(u0+u1+u2) AS p2 FROM ("
        "SELECT doc_id, label, model, "
        + ", ".join(
            sql_uniform(f"model||'|'||doc_id||'|{c}'")
            + f" + (CASE WHEN label={c} THEN skill ELSE 0.0::DOUBLE END) + 0.01::DOUBLE AS u{c}"
            for c in range(3)
        )
        + " FROM gold, (VALUES "
        + ", ".join(f"('{m}', {s}::DOUBLE)" for m, s in SKILLS.items())
        + ") AS s(model, skill)) t",
    ),
    "preds": (
        "probs",
        "SELECT *, CASE WHEN p0>=p1 AND p0>=p2 THEN 0 WHEN p1>=p2 THEN 1 ELSE 2 END AS pred,"
        " greatest(p0,p1,p2) AS conf FROM probs",
    ),
    "social": (
        "",
        """SELECT doc_id, concat(
            CASE WHEN doc_id%3=0 THEN '@user'||doc_id||' ' ELSE '' END,
            CASE WHEN doc_id%5=0 THEN '$'||(CASE doc_id%4 WHEN 0 THEN 'AAPL' WHEN 1 THEN 'tsla'
                 WHEN 2 THEN 'TOOLONG' ELSE 'GE' END)||' ' ELSE '' END,
            text,
            CASE WHEN doc_id%7=0 THEN ' #earnings' ELSE '' END,
            CASE WHEN doc_id%9=0 THEN ' Can’t stop WON''T stop' ELSE '' END,
            CASE WHEN doc_id%11=0 THEN ' they don''t' ELSE '' END,
            CASE WHEN doc_id%17=0 THEN ' Pelotonâ€™s cafÃ© &amp; more' ELSE '' END,
            CASE WHEN doc_id%19=0 THEN ' sooooooo GOOD!!!! ok?? :)' ELSE '' END,
            CASE WHEN doc_id%2=0 THEN ' https://t.co/x'||doc_id ELSE '' END,
            CASE WHEN doc_id%13=0 THEN ' …' ELSE '' END) AS text FROM documents""",
    ),
    "social_gold": ("gold social", "SELECT doc_id, label, text FROM gold JOIN social USING (doc_id)"),
    "fixed_enc": (
        "social",
        "SELECT doc_id, text, CASE WHEN contains(r,'<') THEN r ELSE"
        " replace(replace(replace(replace(replace(r,'&lt;','<'),'&gt;','>'),'&quot;','\"'),'&#39;',''''),'&amp;','&') END AS enc"
        " FROM (SELECT doc_id, text, translate(replace(replace(text,'â€™',''''),'Ã©','é'),"
        "'ʼ‘’‚‛“”„‟', '''''''''''\"\"\"\"') AS r FROM social)",
    ),
    "fixed": (
        "fixed_enc",
        "SELECT doc_id, text, trim(regexp_replace(regexp_replace(regexp_replace(enc,"
        " '[�…°]+\\s*(https?://\\S*)?$', ''), 'https?://\\S+', '', 'g'), '[\\s\\-–:]+$', ''),"
        " E' \\t\\n\\r') AS fixed FROM fixed_enc",
    ),
    "split_pair": (
        "fixed",
        "SELECT *, " + sql_uniform("'split|'||doc_id") + " < 0.8 AS in_a FROM fixed",
    ),
    "scores": (
        "probs",
        "SELECT a.doc_id, a.label, b.p0 AS b0, b.p1 AS b1, b.p2 AS b2, a.p0 AS e0, a.p1 AS e1, a.p2 AS e2, round(2*"
        + sql_uniform("'lex|'||a.doc_id")
        + "-1, 4) AS compound FROM probs a JOIN probs b ON a.doc_id=b.doc_id AND a.model='a' AND b.model='b'",
    ),
    "lexicon": (
        "",
        "SELECT token, round(8*" + sql_uniform("'val|'||token") + "-4, 1) AS valence FROM (SELECT DISTINCT"
        " unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS token FROM documents) WHERE "
        + sql_uniform("'in|'||token")
        + " < 0.05",
    ),
    "word_vectors": (
        "",
        "SELECT word, embedding AS vector FROM (SELECT word, row_number() OVER (ORDER BY md5(word), word) AS rank FROM ("
        "SELECT word, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, unnest(string_split_regex(text, '\\s+')) AS word"
        " FROM documents) WHERE word <> '' GROUP BY word) WHERE n >= 3) r JOIN embeddings ON vec_id + 1 = rank",
    ),
}


def with_views(body: str, *names: str) -> str:
    """Put the named views and what they need in front of ``body``."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][0].split():
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


