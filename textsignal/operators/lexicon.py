"""Lexicon sentiment: pos, neg, neu shares and a compound score in [-1, 1].

Published rules (Hutto & Gilbert 2014): valence per token, boosters and
negations in the three tokens before, capitals, "but", punctuation emphasis.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textsignal.constants import LEXICON_CUT
from textsignal.functions.clean import words
from textsignal.functions.surface import mark_count
from textsignal.operators.joins import stored_side

# --- fixed values: published constants --------------------------------------------------
BOOST, CAPS_BOOST, NEGATE_BY, NORM = 0.293, 0.733, -0.74, 15.0
DAMPING = [1.0, 0.95, 0.9]
BUT_BEFORE, BUT_AFTER = 0.5, 1.5

# --- fixed values: booster and negation words -------------------------------------------
UP = (
    "absolutely amazingly awfully completely considerably decidedly deeply enormously entirely "
    "especially exceptionally extremely fully greatly highly hugely incredibly intensely majorly "
    "more most particularly purely quite really remarkably so substantially thoroughly totally "
    "tremendously unbelievably unusually utterly very"
).split()
DOWN = "almost barely hardly kinda less little marginally occasionally partly scarcely slightly somewhat sorta".split()
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt neednt never "
    "none nope nor not nothing nowhere oughtnt shant shouldnt wasnt werent without wont wouldnt "
    "rarely seldom despite"
).split()

# --- fixed values: small default lexicon -------------------------------------------------
DEFAULT_LEXICON = {
    "amazing": 2.8, "awful": -2.0, "bad": -2.5, "bankrupt": -2.6, "bearish": -1.8, "beat": 1.2,
    "beats": 1.3, "best": 3.2, "better": 1.9, "boom": 1.6, "boost": 1.7, "breakout": 1.4,
    "bullish": 1.8, "bust": -1.7, "buy": 0.8, "concern": -1.2, "crash": -2.4, "crisis": -2.5,
    "cut": -1.1, "decline": -1.4, "default": -1.8, "downgrade": -1.6, "downgrades": -1.6,
    "drop": -1.3, "excellent": 2.7, "fail": -2.5, "fall": -1.2, "fear": -2.2, "fraud": -2.8,
    "gain": 1.7, "gains": 1.7, "good": 1.9, "great": 3.1, "grow": 1.2, "growth": 1.4, "happy": 2.7,
    "hate": -2.7, "high": 0.8, "hurt": -2.0, "improve": 1.9, "jump": 1.1, "layoffs": -1.9,
    "lawsuit": -1.4, "lose": -1.7, "loss": -1.7, "losses": -1.9, "love": 3.2, "low": -0.9,
    "miss": -0.9, "misses": -1.2, "outperform": 1.8, "panic": -2.3, "plunge": -2.0, "poor": -2.1,
    "positive": 2.1, "profit": 1.9, "profits": 1.9, "raise": 0.9, "raised": 0.9, "rally": 1.5,
    "recession": -2.0, "record": 0.9, "risk": -1.1, "rise": 1.0, "sell": -0.8, "selloff": -1.8,
    "slump": -1.8, "soar": 2.0, "soars": 2.0, "strong": 2.3, "surge": 1.7, "tank": -1.6,
    "terrible": -2.1, "tumble": -1.6, "underperform": -1.7, "up": 0.4, "upgrade": 1.6,
    "upgrades": 1.6, "warn": -1.4, "warning": -1.4, "weak": -1.9, "win": 2.8, "worst": -3.1,
}


def default_lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DEFAULT_LEXICON.items()), "token string, valence double")


def _is_negation(t: Column) -> Column:
    return F.coalesce(t.isin(NEGATIONS) | t.endswith("n't"), F.lit(False))


def _boost(t: Column) -> Column:
    return F.when(t.isin(UP), F.lit(BOOST)).when(t.isin(DOWN), F.lit(-BOOST)).otherwise(F.lit(0.0))


def bare_tokens(text: Column) -> Column:
    """White-space tokens without surrounding signs; short ones (emoticons) stay whole."""

    def bare(w: Column) -> Column:
        core = F.regexp_replace(w, r"^[\p{P}\p{S}]+|[\p{P}\p{S}]+$", "")
        return F.when(F.length(core) > 2, core).otherwise(w)

    return F.transform(words(text), bare)


def token_context(toks: Column, low: Column) -> Column:
    """Each token with its three predecessors, so no window is needed.

    ``toks`` and ``low`` (lower-cased) must be columns, not expressions: they are
    looked up once per token.
    """

    def look(t: Column, i: Column) -> Column:
        back = [F.get(low, i - d).alias(f"prev{d}") for d in (1, 2, 3)]
        caps = (t == F.upper(t)) & (t != F.lower(t))
        return F.struct(F.lower(t).alias("token"), caps.alias("caps"), i.alias("pos"), *back)

    return F.transform(toks, look)


def lexicon_scores(df: DataFrame, lexicon: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lex_pos, lex_neg, lex_neu, lex_compound)`` for every row.

    The context of a token travels with it, so tokens are never sorted: they meet
    the (size-checked) lexicon and are summed per row, partially before the shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    bang = F.least(mark_count(text, "!"), F.lit(4))
    ask = mark_count(text, "?")
    emphasis = bang * 0.292 + F.when(ask > 3, 0.96).when(ask > 1, ask * 0.18).otherwise(0.0)
    rows = df.select(id_col, bare_tokens(text).alias("_bare"), emphasis.alias("_emph"))
    rows = rows.withColumn("_low", F.transform("_bare", F.lower))
    rows = rows.withColumn("_toks", token_context(F.col("_bare"), F.col("_low")))
    n_caps = F.size(F.filter("_toks", lambda t: t["caps"]))
    rows = rows.select(
        id_col,
        "_toks",
        "_emph",
        ((n_caps > 0) & (n_caps < F.size("_toks"))).alias("_mixed"),
        F.array_position("_low", "but").alias("_but"),
    )
    tokens = rows.select(id_col, "_mixed", "_but", "_emph", F.inline_outer("_toks"))
    hits = tokens.join(stored_side(lexicon), "token", "left")
    sign = F.signum("valence")
    v = F.col("valence") + F.when(F.col("_mixed") & F.col("caps"), sign * CAPS_BOOST).otherwise(0.0)
    for d in (1, 2, 3):
        v = v + sign * _boost(F.col(f"prev{d}")) * DAMPING[d - 1]
    for d in (1, 2, 3):
        v = v * F.when(_is_negation(F.col(f"prev{d}")), NEGATE_BY).otherwise(1.0)
    at = F.col("pos") + 1
    v = v * F.when((F.col("_but") > 0) & (at < F.col("_but")), BUT_BEFORE).when(
        (F.col("_but") > 0) & (at > F.col("_but")), BUT_AFTER
    ).otherwise(1.0)
    scored = hits.select(id_col, "_emph", "token", F.coalesce(v, F.lit(0.0)).alias("_v"))
    sums = scored.groupBy(id_col).agg(
        F.max("_emph").alias("_emph"),
        F.sum("_v").alias("_sum"),
        F.sum(F.when(F.col("_v") > 0, F.col("_v") + 1).otherwise(0.0)).alias("_pos"),
        F.sum(F.when(F.col("_v") < 0, 1 - F.col("_v")).otherwise(0.0)).alias("_neg"),
        F.count_if((F.col("_v") == 0) & F.col("token").isNotNull()).alias("_neu"),
    )
    total_v = F.col("_sum") + F.signum(F.round("_sum", 9)) * F.col("_emph")
    pos = F.col("_pos") + F.when(F.round(F.col("_pos") - F.col("_neg"), 9) > 0, F.col("_emph")).otherwise(0.0)
    neg = F.col("_neg") + F.when(F.round(F.col("_pos") - F.col("_neg"), 9) < 0, F.col("_emph")).otherwise(0.0)
    total = pos + neg + F.col("_neu")
    share = lambda x: F.when(total > 0, F.round(x / total, 3)).otherwise(F.lit(0.0))
    return sums.select(
        id_col,
        share(pos).alias("lex_pos"),
        share(neg).alias("lex_neg"),
        share(F.col("_neu")).alias("lex_neu"),
        F.round(total_v / F.sqrt(total_v * total_v + NORM), 4).alias("lex_compound"),
    )


def lexicon_class(compound: Column, strict: bool = False) -> Column:
    """Class of a compound score; the cut-offs are inclusive unless ``strict``."""
    up = compound > LEXICON_CUT if strict else compound >= LEXICON_CUT
    down = compound < -LEXICON_CUT if strict else compound <= -LEXICON_CUT
    return F.when(up, 1).when(down, 0).otherwise(2)
