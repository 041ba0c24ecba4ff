r"""Cleaning and tokenising of noisy short text as column expressions.

``\w`` of the source semantics means "any Unicode letter, digit or underscore";
it is written out as ``[\p{L}\p{N}_]``, and ``(?U)`` makes ``\s`` Unicode-aware.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from textsignal.constants import KEPT_NEGATIONS, STOP_WORDS

WORD = r"[\p{L}\p{N}_]"
URL = r"(?U)https?://\S+|www\.\S+"
BARE_URL = r"(?U)https?://\S+"
MENTION = rf"@{WORD}+"
CASHTAG = rf"\$([A-Za-z]{{1,5}})(?!{WORD})"
HASHTAG = rf"#({WORD}+)"


def rewrite_matches(text: Column, pattern: str, group: int, make: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``make(group)``.

    The regex engine has no call-back in replacements, so the text is split at
    the matches and woven together again with the rewritten groups.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), make)
    woven = F.array_join(F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(h, F.lit("")))), "")
    return F.when(text.rlike(pattern), woven).otherwise(text)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


# --- social-noise rewriting ---------------------------------------------------------
def mark_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " URL ")


def mark_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, " USER ")


def mark_cashtags(text: Column) -> Column:
    return rewrite_matches(text, CASHTAG, 1, lambda t: F.concat(F.lit(" TICKER_"), F.upper(t), F.lit(" ")))


def unwrap_hashtags(text: Column) -> Column:
    return F.regexp_replace(text, HASHTAG, r" $1 ")


def drop_entities(text: Column) -> Column:
    return F.regexp_replace(text, "&amp;|&lt;|&gt;", " ")


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_noise(text: Column) -> Column:
    """URLs, mentions, cashtags, hashtags, entities and spaces, in this order."""
    for step in (mark_urls, mark_mentions, mark_cashtags, unwrap_hashtags, drop_entities, squeeze_spaces):
        text = step(text)
    return text


# --- normalising --------------------------------------------------------------------
def straighten_apostrophes(text: Column) -> Column:
    return F.translate(text, "\u2018\u2019", "''")


def expand_contractions(text: Column) -> Column:
    text = F.regexp_replace(text, "(?i)won't", "will not")
    text = F.regexp_replace(text, "(?i)can't", "can not")
    return F.regexp_replace(text, "(?i)n't", " not")


@F.pandas_udf(StringType())
def _decompose_ascii(values: pd.Series) -> pd.Series:
    return values.map(
        lambda s: s if s.isascii() else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii"),
        na_action="ignore",
    )


def fold_ascii(text: Column) -> Column:
    """Compatibility decomposition, non-ASCII dropped, lower-cased.

    Every row's text goes through Arrow: whatever ``text`` is made of is then computed once, while a choice between
    the text and its decomposition would compute it anew in each branch.
    """
    return F.lower(_decompose_ascii(text))


def normalize_text(text: Column) -> Column:
    return fold_ascii(expand_contractions(straighten_apostrophes(text)))


# --- tokens -------------------------------------------------------------------------
# One alternation, longest forms first: links, emoticons, markup, hashtags, words with
# inner apostrophe or dash, numbers with separators, plain words, dots, any other sign.
TOKEN = "|".join(
    [
        r"https?://\S+",
        r"[<>]?[:;=8][\-o*']?[)\](\[dDpP/\\:}{@|]",
        r"<[^>\s]+>",
        r"#[\p{L}\p{N}_'\-]*[\p{L}\p{N}_]",
        r"\p{L}[\p{L}'\-_]+\p{L}",
        r"[+\-]?\d+[,/.:\-]\d+[+\-]?",
        r"[\p{L}\p{N}_]+",
        r"\.(?:\s*\.)+",
        r"\S",
    ]
)


def tokenize(text: Column) -> Column:
    """Lower-case tokens; runs of a character are capped at three, handles are dropped."""
    low = F.lower(text)
    low = F.regexp_replace(low, r"(?<![\w@#$%*&])@\w{1,20}(?!\w)", " ")
    low = F.regexp_replace(low, r"(.)\1{2,}", "$1$1$1")
    return F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0))


def keep_wordlike(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: (F.length(t) > 1) & t.rlike("^[a-z_]"))


def remove_stop_words(tokens: Column, stop_words: list[str] | None = None) -> Column:
    """Drop stop words but keep negations; order and repeats stay."""
    stops = STOP_WORDS if stop_words is None else stop_words
    drop = [w for w in stops if w not in KEPT_NEGATIONS]
    return F.filter(tokens, lambda t: ~t.isin(drop))


def pipeline_tokens(text: Column) -> Column:
    """Clean, normalise, tokenise and filter; null or blank text gives no token."""
    safe = F.coalesce(text, F.lit(""))
    return remove_stop_words(keep_wordlike(tokenize(normalize_text(clean_noise(safe)))))


# --- truncation marks, links, encoding repair ---------------------------------------
TRUNCATION = "[\ufffd\u2026\u00b0]+(?U:\\s)*(https?://(?U:\\S)*)?(?=\\n?\\z)"
TRAILING = r"(?U)[\s\-\u2013:]+(?=\n?\z)"


def strip_truncation(text: Column) -> Column:
    return F.regexp_replace(text, TRUNCATION, "")


def drop_bare_urls(text: Column) -> Column:
    return F.regexp_replace(text, BARE_URL, "")


def strip_trailing(text: Column) -> Column:
    return strip(F.regexp_replace(text, TRAILING, ""))


# Characters that code page 1252 shows for the bytes 0x80-0x9F, by rule from the codec.
_CP1252 = {
    bytes([b]).decode("cp1252"): chr(b)
    for b in range(0x80, 0xA0)
    if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}
_SEEN, _BYTES = "".join(_CP1252), "".join(_CP1252.values())
_CONT = f"[\u0080-\u00bf{_SEEN}]"
MISREAD = f"[\u00c2\u00c3]{_CONT}|[\u00e2\u00ef]{_CONT}{{2}}|\u00f0{_CONT}{{3}}"


def repair_encoding(text: Column) -> Column:
    """UTF-8 sequences that were read as a Western code page are decoded in place.

    Repairs Latin letters, typographic signs and emoji; other text is untouched.
    """

    def decode(seq: Column) -> Column:
        raw = F.encode(F.translate(seq, _SEEN, _BYTES), "ISO-8859-1")
        return F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(seq)

    return rewrite_matches(text, MISREAD, 0, decode)


def fix_encoding(text: Column) -> Column:
    """Encoding repair, straight quotes, and entities where the text holds no markup."""
    text = F.translate(
        repair_encoding(text),
        "\u02bc\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f",
        "'''''\"\"\"\"",
    )
    plain = text
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(text.contains("<"), text).otherwise(plain)


def fix_text(text: Column) -> Column:
    """Encoding, then truncation marks, then bare links, then trailing signs."""
    return strip_trailing(drop_bare_urls(strip_truncation(fix_encoding(text))))


def has_misread(text: Column) -> Column:
    """True where repair changes the text or a replacement character is present."""
    return (fix_encoding(text) != text) | text.contains("\ufffd")


# --- audit variants -----------------------------------------------------------------
def eda_clean(text: Column) -> Column:
    text = F.regexp_replace(text, URL, " ")
    text = F.regexp_replace(text, MENTION, " ")
    text = F.regexp_replace(text, CASHTAG, r" $1 ")
    return F.lower(F.regexp_replace(text, HASHTAG, r" $1 "))


def cashtag_variant(text: Column, mode: str) -> Column:
    """``intact``, ``generic`` (one shared token) or ``removed``."""
    if mode == "intact":
        return text
    if mode not in ("generic", "removed"):
        raise ValueError(f"unknown cashtag mode {mode!r}")
    return F.regexp_replace(text, CASHTAG, "TICKER" if mode == "generic" else "")


def near_duplicate_key(text: Column) -> Column:
    return F.lower(fix_text(text))


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def words(text: Column) -> Column:
    """White-space tokens; an empty text has none."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def each(df: DataFrame, tokens: Column, name: str, *keep: str) -> DataFrame:
    """``(keep, name)``: a row for each token of a list without nulls.

    A plain explode is preceded by a filter for lists that are not empty, which makes every list a second time.
    """
    return df.select(*keep, F.explode_outer(tokens).alias(name)).filter(F.col(name).isNotNull())
