"""Hand-made numeric features of one text."""

from pyspark.sql import Column, functions as F

from textsignal.functions.clean import WORD


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def cashtag_count(text: Column) -> Column:
    return count_matches(text, r"\$[A-Z]{1,5}")


def hashtag_count(text: Column) -> Column:
    return count_matches(text, rf"#{WORD}+")


def mention_count(text: Column) -> Column:
    return count_matches(text, rf"@{WORD}+")


def url_flag(text: Column) -> Column:
    return text.rlike("https?://").cast("int")


def url_count(text: Column) -> Column:
    return count_matches(text, r"(?U)https?://\S+")


def word_count(text: Column) -> Column:
    return count_matches(text, r"(?U)\S+")


def char_count(text: Column) -> Column:
    return F.length(text)


def mark_count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def caps_ratio(text: Column) -> Column:
    """Share of words whose cased characters are all upper case."""
    toks = F.regexp_extract_all(text, F.lit(r"(?U)(?<!\S)[^\sa-z]++(?!\S)"), F.lit(0))  # no other word can be
    caps = F.filter(toks, lambda w: (w == F.upper(w)) & (w != F.lower(w)))
    return F.size(caps) / F.greatest(word_count(text), F.lit(1))


def reading_ease(text: Column) -> Column:
    """Flesch score; a syllable is a vowel group, at least one per word.

    A vowel group lies inside a word, so those of the text are counted, and the words without one.
    """
    low = F.lower(text)
    n_words = F.greatest(word_count(low), F.lit(1))
    n_sent = F.greatest(count_matches(text, "[.!?]+"), F.lit(1))
    syllables = count_matches(low, "[aeiouy]+") + count_matches(low, r"(?U)(?<!\S)[^\saeiouy]++(?!\S)")
    return 206.835 - 1.015 * (n_words / n_sent) - 84.6 * (syllables / n_words)


def surface_columns(text: Column) -> dict[str, Column]:
    """The ten shuffle-free columns of the 14-column feature row."""
    return {
        "n_cashtags": cashtag_count(text),
        "n_hashtags": hashtag_count(text),
        "n_mentions": mention_count(text),
        "has_url": url_flag(text),
        "word_count": word_count(text),
        "char_count": char_count(text),
        "exclamation": mark_count(text, "!"),
        "question": mark_count(text, "?"),
        "all_caps_ratio": caps_ratio(text),
        "flesch_score": reading_ease(text),
    }
