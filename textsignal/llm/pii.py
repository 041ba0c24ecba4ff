"""Personal data: fixed patterns, and terms that the corpus shows to disclose them.  DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import store

# Kinds in reporting order and their patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# The same matches in linear time and constant stack: possessive repeats, and no restart inside a run that has failed.
# After a match (\G) a search may begin inside a run.
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
BYTE_PART = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
TERM = r"\p{L}+"

SUPPORT = 3  # distinct texts in which a term must stand with an entity
SHARE = 0.9  # of an entity's information content, which a term may not reveal

SPAN = "struct<start:bigint,end:bigint,value:string>"


def spans_of(text: Column, pattern: str | Column) -> Column:
    """Array of (start, end, value), in code points, of the leftmost non-overlapping matches.

    The gaps between the matches and the matches themselves add up to the positions.
    """
    both = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        F.split(text, F.lit(pattern), -1),
        lambda value, gap: F.struct(value.alias("value"), gap.alias("gap")),
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    found = F.filter(both, lambda x: x["value"].isNotNull())
    return F.when(F.rlike(text, F.lit(pattern)), F.aggregate(found, first, step, lambda acc: acc["out"])).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    number = digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(BYTE_PART))
    if kind == "card":
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(number).between(10, 15)
    return F.lit(True)


def _tested(spans: Column, rank: int, kind: str) -> Column:
    """Spans that pass the kind's test, with rank, kind and entity."""
    name = F.lower if kind == "email" else digits if kind in ("card", "phone") else lambda value: value

    def described(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
            F.xxhash64(F.lit(kind), name(s["value"])).alias("entity"),
        )

    return F.transform(F.filter(spans, lambda s: valid(kind, s["value"])), described)


def base_spans(text: Column) -> Column:
    """Array of (start, rank, kind, end, entity) by start, then kind as listed; ``entity`` stands for the value."""
    found = []
    for rank, kind in enumerate(PATTERNS):
        spans = spans_of(text, LINEAR[kind])
        if NEEDS[kind]:
            spans = F.when(F.contains(text, F.lit(NEEDS[kind])), spans).otherwise(F.array().cast(f"array<{SPAN}>"))
        found.append(_tested(spans, rank, kind))
    return F.array_sort(F.concat(*found))


def blanked(text: Column, base: Column) -> Column:
    """The text with base spans as spaces, so that positions stay: its letter runs are the terms."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        spaces = F.repeat(F.lit(" "), (s["end"] - F.greatest(acc["at"], s["start"])).cast("int"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap, spaces).alias("out"))
        return F.when(s["end"] > acc["at"], longer).otherwise(acc)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(base, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(base) > 0, rest).otherwise(text)


def term_hash(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def terms_of(text: Column) -> Column:
    """Distinct hashes of the terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), term_hash))


def found_entities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, base, text) per row; the text only where it has an entity."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text")).withColumn("base", base_spans(F.col("text")))
    return rows.select("id", "text_key", "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))


def reveals(n_both: Column, n_entity: Column, n_term: Column, n_all: int, share: float) -> Column:
    """Does the pointwise mutual information log2(n(e, t) N / (n(e) n(t))) reach ``share`` of the information content log2(N / n(e))?"""
    content = F.log2(F.lit(float(n_all)) / n_entity)
    return (content > 0) & (F.log2(n_both * float(n_all) / (n_entity * n_term)) >= share * content)


def disclosing_terms(docs: DataFrame, text_col: str, found: DataFrame, support: int, share: float) -> DataFrame:
    """(text_key, bad): for texts with entities, the hashes of terms that reveal over ``share`` of one of them.

    Counts are of distinct whole texts over all documents, so copies prove nothing: N of all, n(e) with the entity, n(t)
    with the term, n(e, t) with both, however far apart.  They are pruned before they are counted: an entity in fewer
    than ``support`` texts has no pair; n(t) is at least the number of texts with entities that have the term, and a
    pair that fails with this bound in place of n(t) fails with n(t).  So common words are gone before
    documents without entities are asked for the few terms left.
    """
    n_all = found.select("text_key").distinct().count()
    entities = F.array_distinct(F.transform("base", lambda s: s["entity"]))
    held = found.filter("text IS NOT NULL").select("text_key", entities.alias("entities"), terms_of(blanked(F.col("text"), F.col("base"))).alias("terms"))
    texts = held.groupBy("text_key").agg(F.first("entities").alias("entities"), F.first("terms").alias("terms"))
    texts = store(texts, "entity-texts")
    frequent = texts.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    frequent = store(frequent.filter(F.col("n_entity") >= support), "frequent-entities")
    at_least = texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_least"))
    at_least = at_least.filter(F.col("n_least") >= support)
    with_entity = texts.select("text_key", F.explode("entities").alias("entity"), "terms").join(frequent, "entity")
    pairs = with_entity.select("text_key", "entity", "n_entity", F.explode("terms").alias("term")).join(at_least, "term")
    most = F.least("n_entity", "n_least")  # texts with both, at most
    pairs = store(pairs.filter(reveals(most, F.col("n_entity"), F.col("n_least"), n_all, share)), "pairs")
    joint = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_least").alias("n_least"))
    joint = joint.filter((F.col("n_both") >= support) & reveals(F.col("n_both"), F.col("n_entity"), F.col("n_least"), n_all, share))
    joint = store(joint, "term-entity")
    known = store(joint.select("term").distinct(), "known-terms")
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = docs.select(F.xxhash64(text).alias("text_key"), F.explode(terms_of(text)).alias("term"))
    elsewhere = words.join(known, "term", "left_semi").distinct().join(texts.select("text_key"), "text_key", "left_anti")
    elsewhere = elsewhere.groupBy("term").agg(F.count(F.lit(1)).alias("n_more"))
    n_term = F.col("n_least") + F.coalesce("n_more", F.lit(0))
    bad = joint.join(elsewhere, "term", "left").filter(reveals(F.col("n_both"), F.col("n_entity"), n_term, n_all, share))
    bad = bad.select("entity", "term")
    return pairs.join(bad, ["entity", "term"]).groupBy("text_key").agg(F.collect_set("term").alias("bad"))


def term_spans(text: Column, base: Column, bad: Column) -> Column:
    """Spans of all occurrences of the ``bad`` terms outside base spans, in the form of ``base_spans``."""
    rest = blanked(text, base)
    forms = F.array_distinct(F.filter(F.regexp_extract_all(rest, F.lit(TERM), F.lit(0)), lambda w: F.array_contains(bad, term_hash(w))))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(forms, "|"), F.lit(r")(?!\p{L})"))  # letters only: nothing to escape
    return F.transform(
        spans_of(rest, pattern),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), F.lit("term").alias("kind"), s["end"].alias("end"), F.lit(0).cast("long").alias("entity")
        ),
    )


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, share: float = SHARE
) -> DataFrame:
    """(id, text_key, spans) per row: (start, rank, kind, end, entity) of base spans and disclosing terms.

    Base spans are leftmost non-overlapping matches per kind that pass the kind's test.  Terms (letter runs of any
    length outside base spans, in lower case) that corpus co-occurrence shows to disclose an entity are added wherever
    they stand in a text with that entity, as kind ``term``.  ``text_key`` is a hash of the text; together with the
    id it finds the row again.

    Texts are scanned where they lie; only texts with an entity move.  Null texts count as empty and have no spans.
    Repeated rows give repeated equal results; rows with equal ids and other texts, and null ids, are kept apart by
    text.  An empty table gives an empty table.
    """
    found = store(found_entities(docs, id_col, text_col), "entities")
    bad = disclosing_terms(docs, text_col, found, support, share).select(F.col("text_key").alias("bad_key"), "bad")
    held = found.filter("text IS NOT NULL").join(bad, F.col("text_key") == F.col("bad_key"), "left")
    spans = F.when(F.col("bad").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", term_spans(F.col("text"), F.col("base"), F.col("bad"))))
    )
    whole = held.select("id", "text_key", spans.alias("spans"))
    rest = found.filter("text IS NULL").select("id", "text_key", F.col("base").alias("spans"))
    return whole.unionByName(rest).withColumnRenamed("id", id_col)


def generalised(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        fresh = F.struct(s["end"].alias("at"), out.alias("out"))
        longer = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(longer)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, done).otherwise(text)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text_col`` generalised; columns and rows stay as they are.

    Null texts stay null.  Other columns may have any names.
    """
    found = find_personal_data(docs, id_col, text_col).filter(F.size("spans") > 0)
    found = found.select(F.col(id_col).alias("id"), "text_key", "spans").dropDuplicates(["id", "text_key"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own, text = F.col("row").getField(id_col), F.col("row").getField(text_col)
    joined = rows.join(found, own.eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("text_key")), "left")
    clean = F.when(F.col("spans").isNull(), text).otherwise(generalised(text, F.col("spans")))
    return joined.select(*[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
