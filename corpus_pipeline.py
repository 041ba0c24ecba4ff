"""Corpus pipeline: stages over ``documents``, each stored as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textsignal.llm import language, near_dup, pii
from textsignal.llm.common import held_out, store
from textsignal.llm.decontaminate import decontaminate
from textsignal.llm.q_packing import packed
from textsignal.sources.readers import read_table

LEAST_SCORE = 0.5


def boxed(docs: DataFrame) -> DataFrame:
    """The row as one column beside its text, so that no result of an operator meets a column of the same name."""
    return docs.select(F.struct(*docs.columns).alias("_doc"), F.col("text").alias("_text"))


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: rejected are those without a letter and those no language prevails for.

    The model learns as in the language query, from the rows of the corpus that name a language.  Null and empty
    texts have no letter and go; null ids, sources and languages change nothing; repeated rows stay; of languages
    that tie the first by name counts; an empty table stays empty.
    """
    model = language.train(docs.filter(~held_out(F.col("doc_id"))))
    found = language.identify(boxed(docs), model, "_text")
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select("_doc.*")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates (4-word shingles, fingerprints 4 or fewer bits apart) the document with the least id.

    Null and empty texts have fingerprint 0 and form one group; of repeated rows, and of rows that share an id, one stays;
    a row without an id stays if no row with an id has its fingerprint.  An empty table stays empty.
    """
    return near_dup.one_per_component(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word window of the benchmark.

    Null and empty texts have no words and stay, as do repeated clean rows; wordless and null items match nothing.  An
    empty table stays empty, and an empty benchmark keeps every row.
    """
    found = decontaminate(boxed(docs), read_table(spark, sf_dir, "benchmark"), "_text")
    return found.filter("n_hit = 0").select("_doc.*")


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data generalised in their text; ``n_chars`` follows the text.

    A null text stays null and has a null ``n_chars``; empty texts and repeated rows stay as they are; an empty table
    stays empty.
    """
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def batched(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document: its length, bucket, batch and place.

    Null and empty texts have no tokens and join the first bucket; repeated rows get places of their own; rows of equal
    length are told apart by a hash of the id; an empty table gives no rows.
    """
    return packed(docs)


STAGES = [
    ("language_id", identified),
    ("near_dedup", deduplicated),
    ("decontamination", decontaminated),
    ("pii", sanitised),
    ("packing", batched),
]

# The stages train a model and search fingerprints: not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
