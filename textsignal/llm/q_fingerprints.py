"""Query op3: fingerprints of all texts and of their edited texts."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm import fingerprints as fp
from textsignal.llm.common import store
from textsignal.llm.registry import Source, query


def fingerprint_table(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fingerprint, copies, n_chars) per distinct id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("text_key"))
    return fp.simhash(rows, ["doc_id", "text_key"], F.col("text"), {"n_chars": F.length("text").cast("long")})


def with_next(prints: DataFrame) -> DataFrame:
    """The next document's id, fingerprint and text key per row; of a next id with several texts the least key counts."""
    least = prints.groupBy("doc_id").agg(F.min(F.struct("text_key", "fingerprint")).alias("least"))
    least = least.select(
        F.col("doc_id").alias("next_id"),
        F.col("least")["text_key"].alias("next_key"),
        F.col("least")["fingerprint"].alias("next_fingerprint"),
    )
    after = fp.successors(prints, "doc_id").join(least, "next_id")
    return prints.join(after, "doc_id", "left").withColumn("quarter", F.expr("cast(n_chars div 4 AS int)"))


@query("op3_simhash")
def op3(t: Source) -> DataFrame:
    """A row per row of documents; a null id has no next document: its text stays as it is and ``near_next`` is 0."""
    docs = t("documents").select("doc_id", "text")
    places = store(with_next(store(fingerprint_table(docs), "fingerprints")), "next-documents")
    edited = fp.edited_texts(docs, places.filter("next_id IS NOT NULL"))
    edited = edited.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    again = fp.simhash(edited, ["doc_id", "text_key", "edited_sha256"], F.col("edited")).select(
        F.col("doc_id").alias("id"),
        F.col("text_key").alias("key"),
        "edited_sha256",
        F.col("fingerprint").alias("edited"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    joined = places.join(again, same)
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fp.hex16(F.col("fingerprint")).alias("fingerprint"),
        fp.hex16(F.col("edited")).alias("edited_fingerprint"),
        fp.likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"),
        fp.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
