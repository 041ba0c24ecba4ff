"""Query op5: all documents in length buckets and batches."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.common import store
from textsignal.llm.packing import pack, word_tokens
from textsignal.llm.registry import Source, query


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, bucket, padded, batch, place) per row; texts are read once and do not move."""
    lengths = store(docs.select("doc_id", word_tokens(F.col("text")).alias("words")), "lengths")
    return pack(lengths, F.col("doc_id"), F.col("words")).drop("words")


@query("op5_buckets")
def op5(t: Source) -> DataFrame:
    return packed(t("documents"))
