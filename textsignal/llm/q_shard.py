"""Query op4: all documents on a bounded-load ring of eight shards."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.common import store
from textsignal.llm.registry import Source, query
from textsignal.llm.shard import shard_by_ring


@query("op4_ring")
def op4(t: Source) -> DataFrame:
    digests = t("documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    )
    dealt = shard_by_ring(store(digests, "digests"), F.col("key"), F.col("size"), F.col("doc_id"))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
