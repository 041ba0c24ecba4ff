"""Query op9: components of near-duplicate documents."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.fingerprints import hex16
from textsignal.llm.near_dup import near_duplicates
from textsignal.llm.registry import Source, query


@query("op9_anchors")
def op9(t: Source) -> DataFrame:
    found = near_duplicates(t("documents"))
    return found.select("doc_id", hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")
