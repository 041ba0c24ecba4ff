"""Query op1: the language of every document."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.common import held_out
from textsignal.llm.language import identify, train
from textsignal.llm.registry import Source, query


@query("op1_segmentations")
def op1(t: Source) -> DataFrame:
    docs = t("documents")
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
