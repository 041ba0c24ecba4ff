"""Query op2: toxicity of every document."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.common import held_out
from textsignal.llm.registry import Source, query
from textsignal.llm.toxicity import score_toxicity, train


@query("op2_factorization_machine")
def op2(t: Source) -> DataFrame:
    docs = t("documents")
    model = train(docs, t("labels").filter(~held_out(F.col("doc_id"))))
    found = score_toxicity(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
