"""Query op8: replies and quotes of all conversations."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.quotes import link_quotes
from textsignal.llm.registry import Source, query


@query("op8_quotations")
def op8(t: Source) -> DataFrame:
    found = link_quotes(t("conversations"))
    return found.select(
        "conv_id",
        "turn",
        "role",
        "quote_levels",
        "n_quotes",
        "n_linked",
        "reply_to",
        "thread",
        "depth",
        F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256).alias("body_sha256"),
    )
