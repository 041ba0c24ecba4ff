"""Query op7: personal data in every document."""

from pyspark.sql import DataFrame, functions as F

from textsignal.llm.pii import PATTERNS, find_personal_data
from textsignal.llm.registry import Source, query


def joined_spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number(kind):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind))


@query("op7_disclosure")
def op7(t: Source) -> DataFrame:
    found = find_personal_data(t("documents"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id",
        *[number(kind).cast("long").alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )
