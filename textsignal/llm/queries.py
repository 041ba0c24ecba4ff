"""Importing the query modules fills the registry."""

from textsignal.llm import (  # noqa: F401
    q_decontaminate,
    q_fingerprints,
    q_language,
    q_line_dedup,
    q_near_dup,
    q_packing,
    q_pii,
    q_prefix_trie,
    q_quotes,
    q_repair,
    q_shard,
    q_toxicity,
    q_warc,
)
from textsignal.llm.registry import ORACLES, QUERIES  # noqa: F401
