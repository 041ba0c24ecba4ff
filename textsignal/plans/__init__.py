"""Registered queries: importing the group modules fills the registry."""

from textsignal.plans import (  # noqa: F401
    audit,
    classify,
    dense,
    ensembles,
    evaluation,
    features,
    mechanisms,
    replays,
    routing,
    sparse,
    splits,
    storage,
    streams,
    text,
)
from textsignal.plans.registry import ORACLES, QUERIES  # noqa: F401
