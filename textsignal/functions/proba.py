"""Scalar maths on three-class probability columns.

Hot paths keep the classes in three columns (whole-stage codegen); the array
form is for the edges of the API.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

P = ("p0", "p1", "p2")


def argmax3(p0: Column, p1: Column, p2: Column) -> Column:
    """Index of the first maximum."""
    return F.when((p0 >= p1) & (p0 >= p2), 0).when(p1 >= p2, 1).otherwise(2)


def argmax_array(proba: Column) -> Column:
    """Index of the first maximum of an array column."""
    return (F.array_position(proba, F.array_max(proba)) - 1).cast("int")


def pred_of(prefix: str = "p") -> Column:
    return argmax3(*(F.col(f"{prefix}{i}") for i in range(3)))


def confidence_of(prefix: str = "p") -> Column:
    return F.greatest(*(F.col(f"{prefix}{i}") for i in range(3)))


def soften3(ps: list[Column], temperature: Column | float) -> list[Column]:
    """softmax(ln(p + 1e-9) / T), shifted by the maximum."""
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    logits = [F.log(p + F.lit(1e-9)) / t for p in ps]
    top = F.greatest(*logits)
    exps = [F.exp(x - top) for x in logits]
    total = exps[0] + exps[1] + exps[2]
    return [e / total for e in exps]


def soften_array(proba: Column, temperature: float) -> Column:
    """Array form of :func:`soften3` for any number of classes."""
    logits = F.transform(proba, lambda p: F.log(p + F.lit(1e-9)) / F.lit(float(temperature)))
    exps = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(exps, F.lit(0.0), lambda a, x: a + x)
    return F.transform(exps, lambda e: e / total)


def kl3(target: list[Column], source: list[Column]) -> Column:
    """KL(target || source) of one row."""
    terms = [F.when(t > 0, t * (F.log(t) - F.log(s))).otherwise(F.lit(0.0)) for t, s in zip(target, source)]
    return terms[0] + terms[1] + terms[2]


def pick3(label: Column, cols: list[Column]) -> Column:
    """The column of the row's own class."""
    return F.when(label == 0, cols[0]).when(label == 1, cols[1]).otherwise(cols[2])


def map_model_label(name: Column, index: Column) -> Column:
    """A model's own class name to our class id; unknown names keep their index."""
    low = F.lower(name)
    return (
        F.when(low.contains("bear") | low.contains("negative"), 0)
        .when(low.contains("bull") | low.contains("positive"), 1)
        .when(low.contains("neutral"), 2)
        .otherwise(index)
        .cast("int")
    )
