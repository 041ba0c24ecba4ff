"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import store, without

BUCKETS = 1 << 18  # terms share hashed buckets; this bounds the model and what the driver holds of it
PER_CLASS = 3000  # sampled documents per label, in expectation
MIN_DOCS = 5  # documents that hold a learned term
FACTORS = 8
LINEAR_STEPS = 100
PAIR_STEPS = 40
SEARCH = 12  # rounds of the search for interacting terms
# Penalties fall with the root of the number of texts, as chance differences do.
PENALTY = 0.14  # on the size of a weight; divided by how far a term's share in the two classes differs, in standard errors
PAIR_PENALTY = 0.22  # on the size of a factor
SEED = 7
THRESHOLD = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> set[str]:
    return set() if text is None else set(_LETTERS.findall(text.lower()))


class _Buckets(dict):
    """Term -> bucket, remembered."""

    def __missing__(self, term: str) -> int:
        if len(self) >= 500_000:
            self.clear()
        bucket = self[term] = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), 42) % BUCKETS
        return bucket


@dataclass
class FactorizationMachine:
    """``bias + sum(w) + sum over pairs of terms of their factors' product``, as a probability."""

    buckets: np.ndarray  # sorted
    bias: float
    w: np.ndarray
    v: np.ndarray  # terms x factors

    def logit(self, rows: list[np.ndarray]) -> np.ndarray:
        """Of texts given as positions of their learned terms."""
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        out = np.full(len(rows), self.bias)
        if not counts.sum():
            return out
        flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), counts)
        out += np.bincount(owner, self.w[flat], len(rows))
        for f in range(self.v.shape[1]):
            x = self.v[flat, f]
            out += 0.5 * (np.bincount(owner, x, len(rows)) ** 2 - np.bincount(owner, x * x, len(rows)))
        return out

    def positions(self, found: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.buckets, found)
        at[at == len(self.buckets)] = 0
        return np.unique(at[self.buckets[at] == found]) if len(self.buckets) else np.zeros(0, np.int64)

    def probability(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -500, 500)))


class _Texts:
    """Training texts as a sparse table of 0 and 1, with labels and weights that sum to one."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, terms: int):
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        self.flat = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
        self.owner, self.n, self.terms = np.repeat(np.arange(len(rows)), counts), len(rows), terms
        self.y, self.weight = y, weight / weight.sum()
        self.chance = float(np.sqrt((self.weight**2).sum()))  # one over the root of the number of texts

    def by_text(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, x[self.flat], self.n)

    def by_term(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.flat, x[self.owner], self.terms)

    def logit(self, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits, and the texts' sums of each factor."""
        sums = np.stack([self.by_text(x) for x in v.T], axis=1) if v.shape[1] else np.zeros((self.n, 0))
        return bias + self.by_text(w) + 0.5 * ((sums**2).sum(axis=1) - self.by_text((v**2).sum(axis=1))), sums

    def loss(self, z: np.ndarray) -> float:
        return float(self.weight @ (np.logaddexp(0, z) - self.y * z))

    def slope(self, z: np.ndarray) -> np.ndarray:
        return self.weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - self.y)

    def contrast(self) -> np.ndarray:
        """How far each term's weighted share differs between the classes, in standard errors, 1 at least."""
        ones, zeros = self.weight * self.y, self.weight * (1 - self.y)
        share = self.by_term(self.weight)
        apart = self.by_term(ones) / ones.sum() - self.by_term(zeros) / zeros.sum()
        error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * ((ones**2).sum() / ones.sum() ** 2 + (zeros**2).sum() / zeros.sum() ** 2))
        return np.maximum(np.abs(apart) / error, 1)


def _shrunk(x: np.ndarray, by) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0)


def _descend(texts: _Texts, bias: float, w: np.ndarray, v: np.ndarray, penalty: np.ndarray, steps: int, pairs: bool):
    """Proximal gradient steps on bias and weights, and on factors if ``pairs``; the step length adapts.

    Only the convex part, weights alone, goes on with momentum.
    """
    step, t = 1.0, 1.0
    at_b, at_w, at_v = bias, w, v
    for _ in range(steps):
        z, sums = texts.logit(at_b, at_w, at_v)
        slope, here = texts.slope(z), texts.loss(z)
        grad_b, grad_w = slope.sum(), texts.by_term(slope)
        if pairs:
            grad_v = np.stack([texts.by_term(slope * sums[:, f]) for f in range(v.shape[1])], axis=1) - grad_w[:, None] * at_v
        while True:
            new_b, new_w = at_b - step * grad_b, _shrunk(at_w - step * grad_w, step * penalty)
            new_v = _shrunk(at_v - step * grad_v, step * PAIR_PENALTY * texts.chance) if pairs else at_v
            moved = [(new_b - at_b) * grad_b, (new_w - at_w) @ grad_w, ((new_v - at_v) * grad_v).sum() if pairs else 0.0]
            far = (new_b - at_b) ** 2 + ((new_w - at_w) ** 2).sum() + ((new_v - at_v) ** 2).sum()
            if step < 1e-8 or texts.loss(texts.logit(new_b, new_w, new_v)[0]) <= here + sum(moved) + far / (2 * step) + 1e-12:
                break
            step /= 2
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        push = 0.0 if pairs else (t - 1) / after
        at_b, at_w, at_v, t = new_b + push * (new_b - bias), new_w + push * (new_w - w), new_v, after
        bias, w, v, step = new_b, new_w, new_v, step * 1.3
    return bias, w, v


def _interacting(texts: _Texts, bias: float, w: np.ndarray, factors: int) -> np.ndarray:
    """Factors to start from: the leading directions of the table of pairs, weighted by what weights alone get wrong.

    The cell of two terms is the sum of the residuals of the texts that hold both.  The table is never built: products
    with it are sums over the texts.  A term that is equally common in both classes has a large share in a direction
    as soon as its company tells the classes apart.
    """
    residual = -texts.slope(texts.logit(bias, w, np.zeros((texts.terms, 0)))[0])
    own = texts.by_term(residual)

    def times(q: np.ndarray) -> np.ndarray:
        return np.stack([texts.by_term(residual * texts.by_text(x)) - own * x for x in q.T], axis=1)

    wide = min(2 * factors, texts.terms)
    q, shift = np.linalg.qr(np.random.default_rng(SEED).normal(size=(texts.terms, wide)))[0], 0.0
    for _ in range(SEARCH):
        z = times(q)
        shift = max(shift, float(np.abs((q * z).sum(axis=0)).max()))
        q = np.linalg.qr(z + shift * q)[0]
    small = q.T @ times(q)
    size, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-size)[:factors]
    out = np.zeros((texts.terms, factors))
    out[:, : len(order)] = (q @ turn[:, order]) * (size[order] > 0)
    return out


def fit(model: FactorizationMachine, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
    """Weighted logistic loss with penalties that set what tells nothing to zero.

    First bias and weights; then factors, from the directions in which pairs of terms explain what is still wrong, and
    all of them together.  A weight is penalised the less the further its term's share differs between the
    classes; no term is left out beforehand, so one that matters only in company is found by its factors.
    """
    texts = _Texts(rows, y, weight, len(model.w))
    if not len(model.w):
        return
    penalty = PENALTY * texts.chance / texts.contrast()
    bias, w, _ = _descend(texts, model.bias, model.w, np.zeros((texts.terms, 0)), penalty, LINEAR_STEPS, False)
    start = _interacting(texts, bias, w, model.v.shape[1])
    model.bias, model.w, model.v = _descend(texts, bias, w, start, penalty, PAIR_STEPS, True)


def _buckets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = _Buckets()
    for batch in batches:
        found = [sorted({known[t] for t in terms_of(text)}) for text in batch["text"]]
        yield pd.DataFrame({"label": batch["label"], "text_key": batch["text_key"], "buckets": found})


def bucket_column(text: Column) -> Column:
    """The distinct buckets of a text's terms, as ``_Buckets`` has them."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    return F.array_distinct(F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(BUCKETS)).cast("int")))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_class: int = PER_CLASS,
) -> FactorizationMachine:
    """Fit on a bounded sample: about ``per_class`` labelled rows of each class, by a hash of the id.

    Ids are drawn from the labels alone, so a broadcast of the drawn ids (bounded by ``per_class``) finds their texts
    where they lie.  Which hashed terms are learned is decided by all documents: those that at least ``MIN_DOCS`` of
    them hold, labelled or not.  Spark counts them where the texts lie, and there are at most ``BUCKETS``.  Of the sample
    the driver gets each text's buckets; equal texts of one label count once there.  Class weights restore the shares
    of all labelled rows, so scores are calibrated.

    Rows with a null id or label teach nothing; an id labelled twice has its greater label; a null
    text has no terms.  Without rows of both labels the model is the smoothed share of label 1.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    sizes = {0: 0, 1: 0} | {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    base = (sizes[1] + 1) / (sizes[0] + sizes[1] + 2)
    none = FactorizationMachine(np.zeros(0, np.int64), float(np.log(base / (1 - base))), np.zeros(0), np.zeros((0, FACTORS)))
    if not sizes[0] or not sizes[1]:
        return none
    luck = F.pmod(F.xxhash64("id", F.lit("toxicity sample")), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("label") == 1, per_class / sizes[1]).otherwise(per_class / sizes[0])
    drawn = marked.filter(luck < share)  # about 2 x per_class ids
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")
    texts = texts.select("label", "text", F.xxhash64("text").alias("text_key"))
    rows = store(texts.mapInPandas(_buckets_of, "label int, text_key long, buckets array<int>"), "toxicity-sample")
    held = docs.select(F.explode(bucket_column(F.col(text_col))).alias("bucket")).groupBy("bucket").count()
    held = held.filter(F.col("count") >= MIN_DOCS)
    kept = np.array(sorted(r["bucket"] for r in held.select("bucket").collect()), np.int64)  # at most BUCKETS
    got = rows.dropDuplicates(["label", "text_key"]).orderBy("label", "text_key").select("label", "buckets").collect()
    n = {c: sum(r["label"] == c for r in got) for c in (0, 1)}
    if not n[0] or not n[1]:
        return none
    model = FactorizationMachine(kept, none.bias, np.zeros(len(kept)), np.zeros((len(kept), FACTORS)))
    part = {1: sizes[1] / (sizes[0] + sizes[1]), 0: sizes[0] / (sizes[0] + sizes[1])}
    weight = np.array([part[r["label"]] / n[r["label"]] for r in got])
    found = [model.positions(np.array(r["buckets"], np.int64)) for r in got]
    fit(model, found, np.array([r["label"] for r in got], float), weight)
    told = (model.w != 0) | (model.v != 0).any(axis=1)
    return FactorizationMachine(kept[told], model.bias, model.w[told], model.v[told])


def toxicity(text: Column, model: FactorizationMachine, spark) -> Column:
    """Probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine, known = shared.value, _Buckets()
        for texts in batches:
            rows = []
            for text in texts:
                terms = terms_of(text)
                rows.append(machine.positions(np.fromiter((known[t] for t in terms), np.int64, len(terms))))
            yield pd.Series(machine.probability(rows), dtype="float64")

    return F.pandas_udf(score, "double")(text)


def score_toxicity(
    docs: DataFrame, model: FactorizationMachine, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if the score reaches ``threshold``).

    Terms are the distinct lower-cased letter runs of the whole text; an insult counts with the
    company it keeps, as every pair of terms has its own weight.  Null and empty texts get the
    score of a text without learned terms.  Repeated rows give equal results; columns named like
    a result are replaced, all others stay.
    """
    out = without(docs, "score", "predicted")
    out = out.withColumn("score", toxicity(F.col(text_col), model, docs.sparkSession))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
