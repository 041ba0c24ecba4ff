"""Language identification: unigram piece models, summed over all segmentations of every word."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import box, store

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = "und"
PER_LANGUAGE = 1500  # sampled documents per language, in expectation
ROUNDS = 4
SMOOTHING = 0.05
RUN = 4096  # bytes of a word that are summed over at once
PLAIN = 24  # bytes of a word up to which its probability is a plain number in training
CELLS = 1 << 18  # positions scored at once
CACHE = 200_000  # words whose scores a task remembers
GROUP = 2_000_000  # characters whose new words are scored together

_LETTERS = re.compile(r"[^\W\d_]+")
_SPACE = "▁"


def runs_of(text: str | None) -> list[str]:
    return [] if text is None else _LETTERS.findall(text.lower())


class Pieces:
    """Trie of the vocabulary's lower-case letter pieces over UTF-8 bytes; every single byte is a piece too.

    A word starts with byte 0, which stands for the vocabulary's word-start mark.
    """

    def __init__(self, pieces: list[str]):
        coded = [(b"\0" if p[:1] == _SPACE else b"") + p.lstrip(_SPACE).encode() for p in pieces]
        coded = sorted({c for c in coded if c})
        self.longest = max(map(len, coded), default=1)
        used = sorted({b for c in coded for b in c})
        self.classes = np.zeros(256, np.int64)  # class 0: in no piece
        self.classes[used] = np.arange(1, len(used) + 1)
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i, c in enumerate(coded):
            at = 1
            for b in c:
                at = nodes.setdefault((at, int(self.classes[b])), len(nodes) + 2)
            ends[at] = i
        self.step = np.zeros((len(nodes) + 2, len(used) + 1), np.int32)  # node 0: no piece goes on, 1: start
        for (at, c), to in nodes.items():
            self.step[at, c] = to
        self.piece = np.full(len(nodes) + 2, -1, np.int32)
        for at, i in ends.items():
            self.piece[at] = i
        self.first_byte = len(coded)
        self.size = len(coded) + 256

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        return cls([p for p in pieces if p.lstrip(_SPACE).isalpha() and p == p.lower()])

    def blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(indices, bytes, lengths) of words of like length, at most ``CELLS`` positions a block."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            n = 1
            while at + n < len(order) and (n + 1) * lengths[order[at + n]] <= CELLS:
                n += max(1, min(n, len(order) - at - n) // 2)
            rows = order[at : at + n]
            width = int(lengths[rows].max())
            joined = b"".join(words[r].ljust(width, b"\xff") for r in rows)
            yield rows, np.frombuffer(joined, np.uint8).reshape(len(rows), width), lengths[rows]
            at += n

    def matches(self, letters: np.ndarray, lengths: np.ndarray, start: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bytes, rows, pieces) that begin at ``start``."""
        rows = np.flatnonzero(lengths > start)
        yield 1, rows, self.first_byte + letters[rows, start].astype(np.int64)
        nodes = np.ones(len(rows), np.int64)
        for d in range(1, min(self.longest, letters.shape[1] - start) + 1):
            nodes = self.step[nodes, self.classes[letters[rows, start + d - 1]]]
            alive = (nodes > 0) & (lengths[rows] >= start + d)
            rows, nodes = rows[alive], nodes[alive]
            if not len(rows):
                return
            piece = self.piece[nodes]
            whole = piece >= 0
            if whole.any():
                yield d, rows[whole], piece[whole]

    def log_likelihoods(self, words: list[bytes], p: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all segmentations, per word and language: forward algorithm.

        ``p`` is (pieces, languages).  Sums are rescaled as they shrink.
        """
        out = np.zeros((len(words), p.shape[1]))
        for rows, letters, lengths in self.blocks(words):
            ring = np.zeros((self.longest + 1, len(rows), p.shape[1]))
            ring[0] = 1
            scale = np.zeros(ring.shape[1:])
            for start in range(letters.shape[1]):
                here = ring[start % len(ring)]
                for d, at, piece in self.matches(letters, lengths, start):
                    ring[(start + d) % len(ring)][at] += here[at] * p[piece]
                here[:] = 0
                if start % 8 == 7:
                    top = ring.max(axis=0)
                    top[top <= 0] = 1
                    ring /= top
                    scale += np.log(top)
                done = np.flatnonzero(lengths == start + 1)
                if len(done):
                    end = ring[(start + 1) % len(ring)][done]
                    out[rows[done]] = np.log(np.maximum(end, 1e-300)) + scale[done]
        return out

    def expected_counts(self, words: list[bytes], weights: np.ndarray, langs: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of every piece per language over all segmentations: forward-backward."""
        counts = np.zeros_like(p)
        for rows, letters, lengths in self.blocks(words):
            lang, weight = langs[rows], weights[rows]
            steps = [list(self.matches(letters, lengths, i)) for i in range(letters.shape[1])]
            if letters.shape[1] > PLAIN:
                self._count_in_logs(counts, steps, lengths, weight, lang, p)
                continue
            ahead = np.zeros((letters.shape[1] + 1, len(rows)))
            back = np.zeros_like(ahead)
            ahead[0] = 1
            back[lengths, np.arange(len(rows))] = 1
            for i, found in enumerate(steps):
                for d, at, piece in found:
                    ahead[i + d][at] += ahead[i][at] * p[piece, lang[at]]
            total = ahead[lengths, np.arange(len(rows))]
            share = np.divide(weight, total, out=np.zeros_like(total), where=total > 0)
            for i in range(len(steps) - 1, -1, -1):
                for d, at, piece in steps[i]:
                    q = p[piece, lang[at]] * back[i + d][at]
                    back[i][at] += q
                    np.add.at(counts, (piece, lang[at]), ahead[i][at] * q * share[at])
        return counts

    def _count_in_logs(self, counts: np.ndarray, steps: list, lengths: np.ndarray, weight: np.ndarray, lang: np.ndarray, p: np.ndarray) -> None:
        """The same for long words, whose probabilities are too small for plain numbers."""
        every = np.arange(len(lengths))
        ahead = np.full((len(steps) + 1, len(lengths)), -np.inf)
        back = np.full_like(ahead, -np.inf)
        ahead[0] = 0
        back[lengths, every] = 0
        with np.errstate(divide="ignore"):
            log_p = np.log(p)
        for i, found in enumerate(steps):
            for d, at, piece in found:
                ahead[i + d][at] = np.logaddexp(ahead[i + d][at], ahead[i][at] + log_p[piece, lang[at]])
        total = ahead[lengths, every]
        for i in range(len(steps) - 1, -1, -1):
            for d, at, piece in steps[i]:
                q = log_p[piece, lang[at]] + back[i + d][at]
                back[i][at] = np.logaddexp(back[i][at], q)
                share = np.exp(ahead[i][at] + q - total[at], where=np.isfinite(total[at]), out=np.zeros(len(at)))
                np.add.at(counts, (piece, lang[at]), share * weight[at])


def parts_of(runs) -> tuple[list[bytes], list[int]]:
    """Coded words, those over ``RUN`` bytes in parts, and the run that each part comes from."""
    parts: list[bytes] = []
    owner: list[int] = []
    for i, run in enumerate(runs):
        coded = b"\0" + run.encode("utf-8", "surrogatepass")
        for at in range(0, len(coded), RUN):
            parts.append(coded[at : at + RUN])
            owner.append(i)
    return parts, owner


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: Pieces
    p: np.ndarray

    def score_runs(self, runs: list[str]) -> np.ndarray:
        parts, owner = parts_of(runs)
        scores = self.pieces.log_likelihoods(parts, self.p)
        if len(parts) == len(runs):
            return scores
        out = np.zeros((len(runs), self.p.shape[1]))
        np.add.at(out, owner, scores)
        return out


def _count_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"], batch["text"]):
            counts.update((lang, run) for run in runs_of(text))
        rows = [(lang, run, n) for (lang, run), n in counts.items()]
        yield pd.DataFrame(rows, columns=["lang", "run", "n"]).astype({"n": "int64"})


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    per_language: int = PER_LANGUAGE,
    rounds: int = ROUNDS,
) -> LanguageModel:
    """Piece probabilities per language by expectation-maximisation over a bounded sample.

    About ``per_language`` documents of each language are taken by a hash of the id; their
    words are counted by Spark.  Every round is a Spark job over the distinct words that returns one
    expected count per piece and language: the vocabulary bounds what reaches the driver.
    Rows with null language or text teach nothing.  Words over ``RUN`` bytes are learned from, and scored, in parts.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    pieces = Pieces.load(vocabulary)
    p = np.full((pieces.size, len(languages)), 1.0 / pieces.size)
    if not languages:
        return LanguageModel(languages, pieces, p)
    share = spark.createDataFrame([(x, per_language / sizes[x]) for x in languages], "lang string, share double")
    luck = F.pmod(F.xxhash64("id", F.lit("language sample")), F.lit(1_000_000)) / 1_000_000
    sample = rows.withColumn("luck", luck).join(F.broadcast(share), "lang").filter("luck < share")  # a row a language
    counts = sample.select("lang", "text").mapInPandas(_count_runs, "lang string, run string, n long")
    counts = store(counts.groupBy("lang", "run").agg(F.sum("n").alias("n")), "language-words")
    index = {x: i for i, x in enumerate(languages)}
    tables = spark.sparkContext.broadcast(pieces)
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(p)

        def expected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(now.value)
            for batch in batches:
                words, owner = parts_of(batch["run"])
                langs, uses = batch["lang"].map(index).to_numpy(np.int64), batch["n"].to_numpy(float)
                total += tables.value.expected_counts(words, uses[owner], langs[owner], now.value)
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": total[piece, lang]})

        uses = counts.mapInPandas(expected, "piece long, lang long, uses double")
        uses = uses.groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
        p = np.full_like(p, SMOOTHING)
        for r in uses.collect():  # one row per piece and language
            p[r["piece"], r["lang"]] += r["uses"]
        p /= p.sum(axis=0)
    return LanguageModel(languages, pieces, p)


def _groups(texts: pd.Series) -> Iterator[list[list[str]]]:
    """Words of consecutive texts, about ``GROUP`` characters at a time."""
    group: list[list[str]] = []
    size = 0
    for text in texts:
        group.append(runs_of(text))
        size += len(text or "")
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group


def _predict(shared):
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model: LanguageModel = shared.value
        known: defaultdict = defaultdict()
        known.default_factory = known.__len__
        scores = np.zeros((0, len(model.languages)))
        for texts in batches:
            rows = []
            for group in _groups(texts):
                if len(known) > CACHE:
                    known.clear()
                    scores = scores[:0]
                at = [np.fromiter(map(known.__getitem__, runs), np.int64, len(runs)) for runs in group]
                fresh = list(islice(known, len(scores), None))
                scores = np.concatenate([scores, model.score_runs(fresh)])
                for found in at:
                    if not len(found) or not model.languages:
                        rows.append((UNKNOWN, 0.0))
                        continue
                    total = scores[found].sum(axis=0)
                    best = int(total.argmax())
                    rows.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return F.pandas_udf(score, "lang_pred string, score double")


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior under equal priors.

    The words of a text are independent under a unigram model, and no piece crosses a word, so the
    sum over all segmentations of a text is the product of the words' sums; a task scores each
    word once while it remembers it.  The whole text counts, wherever it lies.

    Null texts and texts without a letter, and all texts if no language was learned, get ``und`` and 0.
    Ties go to the first language by name.  Repeated rows give equal results; other columns stay, columns
    named like a result are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = _predict(shared)(F.col(text_col)).alias("found")
    return docs.select(box(docs, "lang_pred", "score"), found).select("row.*", "found.lang_pred", "found.score")
