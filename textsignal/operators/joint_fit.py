"""Linear classifiers of all folds over packed TF-IDF cells, fitted side by side.

MLlib stores a copy of every fold's training rows as vectors and reads it a hundred times, fold by fold.  Here the texts of
all folds are stored once as indices and counts, and one pass over them gives every fold's loss and gradient.  Objective,
scaling by deviations, start, steps and stops are MLlib's, so the models are the same up to rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F, types as T

from textsignal.operators.minimise import minimise, side_by_side
from textsignal.operators.sparse import FoldVectors
from textsignal.operators.term_rows import place_type, unpack_counts, unpacked

PIECE = 150_000  # cells that are worked on at a time
BATCH = 512  # rows that cross to Python at a time
MOST = 1 << 28  # bytes of the tasks' sums that the driver adds up itself
LOGS = 1 + np.log(np.maximum(np.arange(256), 1))  # by count
DEGENERATE = 1e-12  # below this share of the squares a sum of squared differences is rounding


# --- pieces of stored rows -------------------------------------------------------------
@dataclass
class Piece:
    """Texts of one use: cells text by text, their lengths under each fold's model, labels, and dense columns."""

    rows: np.ndarray  # in the batch
    use: int
    label: np.ndarray
    fold: np.ndarray
    at: list[int]
    index: np.ndarray
    value: np.ndarray
    inverse: np.ndarray  # of the lengths, 0 without a known term
    more: np.ndarray | None

    def dot(self, columns: np.ndarray) -> np.ndarray:
        """Texts x columns, from terms x columns."""
        columns = np.ascontiguousarray(columns)
        out = np.zeros((len(self.rows), columns.shape[1]))
        room = np.empty((max(np.diff(self.at), default=0), columns.shape[1]))
        for d, (a, b) in enumerate(zip(self.at, self.at[1:])):
            if b > a:
                np.dot(self.value[a:b], columns.take(self.index[a:b], axis=0, out=room[: b - a], mode="clip"), out=out[d])
        return out

    def add_to(self, sums: np.ndarray, factors: np.ndarray, value: np.ndarray | None = None) -> None:
        """Adds each text's cells times its factors to ``sums``, factors x terms, in place."""
        value, lengths = self.value if value is None else value, np.diff(self.at)
        for total, factor in zip(sums, factors.T):
            total += np.bincount(self.index, value * np.repeat(factor, lengths), len(total))


def pieces(batch: pa.RecordBatch, n_terms: int, k: int, test: bool = False) -> Iterator[Piece]:
    """Rows that train a model, or those that one scores, by use and about ``PIECE`` cells."""
    column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    use, fold = column("use"), column("fold").astype(np.int64)
    label = batch.column("label").fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    wanted = column("test").astype(bool) if test else (use >= 0) & (label >= 0)
    cells, counts, sizes = (batch.column(c).to_pylist() for c in ("indices", "tf", "sizes"))
    wide = np.dtype(place_type(n_terms)).itemsize
    length = np.array([len(v) // wide if v else 0 for v in cells], dtype=np.int64)
    more = None
    if "more" in batch.schema.names:
        numbers = batch.column("more").flatten()
        if numbers.null_count:
            raise ValueError("a dense column is null")
        more = numbers.to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    group = fold if test else use
    for one in np.unique(group[wanted]):
        rows, at = np.flatnonzero(wanted & (group == one)), 0
        ends = np.cumsum(length[rows])
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, side="right")))
            mine, at = rows[at:to], to
            _, index = unpacked([cells[i] for i in mine], place_type(n_terms))
            tf = unpack_counts([counts[i] for i in mine], length[mine])
            size = np.frombuffer(b"".join(sizes[i] for i in mine)).reshape(len(mine), k)
            value = LOGS.take(tf) if tf.dtype == np.uint8 else 1 + np.log(tf)
            inverse = np.divide(1.0, size, out=np.zeros_like(size), where=size > 0)
            starts = [0, *np.cumsum(length[mine]).tolist()]
            yield Piece(mine, int(one), label[mine], fold[mine], starts, index.astype(np.intp), value, inverse, None if more is None else more[mine])


def trained_by(use: int, k: int) -> list[int]:
    """The folds whose models a row of this use trains."""
    return [f for f in range(k) if f != use] if use < k else [use - k]


def read_in_batches(stored: DataFrame) -> DataFrame:
    """The stored table in a session of its own whose rows cross in batches of ``BATCH``: they are wide."""
    session = stored.sparkSession.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    session.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(BATCH))
    folders = sorted({name.rsplit("/", 1)[0] for name in stored.inputFiles()})
    return session.read.schema(stored.schema).parquet(*folders) if folders else stored


def sums_of(cells: DataFrame, size: int, gather: Callable[[Iterator[pa.RecordBatch], np.ndarray], None]) -> np.ndarray:
    """What ``gather`` adds to ``size`` numbers in every task, added up; tasks are as many as cores at most."""
    tasks = cells.sparkSession.sparkContext.defaultParallelism
    slots = 1 if 8 * size * tasks <= MOST else tasks
    cuts = np.linspace(0, size, slots + 1).astype(int).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size)
        gather(batches, sums)
        for slot, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([sums[a:b].tobytes()], pa.binary())], names=["slot", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, part in zip(batch.column("slot").to_pylist(), batch.column("part").to_pylist()):
                held[slot] = held[slot] + np.frombuffer(part) if slot in held else np.frombuffer(part)
        for slot, part in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slot", "part"])

    parts = cells.coalesce(tasks).mapInArrow(run, "slot int, part binary")
    if slots > 1:
        parts = parts.repartition(slots, "slot").mapInArrow(add, "slot int, part binary")
    total = np.zeros(size)
    for row in parts.collect():
        total[cuts[row["slot"]] : cuts[row["slot"] + 1]] += np.frombuffer(row["part"])
    return total


# --- models ----------------------------------------------------------------------------
@dataclass
class FoldModel:
    """Moments of a fold's training rows and its model: a row of coefficients for each class, and offsets."""

    places: np.ndarray  # of its terms among all terms
    idf: np.ndarray
    weights: np.ndarray  # by label
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0))  # weight of each class
    total: float = 0.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    deviation: np.ndarray = field(default_factory=lambda: np.zeros(0))
    coefficients: np.ndarray | None = None  # of plain features: terms, then dense columns
    offsets: np.ndarray | None = None

    @property
    def inverse(self) -> np.ndarray:
        return np.divide(1.0, self.deviation, out=np.zeros_like(self.deviation), where=self.deviation > 0)

    def plain(self, x: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients and offsets for features as they are, from those of scaled and centred ones."""
        scaled = x[:-classes].reshape(classes, -1) * self.inverse
        return scaled, x[-classes:] - scaled @ self.mean


class JointFit:
    """Models of every fold of ``found``; a pass reads the stored cells once for all of them."""

    def __init__(self, found: FoldVectors, n_classes: int = 3):
        self.found, self.k, self.n_terms = found, found.k, len(found.terms)
        self.dense = len(found.dense[0][0]) if found.dense else 0
        self.cells = read_in_batches(found.cells).select("label", "fold", "use", "test", "indices", "tf", "sizes", *(["more"] if found.dense else []))
        self.n_labels = max([n_classes, *[label + 1 for _, label, _ in found.sizes if label is not None]])
        self.models = []
        for f, (_, idf) in enumerate(found.vocabularies):
            by_label = found.weights(f)
            weights = np.array([by_label.get(label, 0.0) for label in range(self.n_labels)])
            self.models.append(FoldModel(found.places[f], idf, weights))
        self._moments()

    def _scaled(self) -> Callable[[np.ndarray, int], np.ndarray]:
        moments = self.found.dense

        def scaled(more: np.ndarray, f: int) -> np.ndarray:
            mean, spread = moments[f]
            return np.divide(more - mean, spread, out=np.zeros_like(more), where=spread > 0)

        return scaled

    def _moments(self) -> None:
        """Weighted mean and deviation of every feature, and the weights of the classes, as MLlib's summary has them."""
        k, n_terms, dense, n_labels, scaled = self.k, self.n_terms, self.dense, self.n_labels, self._scaled()
        weights = [m.weights for m in self.models]
        shape, ends = (k, 4, n_terms), 4 * k * n_terms

        def gather(batches: Iterator[pa.RecordBatch], sums: np.ndarray) -> None:
            cells, more, classes = sums[:ends].reshape(shape), sums[ends : ends + 2 * k * dense].reshape(k, 2, dense), sums[ends + 2 * k * dense :].reshape(k, 3, n_labels)
            for batch in batches:
                for piece in pieces(batch, n_terms, k):
                    ones, squares = np.ones_like(piece.value), piece.value**2
                    for f in trained_by(piece.use, k):
                        w, inverse = weights[f][piece.label], piece.inverse[:, f]
                        piece.add_to(cells[f, :2], np.stack([np.ones_like(w), w], axis=1), ones)
                        piece.add_to(cells[f, 2:3], (w * inverse)[:, None])
                        piece.add_to(cells[f, 3:], (w * inverse**2)[:, None], squares)
                        for row, v in zip(classes[f], (np.ones_like(w), w, w * w)):
                            row += np.bincount(piece.label, v, n_labels)
                        if dense:
                            x = scaled(piece.more, f)
                            more[f] += np.stack([w @ x, w @ (x * x)])

        sums = sums_of(self.cells, ends + 2 * k * dense + 3 * k * n_labels, gather)
        cells, more, classes = sums[:ends].reshape(shape), sums[ends : ends + 2 * k * dense].reshape(k, 2, dense), sums[ends + 2 * k * dense :].reshape(k, 3, n_labels)
        for model, (n, w, x, xx), (dx, dxx), (rows, by_class, squared) in zip(self.models, cells, more, classes):
            at, total = model.places, by_class.sum()
            n, w, x, xx = n[at], w[at], x[at] * model.idf, xx[at] * model.idf**2
            centre = np.divide(x, w, out=np.zeros_like(x), where=w > 0)
            around = xx - x * centre
            around[around < DEGENERATE * xx] = 0
            rest = np.where(n == rows.sum(), 0.0, total - w)
            spread = around + centre**2 * w * rest / total
            dense_spread = dxx - dx * dx / total
            dense_spread[dense_spread < DEGENERATE * dxx] = 0
            bottom = total - squared.sum() / total
            variance = np.maximum(np.concatenate([spread, dense_spread]) / bottom, 0) if bottom > 0 else np.zeros(len(at) + dense)
            model.mean, model.deviation = np.concatenate([x, dx]) / total, np.sqrt(variance)
            seen = int(np.flatnonzero(rows).max()) + 1
            model.counts, model.total = by_class[:seen], total

    def _columns(self, rows: dict[tuple[int, int], np.ndarray]) -> tuple[dict[int, tuple[slice, list[int]]], np.ndarray, np.ndarray]:
        """Columns and classes of each fold, and the coefficients of ``(fold, class)``: terms x columns, dense columns x columns."""
        names = sorted(rows)
        table, more, of = np.zeros((self.n_terms, len(names))), np.zeros((self.dense, len(names))), {}
        for f in dict.fromkeys(f for f, _ in names):
            at = [i for i, name in enumerate(names) if name[0] == f]
            of[f] = slice(at[0], at[-1] + 1), [names[i][1] for i in at]
            model = self.models[f]
            for i in at:
                table[model.places, i] = rows[names[i]][: len(model.places)] * model.idf
                more[:, i] = rows[names[i]][len(model.places) :]
        return of, table, more

    def _pass(self, rows: dict, offsets: dict[int, np.ndarray], hinge: bool) -> Callable[[int], tuple]:
        """Losses and their slopes of every fold asked, from one reading of the cells.

        Coefficients and slopes of a softmax add up to nothing over the classes, so its last class needs no column.
        """
        of, table, more_table = self._columns(rows)
        k, n_terms, dense, scaled, n_columns = self.k, self.n_terms, self.dense, self._scaled(), table.shape[1]
        weights, wide = [m.weights for m in self.models], self.n_labels
        shipped = self.cells.sparkSession.sparkContext.broadcast((table, more_table, offsets))
        cuts = np.cumsum([n_terms * n_columns, dense * n_columns, k * wide]).tolist()
        shaped = lambda v: (v[: cuts[0]].reshape(n_columns, n_terms), v[cuts[0] : cuts[1]].reshape(dense, n_columns), *v[cuts[1] :].reshape(2, k, wide))

        def gather(batches: Iterator[pa.RecordBatch], sums: np.ndarray) -> None:
            (table, more_table, offsets), (slopes, more_slopes, shifts, losses), own = shipped.value, shaped(sums), {}
            for batch in batches:
                for piece in pieces(batch, n_terms, k):
                    if piece.use not in own:
                        folds = [f for f in trained_by(piece.use, k) if f in of]
                        at = [c for f in folds for c in range(of[f][0].start, of[f][0].stop)]
                        own[piece.use] = folds, at, np.ascontiguousarray(table[:, at])
                    folds, at, mine = own[piece.use]
                    if not folds:
                        continue
                    found, done, every = piece.dot(mine), 0, np.arange(len(piece.rows))
                    for f in folds:
                        columns, classes = of[f]
                        here = slice(done, done + len(classes))
                        done = here.stop
                        inverse, w = piece.inverse[:, f, None], weights[f][piece.label]
                        margins = found[:, here] * inverse
                        if dense:
                            x = scaled(piece.more, f)
                            margins = margins + x @ more_table[:, columns]
                        if hinge:
                            sign = np.where(piece.label[:, None] == classes, 1.0, -1.0)
                            short = 1 - sign * (margins + offsets[f][classes])
                            r = np.where(short > 0, -sign * w[:, None], 0.0)
                            losses[f, classes] += w @ np.maximum(short, 0)
                            shifts[f, classes] += r.sum(axis=0)
                        else:
                            margins = np.concatenate([margins, -margins.sum(axis=1, keepdims=True)], axis=1) + offsets[f]
                            margins -= margins.max(axis=1, keepdims=True)
                            grown = np.exp(margins)
                            total = grown.sum(axis=1)
                            losses[f, 0] += w @ (np.log(total) - margins[every, piece.label])
                            r = grown / total[:, None]
                            r[every, piece.label] -= 1
                            r *= w[:, None]
                            shifts[f, : r.shape[1]] += r.sum(axis=0)
                            r = r[:, :-1]
                        if dense:
                            more_slopes[:, columns] += x.T @ r
                        found[:, here] = r * inverse
                    piece.add_to([slopes[c] for c in at], found)

        slopes, more_slopes, shifts, losses = shaped(sums_of(self.cells, cuts[2] + k * wide, gather))
        shipped.destroy()

        def of_fold(f: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Losses by class, slopes by offset, and slopes of the fold's columns by coefficient of the plain features."""
            model, (columns, _) = self.models[f], of[f]
            return losses[f], shifts[f], np.concatenate([slopes[columns][:, model.places] * model.idf, more_slopes[:, columns].T], axis=1)

        return of_fold

    def _cost(self, f: int, x: np.ndarray, classes: int, loss: float, shift: np.ndarray, slopes: np.ndarray, reg: float) -> tuple[float, np.ndarray]:
        """Value and gradient for coefficients of scaled and centred features, with the penalty on those of plain ones."""
        model = self.models[f]
        inverse, rows = model.inverse, x[:-classes].reshape(classes, -1)
        by_row = (slopes - np.outer(shift, model.mean)) * inverse / model.total
        penalty = rows * inverse**2
        value = loss / model.total + 0.5 * reg * float(np.sum(rows * penalty))
        return value, np.concatenate([(by_row + reg * penalty).ravel(), shift / model.total])

    def logistic(self, reg: Callable[[int], float], max_iter: int, tol: float) -> JointFit:
        """Softmax regression; ``reg`` is the penalty by fold."""
        classes = {f: len(m.counts) for f, m in enumerate(self.models)}

        def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
            plain = {f: self.models[f].plain(x, classes[f]) for f, x in points.items()}
            rows = {(f, c): coefficients[c] for f, (coefficients, _) in plain.items() for c in range(classes[f] - 1)}
            found, out = self._pass(rows, {f: shift for f, (_, shift) in plain.items()}, False), {}
            for f, x in points.items():
                losses, shifts, slopes = found(f)
                slopes = np.concatenate([slopes, -slopes.sum(axis=0, keepdims=True)])
                out[f] = self._cost(f, x, classes[f], losses[0], shifts[: classes[f]], slopes, reg(f))
            return out

        searches = {}
        for f, model in enumerate(self.models):
            start = np.log1p(model.counts)
            searches[f] = minimise(np.concatenate([np.zeros(classes[f] * len(model.mean)), start - start.mean()]), max_iter, tol)
        for f, x in side_by_side(searches, evaluate).items():
            model = self.models[f]
            model.coefficients, offsets = model.plain(x, classes[f])
            model.offsets = offsets - offsets.mean()
        return self

    def one_against_rest(self, reg: Callable[[int], float], max_iter: int, tol: float) -> JointFit:
        """A linear support vector machine for each class against the others; ``reg`` is the penalty by fold."""

        def evaluate(points: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], tuple[float, np.ndarray]]:
            plain = {(f, c): self.models[f].plain(x, 1) for (f, c), x in points.items()}
            offsets = {f: np.zeros(self.n_labels) for f, _ in points}
            for (f, c), (_, shift) in plain.items():
                offsets[f][c] = shift[0]
            found, out = self._pass({name: rows[0] for name, (rows, _) in plain.items()}, offsets, True), {}
            for f in offsets:
                losses, shifts, slopes = found(f)
                for i, c in enumerate(sorted(c for g, c in points if g == f)):
                    out[f, c] = self._cost(f, points[f, c], 1, losses[c], shifts[c : c + 1], slopes[i : i + 1], reg(f))
            return out

        searches = {(f, c): minimise(np.zeros(len(m.mean) + 1), max_iter, tol, in_orthant=True) for f, m in enumerate(self.models) for c in range(len(m.counts))}
        fitted = side_by_side(searches, evaluate)
        for f, model in enumerate(self.models):
            plain = [model.plain(fitted[f, c], 1) for c in range(len(model.counts))]
            model.coefficients, model.offsets = np.concatenate([rows for rows, _ in plain]), np.concatenate([shift for _, shift in plain])
        return self

    def _scorer(self) -> Callable[[Piece, int], np.ndarray]:
        """Margins of a piece by the model of a fold."""
        of, table, more_table = self._columns({(f, c): row for f, m in enumerate(self.models) for c, row in enumerate(m.coefficients)})
        shipped = self.cells.sparkSession.sparkContext.broadcast((table, more_table, [m.offsets for m in self.models]))
        dense, scaled, own = self.dense, self._scaled(), {}

        def score(piece: Piece, folds: list[int]) -> list[np.ndarray]:
            table, more_table, offsets = shipped.value
            if tuple(folds) not in own:
                own[tuple(folds)] = np.ascontiguousarray(np.concatenate([table[:, of[f][0]] for f in folds], axis=1))
            found, done, out = piece.dot(own[tuple(folds)]), 0, []
            for f in folds:
                margins = found[:, done : done + len(of[f][1])] * piece.inverse[:, f, None] + offsets[f]
                done += len(of[f][1])
                out.append(margins + scaled(piece.more, f) @ more_table[:, of[f][0]] if dense else margins)
            return out

        return score

    def scored(self, ids: str = "doc_id", margins: bool = False) -> DataFrame:
        """``(id, label, fold, p0, p1, p2)`` of every row by the model of its fold; with ``margins`` these instead of probabilities."""
        score, n_terms, k = self._scorer(), self.n_terms, self.k
        schema = T.StructType([self.found.cells.schema[c] for c in (ids, "label", "fold")])
        for c in range(3):
            schema = schema.add(f"p{c}", T.DoubleType())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, n_terms, k, test=True):
                    found = score(piece, [piece.use])[0]
                    if not margins:
                        found = _softmax(found)
                    columns = [found[:, c] if c < found.shape[1] else np.zeros(len(found)) for c in range(3)]
                    if margins:
                        columns = [v if c < found.shape[1] else None for c, v in enumerate(columns)]
                    values = [pa.nulls(len(found), pa.float64()) if v is None else pa.array(np.ascontiguousarray(v)) for v in columns]
                    yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(piece.rows)) for c in (ids, "label", "fold")], *values], names=schema.names)

        return self.found.cells.mapInArrow(run, schema)

    def training_cells(self) -> np.ndarray:
        """Folds x labels x predicted classes: how the training rows of each fold fall, three of each."""
        score, n_terms, k = self._scorer(), self.n_terms, self.k

        def gather(batches: Iterator[pa.RecordBatch], sums: np.ndarray) -> None:
            for batch in batches:
                for piece in pieces(batch, n_terms, k):
                    folds, known = trained_by(piece.use, k), piece.label < 3
                    for f, found in zip(folds, score(piece, folds)):
                        pred = _softmax(found)[:, :3].argmax(axis=1)
                        sums[9 * f : 9 * f + 9] += np.bincount(3 * piece.label[known] + pred[known], minlength=9)

        return sums_of(self.cells, 9 * k, gather).reshape(k, 3, 3)


def _softmax(margins: np.ndarray) -> np.ndarray:
    grown = np.exp(margins - margins.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def fit_all(found: FoldVectors | None, make: Callable[[int], Estimator]) -> JointFit | None:
    """The models that ``make`` gives for each fold's number of training rows, fitted side by side.

    None if they are others than softmax regression or linear machines one against the rest as ``make_estimator`` sets
    them, or if a fold's training rows have less than two classes: those are for MLlib.
    """
    if found is None:
        return None
    made = [make(found.n_train(f)) for f in range(found.k)]
    inner = [e.getClassifier() if isinstance(e, OneVsRest) else e for e in made]
    if not all(isinstance(e, LogisticRegression | LinearSVC) and e.getFitIntercept() and not e.getStandardization() for e in inner):
        return None
    logistic = isinstance(made[0], LogisticRegression)
    if logistic and not all(e.getFamily() == "multinomial" and not e.getElasticNetParam() for e in made):
        return None
    if not logistic and not all(isinstance(e, OneVsRest) for e in made):
        return None
    if not all(e.isDefined("weightCol") for e in made) or any(len([1 for label in found.weights(f) if label is not None]) < 2 for f in range(found.k)):
        return None
    fit = JointFit(found)
    run = fit.logistic if logistic else fit.one_against_rest
    return run(lambda f: inner[f].getRegParam(), inner[0].getMaxIter(), inner[0].getTol())


def margin_vectors(scored: DataFrame) -> DataFrame:
    """``rawPrediction`` from the margins by class."""
    known = F.filter(F.array("p0", "p1", "p2"), lambda x: x.isNotNull())
    return scored.select("doc_id", "label", "fold", array_to_vector(known).alias("rawPrediction"))
