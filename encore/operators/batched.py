"""Cross-validated logistic regression for a whole grid at once.

Tuning by separate fits scans the data some ten times for every grid point and fold. Here
one scan per iteration serves all of them: the coefficients of all models stand in one
matrix, tasks multiply batches of rows with it, and add up each model's loss, gradient
and curvature over the rows of its folds. The sums (a few numbers per model and pair of
features) are merged by a tree of shuffles; the driver takes a proximal Newton step per model.
The objective is that of Spark's estimator: mean logistic loss plus the elastic net on
coefficients of features scaled to unit deviation, the intercept free.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.evaluate import grouped_auc

#: Steps of a fit, the relative size of a step that ends it, and the gain in the objective that does.
MAX_STEPS, TOLERANCE, GAIN = 40, 1e-9, 1e-14
#: Rows of a matrix product, and sets of sums that one task merges.
_ROWS, _FAN_IN = 2048, 64


class Point(NamedTuple):
    """A grid point: strength of the penalty and the share of its absolute part."""

    reg: float
    alpha: float


class Tuned(NamedTuple):
    """Mean score of each grid point over the folds, the best one's index, and its model on all
    rows: coefficients (classes x features; one row for two classes) and intercepts."""

    points: list[Point]
    scores: list[float]
    best: int
    coefficients: np.ndarray
    intercepts: np.ndarray


def _sums(rows: DataFrame, step, width: int) -> np.ndarray:
    """The sum over all rows of ``step(x, y, fold)``, an array of ``width`` numbers per batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                total += step(*_columns(some))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "packed"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same sum in every run
        total = np.sum([np.frombuffer(x.as_py(), dtype=np.float64) for x in table.column("packed")], axis=0)
        return pa.table([table.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["part", "packed"])

    schema = "part bigint, packed binary"
    parts = rows.select("x", "y", "fold").mapInArrow(count, schema)
    merged = parts.withColumn("near", F.floor(F.col("part") / _FAN_IN)).groupBy("near").applyInArrow(add, schema)
    merged = merged.withColumn("near", F.floor(F.col("part") / _FAN_IN**2)).groupBy("near").applyInArrow(add, schema)
    found = merged.toArrow().sort_by("part").column("packed")  # a row per 4,096 tasks
    return np.sum([np.frombuffer(x.as_py(), dtype=np.float64) for x in found], axis=0) if len(found) else np.zeros(width)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m = batch.num_rows
    x = batch.column(0).flatten().to_numpy().reshape(m, -1)
    return np.column_stack([x, np.ones(m)]), batch.column(1).to_numpy(), batch.column(2).to_numpy()


def _probabilities(x: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x models x classes) probabilities and the log of their normaliser; ``b`` is models x
    classes x features, with one class row for two classes (the other's logit is 0)."""
    z = np.einsum("mk,ack->mac", x, b, optimize=True)
    if b.shape[1] == 1:
        z = np.concatenate([np.zeros_like(z), z], axis=2)
    top = z.max(axis=2, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=2, keepdims=True)
    return e / total, z - top - np.log(total)


class _Problem:
    """All models of one tuning: grid points x (folds left out, or none)."""

    def __init__(self, rows: DataFrame, points: Sequence[Point], folds: int, classes: int, features: int):
        self.rows, self.points, self.folds, self.classes, self.k = rows, list(points), folds, classes, features + 1
        self.models = [(p, f) for p in self.points for f in range(folds + 1)]  # fold ``folds``: none left out
        self.own = classes if classes > 2 else 1
        iu = np.triu_indices(self.k)
        self.pairs = iu
        k, own, models = self.k, self.own, len(self.models)
        left_out = np.array([f for _, f in self.models])
        stats = self._statistics()
        self.n = np.array([stats[f][0] for _, f in self.models])
        self.scale = np.array([np.append(np.sqrt(stats[f][2]), 1.0) for _, f in self.models])
        self.constant = self.scale <= 0
        self.scale = np.where(self.constant, 1.0, self.scale)
        blocks = [(c, d) for c in range(own) for d in range(c, own)]
        self.blocks = blocks

        def step_for(b: np.ndarray):
            def step(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
                w = (fold[:, None] != left_out).astype(np.float64)
                p, logp = _probabilities(x, b)
                loss = -(w * np.take_along_axis(logp, y[:, None, None].astype(np.int64), axis=2)[:, :, 0]).sum(axis=0)
                shown = p if own > 1 else p[:, :, 1:]
                hit = (y[:, None] == (np.arange(own) if own > 1 else np.ones(1))).astype(np.float64)
                g = np.einsum("mac,mk->ack", (shown - hit[:, None, :]) * w[:, :, None], x, optimize=True)
                q = x[:, iu[0]] * x[:, iu[1]]
                h = [(w * shown[:, :, c] * ((c == d) - shown[:, :, d])).T @ q for c, d in blocks]
                return np.concatenate([loss, g.ravel(), np.stack(h, axis=1).ravel()])

            return step

        self.step_for = step_for
        self.width = models * (1 + own * k + len(blocks) * len(iu[0]))

    def _statistics(self) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
        """Rows, means and sample variances of the features without each fold, and of all."""
        k, folds = self.k, self.folds
        total = _sums(self.rows, lambda x, y, f: np.concatenate([[len(x)], x[:, :-1].sum(axis=0)]), k)
        center = total[1:] / max(total[0], 1)

        def moments(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            z, out = x[:, :-1] - center, np.zeros((folds, 2 * k - 1))
            for f in range(folds):
                own = z[fold == f]
                out[f] = np.concatenate([[len(own)], own.sum(axis=0), (own**2).sum(axis=0)])
            return out.ravel()

        each = _sums(self.rows, moments, folds * (2 * k - 1)).reshape(folds, -1)
        out = {}
        for f in range(folds + 1):
            n, s, q = np.split(each.sum(axis=0) - (each[f] if f < folds else 0), [1, k])
            n = int(n[0])
            variance = np.maximum(q - s * s / max(n, 1), 0) / max(n - 1, 1)
            # What is left of a constant column is rounding.
            out[f] = n, center + s / max(n, 1), np.where(variance > 1e-20 * np.maximum(center**2, 1e-300), variance, 0.0)
        return out

    def evaluate(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean loss, gradient and curvature of every model, in scaled coefficients."""
        models, own, k = len(self.models), self.own, self.k
        found = _sums(self.rows, self.step_for(b), self.width)
        loss, g, h = np.split(found, [models, models * (1 + own * k)])
        n = np.maximum(self.n, 1)
        g = g.reshape(models, own, k) / self.scale[:, None, :] / n[:, None, None]
        h = h.reshape(models, len(self.blocks), -1)
        whole = np.zeros((models, own, k, own, k))
        for i, (c, d) in enumerate(self.blocks):
            block = np.zeros((models, k, k))
            block[:, self.pairs[0], self.pairs[1]] = block[:, self.pairs[1], self.pairs[0]] = h[:, i]
            whole[:, c, :, d, :] = whole[:, d, :, c, :] = block
        s = np.broadcast_to(self.scale[:, None, :], (models, own, k)).reshape(models, -1)
        whole = whole.reshape(models, own * k, own * k) / s[:, :, None] / s[:, None, :] / n[:, None, None]
        return loss / n, g.reshape(models, -1), whole

    def penalty(self, m: int, beta: np.ndarray) -> float:
        p, b = self.models[m][0], beta.reshape(self.own, self.k)[:, :-1]
        return p.reg * ((1 - p.alpha) / 2 * float((b * b).sum()) + p.alpha * float(np.abs(b).sum()))

    def steps(self, beta: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """For every model the minimum of its quadratic approximation plus its penalty."""
        models, size = beta.shape
        free = np.tile(np.append(np.zeros(self.k - 1), 1.0), self.own) > 0
        fixed = np.tile(self.constant, self.own)  # a constant feature has no coefficient
        reg, alpha = (np.array([getattr(p, part) for p, _ in self.models])[:, None] for part in ("reg", "alpha"))
        ridge, l1 = np.where(free, 0.0, reg * (1 - alpha)), np.where(free, 0.0, reg * alpha)
        # Minimise linear'b + b'hb/2 + l1 |b|. The ridge is part of h; its own gradient at beta is added to g.
        h = h.copy()
        diagonal = np.arange(size)
        h[:, diagonal, diagonal] += ridge + 1e-10 * np.maximum(np.trace(h, axis1=1, axis2=2), 1e-12)[:, None]
        linear = g + ridge * beta - np.einsum("mjk,mk->mj", h, beta)
        h[fixed[:, :, None] | fixed[:, None, :]] = 0.0
        h[:, diagonal, diagonal] += fixed
        linear[fixed] = 0.0
        out = np.where(fixed, 0.0, beta)
        left = []
        for m in range(models):
            if not l1[m].any():
                out[m] = np.linalg.solve(h[m], -linear[m])
            else:
                left.append(m)
        for _ in range(300):
            if not left:
                break
            # Some sweeps over the coordinates find the signs; then the signs give the minimum.
            hs, b, lin, pull = h[left], out[left], linear[left], l1[left]
            product = np.einsum("mjk,mk->mj", hs, b)
            for _ in range(8):
                for j in range(size):
                    own = hs[:, j, j]
                    rest = lin[:, j] + product[:, j] - own * b[:, j]
                    new = np.sign(-rest) * np.maximum(np.abs(rest) - pull[:, j], 0.0) / own
                    product += hs[:, :, j] * (new - b[:, j])[:, None]
                    b[:, j] = new
            out[left] = b
            still = []
            for i, m in enumerate(left):
                on = np.flatnonzero((b[i] != 0) | (pull[i] == 0))
                sign = np.sign(b[i][on]) * pull[i][on]
                exact = np.zeros(size)
                exact[on] = np.linalg.solve(hs[i][np.ix_(on, on)], -(lin[i][on] + sign))
                slope = lin[i] + hs[i] @ exact
                fits = (np.sign(exact[on]) * pull[i][on] == sign).all() and (np.abs(slope) <= pull[i] * (1 + 1e-9) + 1e-12)[exact == 0].all()
                if fits:
                    out[m] = exact
                else:
                    still.append(m)
            left = still
        return out

    def solve(self) -> np.ndarray:
        """Coefficients (models x classes x features, the intercept last) of all models."""
        models = len(self.models)
        size = self.own * self.k
        beta, objective, step = np.zeros((models, size)), np.full(models, np.inf), np.zeros((models, size))
        settled = np.zeros(models, dtype=bool)
        for _ in range(MAX_STEPS):
            tried = beta + step
            loss, g, h = self.evaluate((tried.reshape(models, self.own, self.k)) / self.scale[:, None, :])
            now = np.array([loss[m] + self.penalty(m, tried[m]) for m in range(models)])
            better = (now <= objective + 1e-12) & ~settled
            target = self.steps(tried, g, h)
            objective, beta = np.where(better, now, objective), np.where(better[:, None], tried, beta)
            # Forward from a better point, half the way back from one too far.
            step = np.where(better[:, None], target - tried, np.where(settled[:, None], 0.0, step / 2))
            settled |= np.abs(step).max(axis=1) <= TOLERANCE * np.maximum(1.0, np.abs(beta).max(axis=1))
            # Nor is there a way to go where the approximation promises nothing (flat directions).
            promised = (g * step).sum(axis=1) + 0.5 * np.einsum("mj,mjk,mk->m", step, h, step)
            promised += [self.penalty(m, tried[m] + step[m]) - self.penalty(m, tried[m]) for m in range(models)]
            settled |= better & (-promised <= GAIN * np.maximum(1.0, np.abs(now)))
            step[settled] = 0.0
            if settled.all():
                break
        return beta.reshape(models, self.own, self.k) / self.scale[:, None, :]


def tune_logistic(
    train: DataFrame, points: Sequence[Point], fold: Column, folds: int = 5, metric: str = "auc", features: str = "features", label: str = "label"
) -> Tuned:
    """Cross-validation of all ``points`` over ``fold`` (0 to ``folds`` - 1 per row) and the best
    one's model of all rows. ``metric``: ``auc`` (two classes; exact, ties half) or ``f1``
    (weighted). Two scans for statistics, about eight for all fits, and one for the scores."""
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"), fold.cast("int").alias("fold"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size, classes = rows.agg(F.max(F.size("x")), F.max("y") + 1).first()
        if size is None:
            raise ValueError("no rows to learn from")
        problem = _Problem(rows, points, folds, max(int(classes), 2), int(size))
        b = problem.solve()
        scores = _validated(rows, problem, b, metric)
    finally:
        rows.unpersist()
    best = int(np.argmax(scores))
    chosen = b[best * (folds + 1) + folds]
    return Tuned(list(points), scores, best, chosen[:, :-1], chosen[:, -1])


def _validated(rows: DataFrame, problem: _Problem, b: np.ndarray, metric: str) -> list[float]:
    """The mean over folds of each point's score on the rows that its model did not see."""
    folds, n_points = problem.folds, len(problem.points)
    by_fold = b.reshape(n_points, folds + 1, *b.shape[1:])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                x, y, fold = _columns(batch.slice(at, _ROWS))
                for f in np.unique(fold).tolist():
                    own = fold == f
                    p, _ = _probabilities(x[own], by_fold[:, f])
                    m = int(own.sum())
                    made = [np.repeat(np.arange(n_points), m), np.full(m * n_points, f), np.tile(y[own], n_points),
                            p[:, :, 1].T.ravel(), p.argmax(axis=2).T.ravel()]
                    types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(made, types, strict=True)], ["point", "fold", "y", "score", "guess"])

    judged = rows.mapInArrow(judge, "point int, fold int, y int, score double, guess int")
    if metric == "auc":
        found = grouped_auc(judged, ["point", "fold"], "score", "y").groupBy("point").agg(F.avg("auc").alias("score"))
    else:
        cells = judged.groupBy("point", "fold", "y", "guess").agg(F.count(F.lit(1)).alias("n"))
        truth = cells.groupBy("point", "fold", F.col("y").alias("c")).agg(F.sum("n").alias("t"), F.sum(F.when(F.col("y") == F.col("guess"), F.col("n")).otherwise(0)).alias("tp"))
        guess = cells.groupBy("point", "fold", F.col("guess").alias("c")).agg(F.sum("n").alias("g"))
        each = truth.join(guess, ["point", "fold", "c"], "left").withColumn("g", F.coalesce("g", F.lit(0)))
        f1 = F.sum(F.col("t") * 2.0 * F.col("tp") / (F.col("t") + F.col("g"))) / F.sum("t")
        found = each.groupBy("point", "fold").agg(f1.alias("f1")).groupBy("point").agg(F.avg("f1").alias("score"))
    got = {r["point"]: r["score"] for r in found.collect()}  # a row per grid point
    return [got.get(k) if got.get(k) is not None else float("nan") for k in range(n_points)]


def predict(df: DataFrame, tuned: Tuned, features: str = "features") -> DataFrame:
    """``df`` with ``prediction`` and, for two classes, ``score`` (the probability of class 1):
    products of arrays, without Python."""
    x = vector_to_array(features)

    def logit(c: int) -> Column:
        weights = F.array(*[F.lit(float(v)) for v in tuned.coefficients[c]])
        return F.aggregate(F.zip_with(x, weights, lambda a, w: a * w), F.lit(float(tuned.intercepts[c])), lambda s, t: s + t)

    if len(tuned.intercepts) == 1:
        made = df.withColumn("score", 1.0 / (1.0 + F.exp(-logit(0))))
        return made.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    logits = F.array(*[logit(c) for c in range(len(tuned.intercepts))])
    made = df.withColumn("_logits", logits)
    return made.withColumn("prediction", (F.array_position("_logits", F.array_max("_logits")) - 1).cast("double")).drop("_logits")
