"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of whole texts are computed by Spark, transformed towards symmetric shapes, and
summed per class (counts, sums and cross products: one partially aggregated row per class,
from all labelled training rows). The driver turns them into class means and covariances,
shrinks the covariances towards the pooled one and its scaled identity, and keeps their
Cholesky factors. The score is the logistic of the difference of the classes' log
densities (Mahalanobis distances through the cached factors), averaged per statistic.

Defined results: a null or blank text has statistics 0 and gets a score like any other;
rows without label are scored but teach nothing; a null label teaches nothing; with fewer
than two classes in training every score is the share of label 1 (0.5 without labels);
repeated rows count and are scored each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import checkpointed
from encore.llm.quality_rules import SYMBOLS, _count, split_words

SHRINK_TO_POOLED = 0.2
SHRINK_TO_IDENTITY = 0.05


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the transformed statistics ``x0 .. x11`` of each text; native, map-only."""
    df = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    df = df.withColumn("words", split_words(F.col("t"))).withColumn("n", F.size("words"))
    df = df.withColumn("lines", F.split("t", "\n", -1))
    df = df.select(
        "key", "t", "n",
        F.size(F.array_distinct("words")).alias("kinds"),
        F.length("t").alias("chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_again"),
        (F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("upper"),
    )

    def per(count: Column, of: Column) -> Column:
        return F.sqrt(count / F.greatest(of, F.lit(1)))

    t, n, chars = F.col("t"), F.col("n"), F.col("chars")
    xs = [
        F.log1p(n.cast("double")),
        F.log1p(chars / F.greatest(n, F.lit(1))),
        per(_count(t, SYMBOLS), chars),
        per(_count(t, "|"), n),
        per(F.col("upper"), chars),
        per(_count(t, "!"), n),
        per(_count(t, "."), n),
        per(_count(t, ","), n),
        per(_count(t, "0123456789"), chars),
        F.asin(F.sqrt(F.col("kinds") / F.greatest(n, F.lit(1)))),
        per(F.col("n_again"), F.col("n_lines")),
        F.log1p(n / F.col("n_lines")),
    ]
    return df.select(F.col("key").alias(key), *[x.alias(f"x{i}") for i, x in enumerate(xs)])


@dataclass(frozen=True)
class Discriminant:
    """Class means and inverse Cholesky factors, in standardised statistics."""

    centre: np.ndarray
    scale: np.ndarray
    prior: float
    means: tuple[np.ndarray, ...] = ()
    whiten: tuple[np.ndarray, ...] = ()
    log_dets: tuple[float, ...] = ()

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        z = ((x - self.centre) / self.scale - self.means[k]) @ self.whiten[k].T
        return -0.5 * (z * z).sum(axis=1) - 0.5 * self.log_dets[k]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), self.prior)
        gap = self.log_density(x, 1) - self.log_density(x, 0) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(gap / x.shape[1], -500, 500)))


def fit_sums(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], size: int, alpha: float, beta: float) -> Discriminant:
    """From (count, sum, cross products) of each class."""
    counts = {k: sums[k][0] if k in sums else 0.0 for k in (0, 1)}
    total = sum(counts.values())
    if min(counts.values()) < 2:
        prior = counts[1] / total if total else 0.5
        return Discriminant(np.zeros(size), np.ones(size), prior)
    centre = (sums[0][1] + sums[1][1]) / total
    spread = (sums[0][2] + sums[1][2]) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-8))
    means, covs = [], []
    for k in (0, 1):
        n, s, ss = sums[k]
        mean = s / n
        covs.append((ss / n - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / total
    whiten, dets = [], []
    for cov in covs:
        mixed = (1 - alpha) * cov + alpha * pooled
        mixed = (1 - beta) * mixed + beta * max(np.trace(mixed) / size, 1e-6) * np.eye(size)
        factor = np.linalg.cholesky(mixed)
        whiten.append(np.linalg.inv(factor))
        dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(centre, scale, counts[1] / total, tuple(means), tuple(whiten), tuple(dets))


def fit(rows: DataFrame, columns: list[str], label: str, alpha: float = SHRINK_TO_POOLED, beta: float = SHRINK_TO_IDENTITY) -> Discriminant:
    """Fit on all rows of ``rows`` with label 0 or 1: one aggregate, two result rows."""
    size = len(columns)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = {}
    for r in (
        rows.where(F.col(label).isin(0, 1))
        .groupBy(F.col(label).cast("int").alias("k"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in columns],
             *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"p_{i}_{j}") for i, j in pairs])
        .collect()
    ):
        cross = np.zeros((size, size))
        for i, j in pairs:
            cross[i, j] = cross[j, i] = r[f"p_{i}_{j}"]
        sums[r["k"]] = (float(r["n"]), np.array([r[f"s_{c}"] for c in columns]), cross)
    return fit_sums(sums, size, alpha, beta)


def score_documents(
    docs: DataFrame, labels: DataFrame, train: Callable[[], Column], label: str = "quality", key: str = "doc_id"
) -> DataFrame:
    """Every document's key and score; ``train()`` says which rows may teach (by ``key``).

    The narrow statistics are written once to the checkpoint folder and read by both the
    fit and the scoring; only they meet the labels in a shuffle, never the texts.
    """
    stats = checkpointed(statistics(docs, key))
    columns = [c for c in stats.columns if c != key]
    taught = labels.select(F.col(key).alias(key), F.col(label).alias("y")).where(train() & F.col("y").isNotNull())
    model = fit(stats.join(taught, key), columns, "y")

    @F.pandas_udf("double")
    def score(*xs: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.column_stack([x.to_numpy(dtype=float) for x in xs])))

    return stats.select(key, score(*columns).alias("score"))
