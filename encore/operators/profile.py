"""Descriptive statistics: column profiles, quantiles, correlation, class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.gram import pair_statistics
from encore.operators.ordering import running_sums

DEFAULT_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)


def _rows(*structs):
    """Explode a one-row frame of structs into rows (a transpose without pandas)."""
    return F.explode(F.array(*structs))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``count, mean, stddev (sample), min, max``.

    A single aggregate computes all statistics of all columns in one pass; the
    one-row result is turned into rows with ``explode``. Values stay numeric
    (``describe()`` would return strings).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.agg(*aggs)
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__count").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__stddev").alias("stddev"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
        )
        for c in columns
    ]
    return wide.select(_rows(*structs).alias("s")).select("s.*")


def exact_quantiles(
    df: DataFrame, column: str, probs: Sequence[float] = DEFAULT_PROBS, partitions: int | None = None
) -> DataFrame:
    """``(prob, value)``: the first value whose cumulative share reaches ``prob``
    (``percentile_disc``), exact.

    Values are first reduced to ``(value, count)`` with a partial aggregate --
    a value held by a third of the rows is one row after it -- and the
    cumulative counts come from :func:`running_sums`, so no task sees all rows.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(counts, [column], {"c": F.col("_n")}, partitions)
    reached = F.col("c_before") + F.col("_n")
    picks = cum.agg(
        *[F.min(F.when(reached >= F.lit(float(p)) * F.col("c_total"), F.col(column))).alias(f"q{i}")
          for i, p in enumerate(probs)]
    )
    structs = [F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probs)]
    return picks.select(_rows(*structs).alias("s")).select("s.*")


def exact_quantiles_stacked(
    parts: Sequence[tuple[str, DataFrame, str]],
    probs: Sequence[float] = DEFAULT_PROBS,
    partitions: int | None = None,
) -> DataFrame:
    """``(measure, prob, value)`` for several ``(measure, frame, column)`` at once.

    The columns are stacked as ``(measure, value)`` rows (values of one type),
    reduced to distinct pairs with counts, and one pass of
    :func:`running_sums` ordered by ``(measure, value)`` serves every measure:
    a measure's own cumulative count is the global one minus the rows of the
    measures before it, taken from a table with one row per measure.
    """
    counts = _stack(parts).groupBy("measure", "value").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(counts, ["measure", "value"], {"c": F.col("_n")}, partitions)
    per_measure = cum.groupBy("measure").agg(F.min("c_before").alias("_start"), F.sum("_n").alias("_size"))
    within = cum.join(F.broadcast(per_measure), "measure").select(
        "measure", "value", (F.col("c_before") - F.col("_start") + F.col("_n")).alias("_reached"), "_size"
    )
    picks = within.groupBy("measure").agg(
        *[F.min(F.when(F.col("_reached") >= F.lit(float(p)) * F.col("_size"), F.col("value"))).alias(f"q{i}")
          for i, p in enumerate(probs)]
    )
    structs = [F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probs)]
    return picks.select("measure", _rows(*structs).alias("s")).select("measure", "s.*")


def approx_quantiles(
    df: DataFrame, column: str, probs: Sequence[float] = DEFAULT_PROBS, rel_err: float = 0.05
) -> DataFrame:
    """``(prob, value)`` from the mergeable quantile sketch of ``percentile_approx``."""
    accuracy = max(1, int(round(1.0 / rel_err)))
    arr = df.agg(F.percentile_approx(column, [float(p) for p in probs], accuracy).alias("v"))
    structs = [F.struct(F.lit(float(p)).alias("prob"), F.get(F.col("v"), i).alias("value"))
               for i, p in enumerate(probs)]
    return arr.select(_rows(*structs).alias("s")).select("s.*")


def quantile_rank_check(df: DataFrame, column: str, quantiles: DataFrame, rel_err: float) -> DataFrame:
    """For each ``(prob, value)``, whether some rank of ``value`` lies within
    ``rel_err * n`` of ``prob * n`` -- the guarantee of the approximate sketch.

    The handful of quantile values is brought to the driver and turned into
    conditional counts, so the data is scanned once and never joined.
    """
    picks = [(r["prob"], r["value"]) for r in quantiles.collect()]
    x = F.col(column)
    aggs = [F.count(x).alias("n")]
    for i, (_, v) in enumerate(picks):
        aggs += [F.count_if(x < F.lit(v)).alias(f"lt{i}"), F.count_if(x <= F.lit(v)).alias(f"le{i}")]
    counts = df.agg(*aggs)
    n = F.col("n").cast("double")
    structs = []
    for i, (p, v) in enumerate(picks):
        lo, hi = F.col(f"lt{i}") + 1, F.col(f"le{i}")
        target, slack = F.lit(float(p)) * n, F.lit(float(rel_err)) * n
        structs.append(F.struct(
            F.lit(float(p)).alias("prob"),
            F.lit(v).alias("value"),
            lo.alias("rank_lo"),
            hi.alias("rank_hi"),
            ((lo <= target + slack) & (hi >= target - slack)).alias("within_bound"),
        ))
    return counts.select(_rows(*structs).alias("s")).select("s.*")


def _stack(parts: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    stacked = None
    for measure, df, column in parts:
        one = df.where(F.col(column).isNotNull()).select(F.lit(measure).alias("measure"), F.col(column).alias("value"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return stacked


def approx_quantiles_checked(
    parts: Sequence[tuple[str, DataFrame, str]],
    probs: Sequence[float] = DEFAULT_PROBS,
    rel_err: float = 0.05,
) -> DataFrame:
    """``(measure, prob, value, rank_lo, rank_hi, within_bound)`` for several
    measures: one grouped sketch pass gives the approximate quantiles, one
    grouped pass of conditional counts checks each against the sketch's rank
    guarantee. Only the ``measures x probs`` values come to the driver."""
    stacked = _stack(parts)
    accuracy = max(1, int(round(1.0 / rel_err)))
    sketch = stacked.groupBy("measure").agg(
        F.percentile_approx("value", [float(p) for p in probs], accuracy).alias("v")
    ).collect()
    values = {r["measure"]: list(r["v"]) for r in sketch}
    m, x = F.col("measure"), F.col("value")
    aggs = [F.count(x).alias("n")]
    for i in range(len(probs)):
        v = None
        for measure, vals in values.items():
            v = F.when(m == measure, F.lit(vals[i])) if v is None else v.when(m == measure, F.lit(vals[i]))
        aggs += [F.count_if(x < v).alias(f"lt{i}"), F.count_if(x <= v).alias(f"le{i}")]
    counts = stacked.groupBy("measure").agg(*aggs)
    n = F.col("n").cast("double")
    structs = []
    for i, p in enumerate(probs):
        chosen = None
        for measure, vals in values.items():
            chosen = F.when(m == measure, F.lit(vals[i])) if chosen is None else chosen.when(m == measure, F.lit(vals[i]))
        lo, hi = F.col(f"lt{i}") + 1, F.col(f"le{i}")
        target, slack = F.lit(float(p)) * n, F.lit(float(rel_err)) * n
        structs.append(F.struct(
            F.lit(float(p)).alias("prob"), chosen.alias("value"), lo.alias("rank_lo"), hi.alias("rank_hi"),
            ((lo <= target + slack) & (hi >= target - slack)).alias("within_bound"),
        ))
    return counts.select("measure", _rows(*structs).alias("s")).select("measure", "s.*")


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, ``(feature_x, feature_y, r)``.

    One scan through :func:`encore.operators.gram.pair_statistics`; the plan is the same for
    any number of columns. A pair is correlated over the rows that hold both values; ``r`` is
    null where a column is constant there and NaN where a value is not finite.
    """
    pairs = pair_statistics(df, columns).where("x < y")
    r = F.col("co") / F.sqrt(F.col("ss_x")) / F.sqrt(F.col("ss_y"))
    r = F.when((F.col("ss_x") > 0) & (F.col("ss_y") > 0), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    r = F.when(F.col("odd") > 0, F.lit(float("nan"))).otherwise(r)
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(F.get(names, F.col("x")).alias("feature_x"), F.get(names, F.col("y")).alias("feature_y"), r.alias("r"))


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Correlation of many columns through one Gram-matrix pass of Spark ML,
    returned long as ``(feature_x, feature_y, r)`` for ``x < y``; a constant
    column gives NaN."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="error").transform(
        df.select(*columns)
    )
    matrix = Correlation.corr(vec, "_v", method).head()[0].toArray()
    rows = [(columns[i], columns[j], float(matrix[i][j]))
            for i in range(len(columns)) for j in range(i + 1, len(columns))]
    return df.sparkSession.createDataFrame(rows, "feature_x string, feature_y string, r double")


def correlated_pairs(corr: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs with ``r`` above ``threshold``."""
    return corr.where(F.col("r") > F.lit(threshold))


def drop_correlated(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """Drop the later column of every pair correlated above ``threshold``.

    The pair list has at most ``k*(k-1)/2`` rows for ``k`` columns, so it is
    read on the driver to decide the projection.
    """
    position = {c: i for i, c in enumerate(columns)}
    pairs = correlated_pairs(correlation(df, columns), threshold).collect()
    later = {max(p["feature_x"], p["feature_y"], key=position.__getitem__) for p in pairs}
    return df.drop(*sorted(later))


def class_balance(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per class (or class combination), largest first."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), *[F.col(k).asc() for k in keys])
