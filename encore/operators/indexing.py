"""Value -> dense index by descending frequency (ties by value).

``StringIndexer`` gathers every distinct value into one array on the driver.
Here the distinct values stay distributed: counts come from a partial
aggregate and positions from :func:`encore.operators.ordering.row_numbers`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.joins import broadcast_if_small
from encore.operators.ordering import row_numbers


def index_values(df: DataFrame, column: str, out: str = "index", partitions: int | None = None) -> DataFrame:
    """``(column, n_rows, out)``: most frequent value gets 0.0; nulls are not indexed."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    numbered = row_numbers(counts, [F.col("n_rows").desc(), F.col(column).asc()], "_rn", partitions)
    return numbered.select(column, "n_rows", (F.col("_rn") - 1).cast("double").alias(out))


def apply_index(
    df: DataFrame,
    labels: DataFrame,
    column: str,
    out: str,
    handle_invalid: str = "error",
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Attach ``out`` to every row of ``df``.

    ``handle_invalid``: ``'error'`` fails the job on a null or unseen value,
    ``'skip'`` drops such rows, ``'keep'`` gives them the index ``n_labels``.
    """
    lookup = broadcast_if_small(labels.select(column, F.col("index").alias(out)), broadcast_rows)
    if handle_invalid == "skip":
        return df.join(lookup, column, "inner")
    joined = df.join(lookup, column, "left")
    if handle_invalid == "keep":
        n_labels = labels.count()
        return joined.withColumn(out, F.coalesce(F.col(out), F.lit(float(n_labels))))
    if handle_invalid == "error":
        return joined.withColumn(
            out,
            F.when(F.col(out).isNull(), F.raise_error(F.concat(F.lit(f"unseen or null value in {column}: "),
                                                                F.coalesce(F.col(column).cast("string"), F.lit("null")))))
            .otherwise(F.col(out)),
        )
    raise ValueError(f"handle_invalid must be 'error', 'skip' or 'keep', not {handle_invalid!r}")
