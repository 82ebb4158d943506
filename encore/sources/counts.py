"""Row counts per data set."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One ``(data_set, n_rows)`` row per frame.

    Each count is an aggregate without columns (Parquet answers it from
    footers); the one-row results are stacked with ``unionByName``.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("data_set"), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def line_counts(lines: DataFrame) -> DataFrame:
    """Lines per input file of a text read (``wc -l`` for every file in one job)."""
    return lines.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_lines"))
