"""Physical controls a user sets: shared intermediate tables, persistence,
re-partitioning and single-file output."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from encore.session import default_parallelism, ensure_checkpoint_dir, scratch_path

__all__ = ["default_parallelism", "materialize", "persist_shared", "spread"]


def materialize(df: DataFrame, name: str = "stage", how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder and continue from there.

    For an input that several branches of one plan consume and that is costly
    to recompute (for example a shuffle join). The lineage ends at durable
    storage, so a lost executor costs a re-read, not a recomputation.

    ``how='checkpoint'`` (default) uses ``DataFrame.checkpoint``; with
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` on (as
    :func:`encore.session.build_session` sets it) Spark deletes the files once
    the frame is no longer referenced. ``how='parquet'`` writes a Parquet table
    under the same folder instead: later scans prune columns, which pays off
    for wide tables read by narrow branches, but the files stay until removed.
    """
    spark = df.sparkSession
    if how == "checkpoint":
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    if how == "parquet":
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    raise ValueError("how must be 'checkpoint' or 'parquet'")


def persist_shared(df: DataFrame) -> DataFrame:
    """Keep a frame that several actions reuse (memory first, spilling to disk).
    The caller unpersists it when done."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def spread(df: DataFrame, *keys: str, per_core: int = 4) -> DataFrame:
    """Re-partition to ``per_core`` partitions per available core, by ``keys`` if
    given (so a following per-key step reuses the partitioning)."""
    n = per_core * default_parallelism(df.sparkSession)
    return df.repartition(n, *keys) if keys else df.repartition(n)
