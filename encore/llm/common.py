"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir

#: A-Z to a-z on UTF-8 bytes; bytes from 0x80 up belong to longer code points and stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text (``bytes.split`` cuts at exactly
    these six bytes, none of which occurs inside a longer code point)."""
    return text.split()


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_text(column: str = "doc_id") -> Column:
    """The id as text; null ids as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_bucket(modulus: int, column: str = "doc_id") -> Column:
    """``crc32(id as text) mod modulus`` (the folds of the labelled operators)."""
    return (F.crc32(id_text(column).cast("binary")) % F.lit(modulus)).cast("int")


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder and cut the lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's setting by which a write's shuffle files go when the write ends.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffles' files when they end; else these stay on disk until
    the driver happens to collect the plans that made them."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(REMOVE_SHUFFLES)
        else:
            spark.conf.set(REMOVE_SHUFFLES, before)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, empty for null."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so that what a step builds from
    one slice stays small whatever Arrow batch size the session has. After each batch Arrow's
    pool gives back what it needed: workers stay, and would hold it between tasks."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def map_slices(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int = 256
) -> DataFrame:
    """``mapInArrow`` with a function built once per task and applied to small slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in sliced(batches, rows):
            yield step(batch)

    return df.mapInArrow(run, schema)
