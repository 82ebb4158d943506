"""Delimited text in and out (TSV / CSV, with or without a schema)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that one task may write as a single file.
MAX_SINGLE_FILE_ROWS = 1_000_000


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = False,
) -> DataFrame:
    """Read delimited text.

    With a schema the read is PERMISSIVE: a field that does not parse becomes
    null and surplus fields are dropped. Without one every column is a string
    named ``_c0 .. _cN`` (no inference pass over the data). Compressed input is
    recognised from the file suffix; gzip files are not splittable, so one task
    reads each file.
    """
    reader = spark.read.option("sep", sep).option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(path)


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = False,
    compression: str | None = None,
    single_file: bool = False,
    mode: str = "overwrite",
) -> str:
    """Write delimited text; ``single_file`` writes one part file.

    One file means one writing task, so it is only for small results, such as a
    table handed to a plotting tool: more than ``MAX_SINGLE_FILE_ROWS`` rows raise
    an error. :func:`write_ordered` writes larger ones.
    """
    if single_file and df.limit(MAX_SINGLE_FILE_ROWS + 1).count() > MAX_SINGLE_FILE_ROWS:
        raise ValueError(f"more than {MAX_SINGLE_FILE_ROWS} rows do not go into one file; use write_ordered")
    out = df.repartition(1) if single_file else df
    writer = out.write.mode(mode).option("sep", sep).option("header", str(header).lower())
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def write_ordered(df: DataFrame, path: str, order: Sequence[str | Column], sep: str = ",", partitions: int | None = None) -> DataFrame:
    """Write ``df`` in order as headerless text and return the manifest of its parts.

    The rows are dealt into ranges of ``order``, which tasks sort and write in parallel. The
    parts, read by ``part``, are the sorted table; ``first_row`` and ``first_byte`` say where
    each would stand in one file, so that any tool that joins files by name or offset makes
    that file. ``(part, file, n_rows, n_bytes, first_row, first_byte)``, a row per part.
    """
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.option("sep", sep).csv(path)
    meta = spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("n_bytes")).agg(F.count(F.lit(1)).alias("n_rows"))
    part = F.regexp_extract("file", r"^part-(\d+)", 1).cast("int")
    # One row per part: a window over them all is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    found = meta.select(part.alias("part"), "file", "n_rows", "n_bytes")
    return found.select("*", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_row"), F.coalesce(F.sum("n_bytes").over(before), F.lit(0)).alias("first_byte"))


def read_ordered(spark: SparkSession, path: str, manifest: DataFrame, schema: T.StructType | str, sep: str = ",") -> DataFrame:
    """The rows of :func:`write_ordered` with ``row_no``, their place (from 1) in the whole."""
    rows = read_delimited(spark, path, schema, sep=sep)
    names = rows.columns
    # Within a file, rows come in ascending ids; a file may be read in several splits.
    rows = rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"))
    in_file = Window.partitionBy("file").orderBy("_start", "_id")
    placed = rows.withColumn("_n", F.row_number().over(in_file)).join(F.broadcast(manifest.select("file", "first_row")), "file")
    return placed.select(*names, (F.col("first_row") + F.col("_n")).alias("row_no"))
