"""Column expressions shared by the operators.

Everything here builds ``pyspark.sql.Column`` objects from built-in functions,
so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_split(column: str | Column, delimiter: str) -> Column:
    """Split on an exact delimiter (``split`` takes a Java regex; quote it)."""
    return F.split(col_of(column), "\\Q" + delimiter + "\\E", -1)


def cast_columns(df: DataFrame, columns: Iterable[str], to: str | T.DataType = "double") -> DataFrame:
    """Cast the named columns in one projection; unparsable text becomes null.

    ``try_cast`` keeps the permissive behaviour of the non-ANSI era: ``'x'``
    gives null instead of failing the job.
    """
    wanted = set(columns)
    type_name = to if isinstance(to, str) else to.simpleString()
    return df.select(
        *[
            F.col(c).try_cast(type_name).alias(c) if c in wanted else F.col(c)
            for c in df.columns
        ]
    )


def rename_at(df: DataFrame, position: int, name: str) -> DataFrame:
    """Rename the column at ``position`` (negative counts from the end)."""
    return df.withColumnRenamed(df.columns[position], name)


def unquote_id(column: str | Column, quote: str = "'", width: int = 18) -> Column:
    """Strip a leading quote from an id and keep ``width`` characters.

    Decided per row, so a file that mixes quoted and bare ids is handled too.
    """
    c = col_of(column)
    return F.when(c.startswith(quote), F.substring(c, 2, width)).otherwise(c)


def binary_label(column: str | Column, positive: str) -> Column:
    """1 where the value equals ``positive``, else 0 (null counts as 0)."""
    return F.when(col_of(column) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), dtype: str = "double") -> list[str]:
    """Columns of the given type, read from the schema only (no job)."""
    skip = set(exclude)
    return [name for name, t in df.dtypes if t == dtype and name not in skip]


#: Values of the first seven hexadecimal digits of an md5: the finest buckets.
HASH_RANGE = 1 << 28
#: Stands for a null key, which no text value equals in practice.
NULL_KEY = "\u0000null"


def hash_bucket(keys: Sequence[str | Column], salt: str = "", buckets: int = HASH_RANGE) -> Column:
    """Stable bucket in [0, buckets) from the md5 of the key columns.

    Independent of partitioning and of the engine: the same value comes out of
    ``conv(substr(md5(k), 1, 7), 16, 10) % buckets`` in any SQL engine. A null
    key has a bucket of its own.
    """
    parts = [F.coalesce(col_of(k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    if salt:
        parts = [F.lit(salt)] + parts
    key = parts[0] if len(parts) == 1 else F.concat_ws(":", *parts)
    return (F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that yields null for a zero or null denominator."""
    return F.try_divide(col_of(numerator).cast("double"), col_of(denominator).cast("double"))
