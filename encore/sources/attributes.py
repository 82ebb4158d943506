"""Schemas held as data: one ``name,type`` row per column of a feature set."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.sources.delimited import read_delimited

# Attribute type names of the feature sets and their Spark types.
ATTRIBUTE_TYPES: Mapping[str, T.DataType] = {
    "NUMERIC": T.DoubleType(),
    "real": T.DoubleType(),
    "string": T.StringType(),
    "STRING": T.StringType(),
}

ATTRIBUTE_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType(), True), T.StructField("type", T.StringType(), True)]
)


class UnknownAttributeType(KeyError):
    pass


def read_attributes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Attribute rows ``(position, name, type)`` in the order of the paths, of the file
    names below a path, and of the lines of a file.

    Spark packs larger files first, so ``monotonically_increasing_id`` alone
    orders only the lines of one file; ``position`` holds path and file before it.
    """
    parts = []
    for i, one in enumerate([path] if isinstance(path, str) else path):
        rows = read_delimited(spark, one, schema=ATTRIBUTE_SCHEMA, sep=",")
        position = F.struct(
            F.lit(i).alias("path"),
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("line"),
        )
        parts.append(rows.select(position.alias("position"), F.trim("name").alias("name"), F.trim("type").alias("type")))
    return reduce(DataFrame.union, parts)


def schema_from_attributes(
    attributes: DataFrame, type_map: Mapping[str, T.DataType] = ATTRIBUTE_TYPES
) -> T.StructType:
    """Build a nullable ``StructType`` from the attribute rows.

    The attribute table has one row per column (tens to hundreds), so it is
    brought to the driver once; an unknown type name is reported by attribute.
    """
    ordered = attributes.orderBy("position") if "position" in attributes.columns else attributes
    fields = []
    for row in ordered.select("name", "type").collect():
        if row["type"] not in type_map:
            raise UnknownAttributeType(
                f"attribute {row['name']!r} has type {row['type']!r}; known: {sorted(type_map)}"
            )
        fields.append(T.StructField(row["name"], type_map[row["type"]], True))
    return T.StructType(fields)


def read_feature_set(
    spark: SparkSession,
    attributes_path: str,
    data_path: str,
    type_map: Mapping[str, T.DataType] = ATTRIBUTE_TYPES,
) -> DataFrame:
    """Load one feature set with the schema its attribute file describes."""
    schema = schema_from_attributes(read_attributes(spark, attributes_path), type_map)
    return read_delimited(spark, data_path, schema=schema, sep=",")


def read_feature_sets(
    spark: SparkSession, root: str, names: list[str], type_map: Mapping[str, T.DataType] = ATTRIBUTE_TYPES
) -> dict[str, DataFrame]:
    """Several feature sets laid out as ``root/attributes/<name>.attributes.csv``
    and ``root/features/<name>.csv``; the frames are lazy."""
    return {
        name: read_feature_set(
            spark, f"{root}/attributes/{name}.attributes.csv", f"{root}/features/{name}.csv", type_map
        )
        for name in names
    }


# Text forms of whole and of other numbers.
WHOLE, NUMBER = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: The attribute type of a column, by the widest value in it: none, whole, other number, text.
WIDTHS = ("empty", "NUMERIC", "real", "string")


def _width(df: DataFrame, column: str) -> Column:
    """The place in ``WIDTHS`` of the text form of one value."""
    x, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        width = F.lit(1)
    elif isinstance(kind, T.StringType):
        width = F.when(x.rlike(WHOLE), 1).when(x.rlike(NUMBER), 2).otherwise(3)
    elif isinstance(kind, (T.FractionalType, T.DecimalType)):
        # Their text has a point or an exponent, but for values that are no numbers.
        width = F.when(x.cast("string").rlike(NUMBER), 2).otherwise(3)
        if isinstance(kind, T.DecimalType) and kind.scale == 0:
            width = F.lit(1)
    else:
        width = F.lit(3)
    return F.when(x.isNull(), 0).otherwise(width)


def column_types(df: DataFrame) -> DataFrame:
    """``(name, type)`` of every column, found in its values: one partially aggregated scan
    for the widest value of each. Text that spells numbers counts as numbers."""
    widest = df.agg(*[F.coalesce(F.max(_width(df, c)), F.lit(0)).alias(f"w{i}") for i, c in enumerate(df.columns)])
    types = F.array(*[F.lit(t) for t in WIDTHS])
    cells = [F.struct(F.lit(c).alias("name"), F.get(types, F.col(f"w{i}")).alias("type")) for i, c in enumerate(df.columns)]
    return widest.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def attribute_types(attributes: DataFrame) -> DataFrame:
    """Distinct type names (case kept) with the number of attributes of each."""
    return attributes.groupBy("type").agg(F.count(F.lit(1)).alias("n_attributes"))
