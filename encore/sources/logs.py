"""Correction logs: fixed-width ids followed by a two-level delimited tail.

A log line looks like::

    ERROR: <SO0000000000000042 TR0000000000000077> Artist  -  Title  !=  Artist  -  Title

The prefix (``'ERROR: '`` or ``'< ERROR: '``) selects the lines; the two ids
sit at fixed offsets behind it and the tail is split on the exact delimiters.
Lines that do not split into exactly two halves of two parts each are returned
in a separate ``rejected`` frame instead of stopping the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.columns import literal_split

# Fixed values of the log format.
ID_WIDTH = 18
SIDE_DELIMITER = "  !=  "
FIELD_DELIMITER = "  -  "
ERROR_PREFIX = "ERROR: "
ACCEPTED_PREFIX = "< ERROR: "
FIELDS = ("song_id", "song_artist", "song_title", "track_id", "track_artist", "track_title")


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read a log as one row per line in column ``value`` (splittable text)."""
    return spark.read.text(path)


def parse_correction_log(
    lines: DataFrame, prefix: str = ERROR_PREFIX, column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Parse lines starting with ``prefix`` into the six string fields.

    Offsets follow from the prefix: first id right after one separator
    character, the second id after one more, the tail after two more.
    Returns ``(parsed, rejected)``; ``rejected`` keeps the raw line.
    """
    n = len(prefix)
    v = F.col(column)
    candidates = lines.where(v.startswith(prefix))

    first_id = F.substring(v, n + 2, ID_WIDTH)
    second_id = F.substring(v, n + 3 + ID_WIDTH, ID_WIDTH)
    tail = v.substr(F.lit(n + 5 + 2 * ID_WIDTH), F.length(v))
    sides = literal_split(tail, SIDE_DELIMITER)
    left = literal_split(F.get(sides, 0), FIELD_DELIMITER)
    right = literal_split(F.get(sides, 1), FIELD_DELIMITER)
    well_formed = F.coalesce(
        (F.length(v) >= n + 4 + 2 * ID_WIDTH)
        & (F.size(sides) == 2)
        & (F.size(left) == 2)
        & (F.size(right) == 2),
        F.lit(False),
    )

    staged = candidates.select(
        v.alias("_line"),
        well_formed.alias("_ok"),
        first_id.alias("song_id"),
        F.get(left, 0).alias("song_artist"),
        F.get(left, 1).alias("song_title"),
        second_id.alias("track_id"),
        F.get(right, 0).alias("track_artist"),
        F.get(right, 1).alias("track_title"),
    )
    parsed = staged.where("_ok").select(*FIELDS)
    rejected = staged.where(~F.col("_ok")).select(F.col("_line").alias(column))
    return parsed, rejected


def compose_log_line(prefix: str, song_id, song_artist, song_title, track_id, track_artist, track_title):
    """Inverse of the parser as a column expression (used to build fixtures)."""
    return F.concat(
        F.lit(prefix + "<"), song_id, F.lit(" "), track_id, F.lit("> "),
        song_artist, F.lit(FIELD_DELIMITER), song_title,
        F.lit(SIDE_DELIMITER),
        track_artist, F.lit(FIELD_DELIMITER), track_title,
    )
