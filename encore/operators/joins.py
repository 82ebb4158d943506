"""Equi-joins of the cleaning chain: block lists, label attachment, key filters.

Join strategy: by default nothing is hinted. Catalyst broadcasts a side only
when its size estimate -- an upper bound taken from the files it scans -- is
under ``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is a shuffle
join, and adaptive execution re-plans it from the measured size of the
finished shuffle (a broadcast when that side turned out small) and splits
skewed partitions of the big side. When the small side is cheap to count (a
filtered dimension table), ``broadcast_rows`` adds an explicit bounded check:
at most ``broadcast_rows + 1`` rows are read, and only a side within the bound
is hinted for broadcast.

Where the other side is an aggregate already partitioned by the join key (the
active-user and popular-item lists), no exchange sits under it and adaptive
execution cannot split a hot key; :func:`split_hot_keys` then salts keys with
more than ``HOT_KEY_ROWS`` rows over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds for explicit broadcasts: rows and bytes of a key list. Rows that make a key hot,
# and the most keys a hot-key list may hold.
DEFAULT_BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes (16 a
    value, and the text of strings), reading no more than ``max_rows + 1`` rows."""
    width = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint ``df`` for broadcast only when it has at most ``max_rows`` rows and
    ``BROADCAST_BYTES`` bytes.

    The check reads no more than ``max_rows + 1`` rows (``limit`` stops the
    scan early), so it costs at most one pass over the small side. ``None``
    or ``0`` leaves the choice to the optimizer and adaptive execution.
    """
    if not max_rows:
        return df
    return F.broadcast(df) if fits(df, max_rows) else df


def hot_keys(df: DataFrame, key: str | Sequence[str], min_rows: int) -> DataFrame:
    """Keys holding more than ``min_rows`` rows of ``df`` with their row count
    ``_n`` (fewer than ``rows / min_rows`` keys), from one partially aggregated count."""
    keys = _keys(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > F.lit(min_rows))


def _filter_join(df, right, keys, how, broadcast_rows, hot_rows, hot):
    right = right.select(*keys)
    if broadcast_rows and fits(right, broadcast_rows):
        return df.join(F.broadcast(right), on=keys, how=how).select(*df.columns)
    if hot is not None or hot_rows:
        rows = hot_rows or HOT_KEY_ROWS
        return split_hot_keys(df, right, keys, how, hot if hot is not None else hot_keys(df, keys, rows), rows)
    return df.join(right, on=keys, how=how).select(*df.columns)


def split_hot_keys(
    df: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    how: str,
    hot: DataFrame,
    rows_per_task: int = HOT_KEY_ROWS,
    seed: int = 17,
) -> DataFrame:
    """A semi or anti join of ``df`` with the keys of ``right`` in which every
    hot key is spread over several tasks (salting).

    ``hot`` lists keys of ``df`` with their row count ``_n``. Of them the
    ``MAX_HOT_KEYS`` with most rows are split, so the broadcast list has a
    constant bound; any other key holds less than ``rows / MAX_HOT_KEYS`` rows.
    A hot key with ``n`` rows gets a fan-out of
    ``ceil(n / rows_per_task)``: its rows in ``df`` draw a salt in
    ``[0, fan)``, its rows in ``right`` are repeated once per salt, and the
    join runs on ``(key, salt)``, so no task receives more than about
    ``rows_per_task`` rows of one key. Every other key has salt 0 on both
    sides. Since a hot key of ``right`` carries every salt, the result is the
    plain join whatever salt a row has. The salt is a hash of the whole row, so
    a repeated task sends each row to the same place again. One shuffle of
    ``df``, like the plain join.

    Needed where ``right`` is an aggregate already partitioned by the key:
    then no exchange sits under that side and adaptive execution cannot split
    the hot partition by itself.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError("how must be 'left_semi' or 'left_anti'")
    keys = _keys(key)
    fan = F.ceil(F.col("_n") / F.lit(float(rows_per_task))).cast("int")
    most = hot.orderBy(F.col("_n").desc(), *keys).limit(MAX_HOT_KEYS)  # keys are unique: the same list each time
    tag = F.broadcast(most.select(*keys, fan.alias("_fan")))
    row = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns])
    salt = F.when(F.col("_fan").isNull(), F.lit(0)).otherwise(F.pmod(row, F.col("_fan")).cast("int"))
    left = df.join(tag, on=keys, how="left").withColumn("_salt", salt)
    salts = F.when(F.col("_fan").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_fan") - 1))
    right_salted = right.select(*keys).join(tag, on=keys, how="left").select(*keys, F.explode(salts).alias("_salt"))
    return left.join(right_salted, on=keys + ["_salt"], how=how).select(*df.columns)


def blocklist(errors: DataFrame, accepted: DataFrame, key: str | Sequence[str] = "song_id") -> DataFrame:
    """Errors whose key was not accepted (``NOT EXISTS`` semantics).

    Only the key matters: other columns such as the track id are ignored.
    """
    keys = _keys(key)
    return errors.join(accepted.select(*keys).distinct(), on=keys, how="left_anti").select(*errors.columns)


def exclude(
    df: DataFrame,
    blocked: DataFrame,
    key: str | Sequence[str] = "song_id",
    broadcast_rows: int | None = None,
    hot_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``blocked``; null keys are kept.

    ``broadcast_rows``: broadcast ``blocked`` when it has at most that many
    rows. Otherwise ``hot`` (keys of ``df`` known to be hot, with row counts
    ``_n``) or ``hot_rows`` (find keys of ``df`` with more rows than that)
    spreads hot keys over several tasks (:func:`split_hot_keys`).
    """
    return _filter_join(df, blocked, _keys(key), "left_anti", broadcast_rows, hot_rows, hot)


def keep_matching(
    df: DataFrame,
    allowed: DataFrame,
    key: str | Sequence[str],
    broadcast_rows: int | None = None,
    hot_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``allowed`` (semi join, no columns
    added); ``broadcast_rows``, ``hot_rows`` and ``hot`` as in :func:`exclude`."""
    return _filter_join(df, allowed, _keys(key), "left_semi", broadcast_rows, hot_rows, hot)


def attach_labels(features: DataFrame, labels: DataFrame, key: str | Sequence[str] = "track_id") -> DataFrame:
    """Inner join of a feature table with its labels; unlabelled rows drop out."""
    return features.join(labels, on=_keys(key), how="inner")


def cold_start(test: DataFrame, train: DataFrame, key: str | Sequence[str] = "user_id") -> DataFrame:
    """Test rows whose key never occurs in the training rows."""
    keys = _keys(key)
    return test.join(train.select(*keys).distinct(), on=keys, how="left_anti").select(*test.columns)
