"""Roles of the driver tables.

The operators speak of interactions, correction logs, feature sets and labels;
the driver ships a TPC-H-like star schema plus text and vector tables. This
module maps one onto the other with plain projections and joins, all lazy, so
every query still scans the given Parquet tables and grows with them.

| role                        | source                                                            |
| --------------------------- | ----------------------------------------------------------------- |
| interactions (user, item)   | lineitem joined to orders: o_custkey, l_partkey, int(l_quantity)  |
| error / accepted records    | part with p_type PROMO / and p_size <= 10                         |
| correction log lines        | text composed from every part row; p_size 50 (errors) and 1       |
|                             | (accepted) lines lose their side delimiter                        |
| feature set                 | embeddings: all 64 elements as doubles f0..f63, id vec_id         |
| labels                      | documents: doc_id as track id, lang as genre                      |
| scored pairs (ranking)      | interactions grouped by pair: max price = prediction, plays sum   |
| fixed binary scores         | lineitem: returnflag R as label, quantity > 25 as prediction      |
| fixed multi-class scores    | embeddings.label and a shifted copy of it as prediction          |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.logs import ACCEPTED_PREFIX, ERROR_PREFIX, SIDE_DELIMITER, compose_log_line

# The given tables.
TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents embeddings "
               "pages benchmark labels conversations").split()

# Fixed values of the role mapping.
N_FEATURES = 64  # all values of an embedding
MIN_ITEMS_PER_USER = 30
MIN_PLAYS_PER_ITEM = 650
TOP_N = 10
POSITIVE_GENRE = "es"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, song_id, plays, row_key)``: one row per line item.

    ``row_key`` identifies the row for repeatable splits; it is pruned by the
    optimizer wherever it is not used.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    return joined.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("song_id"),
        F.col("l_quantity").cast("int").alias("plays"),
        F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("row_key"),
    )


def base_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three columns of the reference's interaction table."""
    return interactions(spark, sf_dir).select("user_id", "song_id", "plays")


def _correction_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    key = F.col("p_partkey").cast("string")
    return part.select(
        "p_partkey",
        "p_type",
        "p_size",
        F.concat(F.lit("SO"), F.lpad(key, 16, "0")).alias("song_id"),
        F.col("p_brand").alias("song_artist"),
        F.col("p_name").alias("song_title"),
        F.concat(F.lit("TR"), F.lpad(key, 16, "0")).alias("track_id"),
        F.col("p_type").alias("track_artist"),
        F.concat_ws(" - ", F.col("p_name"), F.col("p_size").cast("string")).alias("track_title"),
    )


def _line(prefix, broken):
    good = compose_log_line(
        "", F.col("song_id"), F.col("song_artist"), F.col("song_title"),
        F.col("track_id"), F.col("track_artist"), F.col("track_title"),
    )
    body = F.when(broken, F.replace(good, F.lit(SIDE_DELIMITER), F.lit(" != "))).otherwise(good)
    return F.concat(prefix, body)


def error_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per part: ``ERROR: `` lines for PROMO parts, ``INFO: `` otherwise."""
    fields = _correction_fields(spark, sf_dir)
    prefix = F.when(F.col("p_type") == "PROMO", F.lit(ERROR_PREFIX)).otherwise(F.lit("INFO: "))
    return fields.select(_line(prefix, F.col("p_size") == 50).alias("value"))


def accepted_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diff-style lines for PROMO parts: ``< ERROR: `` when accepted (p_size <= 10)."""
    fields = _correction_fields(spark, sf_dir).where(F.col("p_type") == "PROMO")
    prefix = F.when(F.col("p_size") <= 10, F.lit(ACCEPTED_PREFIX)).otherwise(F.lit("> ERROR: "))
    return fields.select(_line(prefix, F.col("p_size") == 1).alias("value"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return part.where(F.col("p_type") == "PROMO").select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_brand").alias("song_artist"),
        F.col("p_name").alias("song_title"),
        F.col("p_partkey").alias("track_id"),
        F.col("p_type").alias("track_artist"),
        F.col("p_size"),
    )


def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatch records keyed by the interaction item id."""
    return _records(spark, sf_dir).drop("p_size")


def accepted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).where(F.col("p_size") <= 10).drop("p_size")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``f0 .. f63`` doubles and ``track_id`` (last, as in the feature files)."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    # A wider vector would lose values unnoticed: that is an error.
    wide = F.raise_error(F.lit(f"an embedding has more than {N_FEATURES} values")).cast("array<float>")
    emb = emb.withColumn("embedding", F.when(F.size("embedding") > N_FEATURES, wide).otherwise(F.col("embedding")))
    return emb.select(
        *[F.get(F.col("embedding"), i).cast("double").alias(f"f{i}") for i in range(N_FEATURES)],
        F.col("vec_id").alias("track_id"),
    )


def genre_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.select(F.col("doc_id").alias("track_id"), F.col("lang").alias("genre"))


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id, song_id, prediction, plays)`` with one row per pair."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    return joined.groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("song_id")).agg(
        F.max("l_extendedprice").alias("prediction"),
        F.sum(F.col("l_quantity").cast("int")).alias("plays"),
    )


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label int, prediction double, score double)`` from line items."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return li.select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.when(F.col("l_quantity") > 25, 1.0).otherwise(0.0).alias("prediction"),
        F.col("l_quantity").alias("score"),
    )


def multiclass_scores_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(label double, prediction double)``: every fourth id predicted one class off."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    shift = F.when(F.col("vec_id") % 4 == 0, 1).otherwise(0)
    return emb.select(
        F.col("label").cast("double").alias("label"),
        ((F.col("label") + shift) % 10).cast("double").alias("prediction"),
    )
