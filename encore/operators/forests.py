"""Tree ensembles as tables: nodes as rows, rows routed level by level with joins."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.joins import broadcast_if_small

#: Node rows that may be sent to every task; larger forests are joined by a shuffle.
BROADCAST_NODES = 1_000_000


def forest_nodes(spark: SparkSession, model: RandomForestClassificationModel, path: str) -> DataFrame:
    """``(tree, node, left, right, feature, threshold, votes)``: every node of a fitted forest of
    continuous splits, read from the model as Spark saves it to ``path``. Children are null in
    leaves; ``votes`` are the shares of the classes among a node's training rows."""
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    total = F.aggregate("impurityStats", F.lit(0.0), lambda s, x: s + x)
    return saved.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.transform("impurityStats", lambda x: x / total).alias("votes"),
    )


def route(rows: DataFrame, nodes: DataFrame, key: str, features: str, trees: int, depth: int) -> DataFrame:
    """``(key, tree, path, votes)``: the nodes that every row passes in every tree, root first, and
    the votes of its leaf. ``features`` is an array column. One join per level with the
    nodes, which are sent to the tasks if they are few; the rows are not shuffled then."""
    nodes = broadcast_if_small(nodes, BROADCAST_NODES)
    state = rows.select(F.col(key), F.col(features).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    state = state.withColumn("node", F.lit(0)).withColumn("path", F.array().cast("array<int>")).withColumn("votes", F.lit(None).cast("array<double>"))
    for _ in range(depth + 1):
        level = nodes.withColumnRenamed("votes", "leaf_votes")
        at = state.join(level, ["tree", "node"], "left")
        here = F.col("leaf_votes").isNotNull()  # rows that reached a leaf before have no node any more
        value = F.get("x", F.col("feature"))
        child = F.when(F.col("left").isNotNull(), F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right")))
        state = at.select(
            key, "x", "tree", child.alias("node"), F.when(here, F.concat("path", F.array("node"))).otherwise(F.col("path")).alias("path"),
            F.when(here & F.col("left").isNull(), F.col("leaf_votes")).otherwise(F.col("votes")).alias("votes"),
        )
    return state.select(key, "tree", "path", "votes")


def forest_votes(routed: DataFrame, key: str, classes: int) -> DataFrame:
    """``(key, probability, prediction)``: the mean votes of all trees and the first largest class."""
    sums = routed.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.get("votes", F.lit(c))).alias(f"_v{c}") for c in range(classes)])
    shares = F.array(*[F.col(f"_v{c}") / F.col("_n") for c in range(classes)])
    made = sums.select(key, shares.alias("probability"))
    return made.withColumn("prediction", (F.array_position("probability", F.array_max("probability")) - 1).cast("double"))


def populations(routed: DataFrame) -> DataFrame:
    """``(tree, node, n)``: how many rows pass each node."""
    return routed.select("tree", F.explode("path").alias("node")).groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
