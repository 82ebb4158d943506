"""Classifier scores as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.columns import safe_ratio
from encore.operators.ordering import running_sums


def confusion_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: counts of the confusion table, accuracy, recall, precision.

    All seven counts come from one aggregate. Recall and precision are 0 when
    there is no true positive; accuracy is null on empty input.
    """
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(p == 1).alias("n_positive"),
        F.count_if(p == 0).alias("n_negative"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    )
    tp = F.col("tp")
    return counts.select(
        "*",
        safe_ratio(F.col("tp") + F.col("tn"), "total").alias("accuracy"),
        F.when(tp == 0, F.lit(0.0)).otherwise(safe_ratio(tp, tp + F.col("fn"))).alias("recall"),
        F.when(tp == 0, F.lit(0.0)).otherwise(safe_ratio(tp, tp + F.col("fp"))).alias("precision"),
    )


def auc(df: DataFrame, score: str = "score", label: str = "label", partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half: ``(auc, n_positive, n_negative)``.

    Rows are reduced to one row per distinct score (positives, negatives);
    the negatives below each score come from distributed running sums, so no
    task holds more than a range of distinct scores.
    """
    per_score = df.where(F.col(score).isNotNull()).groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")
    )
    cum = running_sums(per_score, [score], {"neg": F.col("_neg"), "pos": F.col("_pos")}, partitions)
    wins = F.col("_pos").cast("double") * (F.col("neg_before").cast("double") + 0.5 * F.col("_neg"))
    summed = cum.agg(
        F.sum(wins).alias("_wins"), F.max("pos_total").alias("n_positive"), F.max("neg_total").alias("n_negative")
    )
    return summed.select(
        F.try_divide(F.col("_wins"), F.col("n_positive").cast("double") * F.col("n_negative")).alias("auc"),
        "n_positive",
        "n_negative",
    )


def grouped_auc(df: DataFrame, keys: Sequence[str], score: str = "score", label: str = "label", partitions: int | None = None) -> DataFrame:
    """:func:`auc` of every group of ``keys``: ``(keys, auc, n_positive, n_negative)``. One pass of
    running sums serves all groups: a group's own sum is the one over all rows less that of
    the groups before it."""
    per_score = df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    cum = running_sums(per_score, [*keys, score], {"neg": F.col("_neg")}, partitions)
    start = cum.groupBy(*keys).agg(F.min("neg_before").alias("_start"), F.sum("_pos").alias("n_positive"), F.sum("_neg").alias("n_negative"))
    # Wins counted from the first group's start; the start's share is taken off per group.
    wins = F.col("_pos").cast("double") * (F.col("neg_before").cast("double") + 0.5 * F.col("_neg"))
    summed = cum.groupBy(*keys).agg(F.sum(wins).alias("_wins"))
    joined = summed.join(start, list(keys))
    own = F.col("_wins") - F.col("n_positive").cast("double") * F.col("_start")
    return joined.select(*keys, F.try_divide(own, F.col("n_positive").cast("double") * F.col("n_negative")).alias("auc"), "n_positive", "n_negative")


def multiclass_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: weighted F1 (the default metric of Spark's multi-class
    evaluator), accuracy, weighted precision and weighted recall.

    True and predicted classes are stacked and counted per class in one
    aggregate; the per-class table has one row per class.
    """
    truth = df.select(F.col(label).alias("_c"), F.lit(1).alias("_t"), F.lit(0).alias("_p"),
                      (F.col(label) == F.col(prediction)).cast("int").alias("_tp"))
    predicted = df.select(F.col(prediction).alias("_c"), F.lit(0).alias("_t"), F.lit(1).alias("_p"),
                          F.lit(0).alias("_tp"))
    per_class = truth.unionByName(predicted).groupBy("_c").agg(
        F.sum("_t").alias("n_true"), F.sum("_p").alias("n_pred"), F.sum("_tp").alias("tp")
    )
    tp, nt, npred = F.col("tp").cast("double"), F.col("n_true").cast("double"), F.col("n_pred").cast("double")
    f1 = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(2.0 * tp / (nt + npred))
    prec = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(tp / npred)
    rec = F.when(F.col("tp") == 0, F.lit(0.0)).otherwise(tp / nt)
    sums = per_class.agg(
        F.sum(nt * f1).alias("_f1"), F.sum(nt * prec).alias("_prec"), F.sum(nt * rec).alias("_rec"),
        F.sum(tp).alias("_tp"), F.sum(nt).alias("_n"),
    )
    return sums.select(
        F.try_divide("_f1", "_n").alias("f1"),
        F.try_divide("_tp", "_n").alias("accuracy"),
        F.try_divide("_prec", "_n").alias("weighted_precision"),
        F.try_divide("_rec", "_n").alias("weighted_recall"),
    )
