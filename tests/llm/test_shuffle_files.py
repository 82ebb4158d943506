"""Shuffle files of finished steps go with the step."""

import re
from pathlib import Path

from pyspark.sql import functions as F

from encore.llm import common, lm_scoring


def shuffles(spark):
    """The shuffles that have files in this session's folders."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {m[1] for d in dirs for f in Path(d).rglob("shuffle_*") if (m := re.match(r"shuffle_(\d+)_", f.name))}


def test_write_leaves_no_shuffle(spark, tmp_dir):
    before, setting = shuffles(spark), spark.conf.get(common.REMOVE_SHUFFLES, None)
    made = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with common.shuffles_removed(spark):
        made.write.parquet(f"{tmp_dir}/made")
    assert not shuffles(spark) - before
    assert spark.conf.get(common.REMOVE_SHUFFLES, None) == setting
    assert spark.read.parquet(f"{tmp_dir}/made").count() == 7 and made.count() == 7  # the plan stays usable


def test_rounds_leave_no_shuffles(spark):
    rows = [(i, " ".join(f"w{(i * k) % 13}" for k in range(1, 12))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = shuffles(spark)
    found = lm_scoring.score_corpus(docs, lambda: F.col("doc_id") % 7 == 2)
    assert found.count() == 60
    assert len(shuffles(spark) - before) <= 3  # those of the checkpoint and the counts
