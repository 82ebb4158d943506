import json
import os
import subprocess
import sys

from pyspark import StorageLevel

from encore.operators import physical
from tests.conftest import ROOT, SF_SMALL


def test_spread_partitions_per_core_and_by_key(spark):
    df = spark.range(1000)
    out = physical.spread(df, "id", per_core=2)
    assert out.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert out.count() == 1000


def test_materialize_both_ways_keeps_rows(spark):
    df = spark.range(500).selectExpr("id", "id % 7 AS k")
    for how in ("checkpoint", "parquet"):
        out = physical.materialize(df, "t", how=how)
        assert sorted(out.collect()) == sorted(df.collect())


def test_persist_shared_level(spark):
    df = physical.persist_shared(spark.range(10))
    assert df.storageLevel == StorageLevel.MEMORY_AND_DISK
    df.unpersist()


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEATS="1", BENCH_ONLY="blocklist,auc")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and set(result["queries"]) == {"blocklist", "auc"} and result["sf"] == 0.001
    assert result["value"] == round(sum(result["queries"].values()), 3)
