import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.operators import ordering, profile


def test_profile_matches_numpy(spark):
    xs = [1.0, 2.0, 4.0, 7.0]
    df = spark.createDataFrame([(x, int(x) * 10) for x in xs], "a double, b int")
    rows = {r["column"]: r for r in profile.profile(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 4
    assert rows["a"]["mean"] == pytest.approx(np.mean(xs))
    assert rows["a"]["stddev"] == pytest.approx(np.std(xs, ddof=1))
    assert (rows["b"]["min"], rows["b"]["max"]) == (10.0, 70.0)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_running_sums_match_brute_force(spark, partitions):
    vals = [(i, (i * 37) % 11) for i in range(200)]
    df = spark.createDataFrame(vals, "k int, w int")
    out = {r["k"]: (r["w_before"], r["w_total"]) for r in
           ordering.running_sums(df, ["k"], {"w": F.col("w")}, partitions).collect()}
    total = sum(w for _, w in vals)
    acc = 0
    for k, w in vals:
        assert out[k] == (acc, total)
        acc += w


def test_row_numbers_descending(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", 1)], "v string, n int")
    out = ordering.row_numbers(df, [F.col("n").desc(), F.col("v").asc()], "rn", partitions=3)
    assert [r["v"] for r in out.orderBy("rn").collect()] == ["b", "c", "a", "d"]
    assert sorted(r["rn"] for r in out.collect()) == [1, 2, 3, 4]


def _disc(values, p):
    s = sorted(values)
    n = len(s)
    for i, v in enumerate(s):
        if (i + 1) >= p * n:
            return v
    return s[-1]


def test_exact_quantiles_are_percentile_disc(spark):
    values = [1, 2, 2, 3, 5, 8, 13, 13, 13, 21, 40] * 3 + [7]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {r["prob"]: r["value"] for r in profile.exact_quantiles(df, "x", probs, partitions=4).collect()}
    want = df.agg(*[F.expr(f"percentile_disc({p}) within group (order by x)").alias(str(p)) for p in probs]).collect()[0]
    for p in probs:
        assert got[p] == _disc(values, p) == want[str(p)]


def test_approx_quantiles_within_rank_bound(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x"))
    approx = profile.approx_quantiles(df, "x", rel_err=0.05)
    check = profile.quantile_rank_check(df, "x", approx, 0.05).collect()
    assert all(r["within_bound"] for r in check) and len(check) == 5


def test_approx_quantiles_checked_for_several_measures(spark):
    a = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("x"))
    b = spark.range(300).select((F.col("id") % 17).alias("y"))
    rows = profile.approx_quantiles_checked([("a", a, "x"), ("b", b, "y")], rel_err=0.05).collect()
    assert len(rows) == 10 and all(r["within_bound"] for r in rows)
    single = {r["prob"]: r["value"] for r in profile.approx_quantiles(a, "x", rel_err=0.05).collect()}
    assert {r["prob"]: r["value"] for r in rows if r["measure"] == "a"} == single


def test_correlation_against_numpy_and_constant_column(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(size=300)
    b = a * 2 + rng.normal(size=300) * 0.1
    c = rng.normal(size=300)
    df = spark.createDataFrame([(float(x), float(y), float(z), 5.0) for x, y, z in zip(a, b, c)],
                               "a double, b double, c double, z double")
    corr = {(r["feature_x"], r["feature_y"]): r["r"] for r in profile.correlation(df, ["a", "b", "c", "z"]).collect()}
    assert corr[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)
    assert corr[("a", "c")] == pytest.approx(np.corrcoef(a, c)[0, 1], abs=1e-12)
    assert corr[("a", "z")] is None
    m = {(r["feature_x"], r["feature_y"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "z"]).collect()}
    assert m[("a", "b")] == pytest.approx(corr[("a", "b")], abs=1e-12) and math.isnan(m[("a", "z")])
    strong = profile.correlated_pairs(profile.correlation(df, ["a", "b", "c"]), 0.9).collect()
    assert [(r["feature_x"], r["feature_y"]) for r in strong] == [("a", "b")]
    assert profile.drop_correlated(df, ["a", "b", "c"], 0.9).columns == ["a", "c", "z"]


def test_class_balance_order(spark):
    df = spark.createDataFrame([(0, "x")] * 3 + [(1, "y")] * 5 + [(0, "y")], "label int, genre string")
    out = [tuple(r) for r in profile.class_balance(df, "label").collect()]
    assert out == [(1, 5), (0, 4)]


def test_correlation_with_nulls_uses_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (100.0, None), (None, -50.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    from encore.operators.profile import correlation

    assert abs(correlation(df, ["x", "y"]).first()["r"] - 1.0) < 1e-12
