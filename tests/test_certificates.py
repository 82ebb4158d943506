"""Gram pass, certificates, stored sketches, value types and ordered exports."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from encore.operators import certify, features, gram, models, profile, sketches
from encore.sources import attributes, delimited


def pairs_by_loops(x):
    """Pairwise-complete statistics; nan is a missing value here."""
    out = {}
    for i in range(x.shape[1]):
        for j in range(i, x.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            if len(a):
                out[i, j] = (len(a), a.mean(), b.mean(), ((a - a.mean()) ** 2).sum(), ((b - b.mean()) ** 2).sum(), ((a - a.mean()) * (b - b.mean())).sum())
            else:
                out[i, j] = (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    return out


@pytest.mark.parametrize("tile", [128, 3])
def test_gram_pass_against_loops(spark, monkeypatch, tile):
    monkeypatch.setattr(gram, "TILE", tile)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8)) * 10.0 ** rng.integers(-3, 4, 8) + 1e6 * rng.integers(0, 2, 8)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5] = 0.1  # constant
    x[:, 6] = np.nan  # always missing
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    names = [f"a.{i}" for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(7)
    want = pairs_by_loops(x)
    got = {(r["x"], r["y"]): r for r in gram.pair_statistics(df, names).collect()}
    assert got.keys() == want.keys()
    for key, (n, *values) in want.items():
        r = got[key]
        assert r["n"] == n and r["odd"] == 0
        if n:
            assert np.allclose([r[c] for c in ("mean_x", "mean_y", "ss_x", "ss_y", "co")], values, rtol=1e-7, atol=1e-9 * max(1.0, abs(values[0] * values[1])))
    assert got[5, 5]["ss_x"] == 0.0
    corr = {(r["feature_x"], r["feature_y"]): r["r"] for r in profile.correlation(df, names).collect()}
    assert len(corr) == 28 and corr["a.0", "a.5"] is None and corr["a.0", "a.6"] is None and abs(corr["a.0", "a.1"]) < 1


def test_gram_pass_of_odd_values_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, float("nan"), 1.0), (4.0, 1.0, None), (5.0, None, 9.0)], "a double, b double, c double")
    r = {(x["feature_x"], x["feature_y"]): x["r"] for x in profile.correlation(df, ["a", "b", "c"]).collect()}
    assert np.isnan(r["a", "b"]) and np.isnan(r["b", "c"]) and r["a", "c"] == pytest.approx(np.corrcoef([1, 2, 5], [3, 1, 9])[0, 1])
    assert profile.correlation(df.where("a > 9"), ["a", "b"]).collect() == []
    assert profile.correlation(df, ["a"]).collect() == []


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 4)) * [1, 20, 0.1, 1] + [0, 5, 0, 3]
    x[:, 3] = 7.0  # a constant feature
    z = x[:, 0] - 0.05 * x[:, 1] + rng.normal(size=600)
    rows = [(*map(float, r), int(v > 0), int(np.digitize(v, [-0.7, 0.7]))) for r, v in zip(x, z, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label int, kind int").repartition(5)
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).cache()


def test_logistic_certificates(train):
    for est, data in (
        (models.logistic(), train),
        (models.logistic(regParam=0.05, elasticNetParam=0.5), train),
        (models.logistic(regParam=0.05, elasticNetParam=1.0, standardization=False), train),
        (models.logistic(family="multinomial", regParam=0.01), train.withColumn("label", F.col("kind"))),
    ):
        model = est.fit(data)
        rows = certify.logistic_certificate(model, data).collect()
        assert len(rows) == model.coefficientMatrix.numRows * 5 and all(r["n"] == 600 for r in rows)
        assert not any(r["violated"] for r in rows), rows
    # A fit that was stopped early, and one of other data, are found out.
    assert any(r["violated"] for r in certify.logistic_certificate(models.logistic(maxIter=1).fit(train), train).collect())
    other = models.logistic().fit(train.where("a > 0"))
    assert any(r["violated"] for r in certify.logistic_certificate(other, train).collect())


def test_gradient_against_numpy(train):
    model = models.logistic(regParam=0.1).fit(train)
    data = model.transform(train).select("features", "probability", "label").collect()
    x = np.array([[*r["features"].toArray(), 1.0] for r in data])
    p = np.array([r["probability"][1] for r in data])
    y = np.array([r["label"] for r in data])
    want = ((p - y)[:, None] * x).mean(axis=0)
    got = {r["position"]: r for r in certify.gradient(model, train).where("class = 1").collect()}
    assert np.allclose([got[j]["gradient"] for j in range(5)], want, atol=1e-12)
    assert np.allclose([got[j]["variance"] for j in range(5)], x.var(axis=0, ddof=1), atol=1e-9)


def test_pca_certificate(train):
    cols = ["a", "b", "c", "d"]
    _, scaler, pca = features.feature_pipeline(cols, k=2).fit(train.drop("features")).stages
    std, pc, ratio = scaler.std.toArray(), pca.pc.toArray(), pca.explainedVariance.toArray()
    row = certify.pca_certificate(train, cols, std, pc, ratio).first()
    assert tuple(row) == (600, 2, 3.0, 0, 0, 0)
    assert certify.pca_certificate(train, cols, std, pc[:, ::-1], ratio).first()["not_eigen"] > 0
    skewed = pc.copy()
    skewed[0] += 0.1
    assert certify.pca_certificate(train, cols, std, skewed, ratio).first()["not_orthonormal"] > 0


def test_als_certificate(spark):
    rng = np.random.default_rng(3)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.choice(30, 12, replace=False)] + [(0, 0, 3.0), (0, 0, 5.0)]
    df = spark.createDataFrame(rows, "u int, i int, r double")
    model = models.als("u", "i", "r", rank=4, reg_param=0.1).fit(df)
    found = certify.als_certificate(model, df, "u", "i", "r", 0.1).collect()
    assert len(found) == 40 and sum(r["n"] for r in found) == len(rows) and not any(r["violated"] for r in found)
    changed = df.withColumn("r", F.when(F.col("u") == 3, F.col("r") + 1).otherwise(F.col("r")))
    assert {r["id"] for r in certify.als_certificate(model, changed, "u", "i", "r", 0.1).collect() if r["violated"]} == {3}
    assert sum(r["violated"] for r in certify.als_certificate(model, df, "u", "i", "r", 0.5).collect()) > 30


def test_stored_sketches_merge_like_the_rows(spark, tmp_dir):
    df = spark.range(30_000).select((F.col("id") % 3).alias("kind"), (F.col("id") % 50).alias("day"), (F.col("id") * 7919 % 30_011).cast("double").alias("x"))
    df = df.withColumn("x", F.when(F.col("kind") == 2, F.lit(5.0)).when(F.col("day") == 4, F.lit(None)).otherwise(F.col("x")))
    stored = sketches.stored_sketches(df, "x", ["kind", "day"], f"{tmp_dir}/s")
    assert stored.count() == 3 * 50 - 2  # day 4 has values of one kind only
    for keys in (["kind"], []):
        merged = sketches.merged_quantiles(stored, [0.0, 0.5, 0.99, 1.0], keys)
        rows = df if keys else df.withColumn("all", F.lit(0))
        checked = sketches.rank_bounds(rows, "x", merged if keys else merged.withColumn("all", F.lit(0)), keys[0] if keys else "all").collect()
        assert len(checked) == (12 if keys else 4) and all(r["within_bound"] for r in checked)
    wrong = sketches.merged_quantiles(stored, [0.5], ["kind"]).withColumn("value", F.col("value") + 900)
    assert not any(r["within_bound"] for r in sketches.rank_bounds(df, "x", wrong, "kind").collect())
    empty = df.where("x > 1e9")
    assert sketches.merged_quantiles(sketches.stored_sketches(empty, "x", ["kind"], f"{tmp_dir}/e"), [0.5], []).collect() == []


def test_column_types_from_values(spark):
    rows = [("1", "1.5", "x", None, "-7", "1e5", 1, 2.5, [1], "", "+3"), (None, "2", "3", None, "08", ".5", 2, float("nan"), None, None, "4.")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g int, h double, i array<int>, j string, `k.l` string")
    got = {r["name"]: r["type"] for r in attributes.column_types(df).collect()}
    assert got == {"a": "NUMERIC", "b": "real", "c": "string", "d": "empty", "e": "NUMERIC", "f": "real", "g": "NUMERIC", "h": "string",
                   "i": "string", "j": "string", "k.l": "real"}
    assert {r["type"] for r in attributes.column_types(df.where("a = 'q'")).collect()} == {"empty"}


def test_ordered_export(spark, tmp_dir):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v")).repartition(6)
    path = f"{tmp_dir}/ordered"
    manifest = delimited.write_ordered(df, path, [F.col("k").desc()], partitions=5)
    parts = sorted(manifest.collect(), key=lambda r: r["part"])
    assert sum(r["n_rows"] for r in parts) == 5000 and len(parts) == 5 and max(r["n_rows"] for r in parts) < 2500
    whole = b""
    for r in parts:
        with open(f"{path}/{r['file']}", "rb") as f:
            assert len(whole) == r["first_byte"] and whole.count(b"\n") == r["first_row"]
            whole += f.read()
    lines = [x.split(b",") for x in whole.splitlines()]
    want = sorted((tuple(r) for r in df.collect()), reverse=True)
    assert [(int(a), b.decode()) for a, b in lines] == want
    back = delimited.read_ordered(spark, path, manifest, "k bigint, v string").collect()
    assert [(r["k"], r["v"]) for r in sorted(back, key=lambda r: r["row_no"])] == want and {r["row_no"] for r in back} == set(range(1, 5001))


def test_single_file_is_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(delimited, "MAX_SINGLE_FILE_ROWS", 10)
    delimited.write_delimited(spark.range(10), f"{tmp_dir}/small", single_file=True)
    with pytest.raises(ValueError, match="write_ordered"):
        delimited.write_delimited(spark.range(11), f"{tmp_dir}/large", single_file=True)
