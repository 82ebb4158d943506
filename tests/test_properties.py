"""Property tests: the distributed algorithms against brute force on random inputs."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.operators import evaluate, joins, ordering, profile, ranking

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

small_ints = st.integers(min_value=0, max_value=6)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=60, unique_by=lambda t: t[0]),
       st.integers(1, 5))
def test_running_sums(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k int, w int")
    got = {r["k"]: (r["w_before"], r["w_total"]) for r in
           ordering.running_sums(df, ["k"], {"w": F.col("w")}, partitions).collect()}
    total = sum(w for _, w in rows)
    for k, _ in rows:
        assert got[k] == (sum(w for kk, w in rows if kk < k), total)


def _rank(values, v):
    return 1 + sum(1 for x in values if x > v)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), small_ints), min_size=1, max_size=50), st.integers(1, 4))
def test_top_n_keep_is_rank(spark, rows, n):
    data = [(g, i, s) for i, (g, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, i int, s int")
    got = {(r["i"], r["rank"]) for r in ranking.top_n(df, "g", "s", n, ties="keep").collect()}
    want = set()
    for g, i, s in data:
        r = _rank([x for gg, _, x in data if gg == g], s)
        if r <= n:
            want.add((i, r))
    assert got == want


def _disc(values, p):
    s = sorted(values)
    for i, v in enumerate(s):
        if i + 1 >= p * len(s):
            return v
    return s[-1]


@SETTINGS
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=80), st.integers(1, 4))
def test_exact_quantiles(spark, values, partitions):
    df = spark.createDataFrame([(v,) for v in values], "x long")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {r["prob"]: r["value"] for r in profile.exact_quantiles(df, "x", probs, partitions).collect()}
    assert got == {p: _disc(values, p) for p in probs}


@SETTINGS
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60), st.lists(st.integers(0, 9), min_size=1, max_size=60),
       st.integers(1, 4))
def test_stacked_quantiles_equal_separate(spark, a, b, partitions):
    fa = spark.createDataFrame([(v,) for v in a], "x long")
    fb = spark.createDataFrame([(v,) for v in b], "y long")
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = {(r["measure"], r["prob"]): r["value"] for r in
           profile.exact_quantiles_stacked([("a", fa, "x"), ("b", fb, "y")], probs, partitions).collect()}
    want = {("a", p): _disc(a, p) for p in probs} | {("b", p): _disc(b, p) for p in probs}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), min_size=2, max_size=80))
def test_auc_is_mann_whitney(spark, rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "label int, score double")
    got = evaluate.auc(df, "score", "label", partitions=3).collect()[0]["auc"]
    if not pos or not neg:
        assert got is None
    else:
        want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert got == pytest.approx(want, abs=1e-12)


def _metrics(pred, rel, k):
    p = sum(1 for x in pred[:k] if x in rel) / k
    hits, ap = 0, 0.0
    for i, x in enumerate(pred):
        if x in rel:
            hits += 1
            ap += hits / (i + 1)
    ap = ap / len(rel)
    n = min(max(len(pred), len(rel)), k)
    dcg = sum(1 / math.log2(i + 2) for i in range(n) if i < len(pred) and pred[i] in rel)
    idcg = sum(1 / math.log2(i + 2) for i in range(min(len(rel), n)))
    return p, ap, dcg / idcg


@SETTINGS
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=6, unique=True),
                          st.sets(st.integers(0, 9), min_size=1, max_size=6)), min_size=1, max_size=6),
       st.integers(1, 5))
def test_ranking_metrics_brute_force(spark, users, k):
    rec = spark.createDataFrame([(u, it, pos + 1) for u, (p, _) in enumerate(users) for pos, it in enumerate(p)],
                                "u int, item int, position int")
    rel = spark.createDataFrame([(u, it) for u, (_, r) in enumerate(users) for it in r], "u int, item int")
    got = ranking.ranking_metrics(rec, rel, "u", "item", ks=(k,)).collect()[0]
    want = [_metrics(p, r, k) for p, r in users]
    assert got["n_users"] == len(users)
    assert got[f"precision_at_{k}"] == pytest.approx(sum(w[0] for w in want) / len(want), abs=1e-12)
    assert got["mean_average_precision"] == pytest.approx(sum(w[1] for w in want) / len(want), abs=1e-12)
    assert got[f"ndcg_at_{k}"] == pytest.approx(sum(w[2] for w in want) / len(want), abs=1e-12)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60),
       st.sets(st.one_of(st.none(), st.integers(0, 6)), max_size=5),
       st.sets(st.integers(0, 6), max_size=3))
def test_split_hot_keys_equals_plain_join(spark, left, right, hot):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, i int")
    r = spark.createDataFrame([(k,) for k in right], "k int")
    h = spark.createDataFrame([(k, left.count(k)) for k in hot], "k int, _n long")
    def key(t):
        return (t[0] is None, t[0] or 0, t[1])

    for how in ("left_semi", "left_anti"):
        got = sorted((tuple(x) for x in joins.split_hot_keys(df, r, "k", how, h, rows_per_task=2).collect()), key=key)
        want = sorted((tuple(x) for x in df.join(r, "k", how).select("k", "i").collect()), key=key)
        assert got == want
