"""Workloads against brute force on random small inputs (hypothesis)."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yarnscope.operators import workloads as W

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ROWS = st.lists(st.tuples(st.integers(0, 4), st.integers(-1000, 1000)), min_size=1, max_size=40)


def jdiv(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def jmod(a, b):
    return a - jdiv(a, b) * b


def df(spark, rows, schema="k int, v int"):
    return spark.createDataFrame(rows, schema)


@SETTINGS
@given(ROWS)
def test_scaled_sum(spark, rows):
    want = defaultdict(int)
    for k, v in rows:
        want[k] += jdiv(v, 10)
    got = {r.k: r.total for r in W.scaled_sum(df(spark, rows), "k", "v", 10).collect()}
    assert got == dict(want)


@SETTINGS
@given(ROWS)
def test_modsum_by_key(spark, rows):
    want = defaultdict(int)
    for k, v in rows:
        want[k] += sum(jmod(v, i) for i in range(2, 51))
    got = {r.k: r.total for r in W.modsum_by_key(df(spark, rows), "k", "v", 2, 50).collect()}
    assert got == dict(want)


@SETTINGS
@given(ROWS)
def test_modsum_total(spark, rows):
    sums = defaultdict(int)
    for k, v in rows:
        sums[k] += v
    want = sum(k * sum(jmod(s, i) for i in range(2, 101)) for k, s in sums.items())
    assert W.modsum_total(df(spark, rows), "k", "v", 2, 100).first().total == want


@SETTINGS
@given(ROWS)
def test_around_half_max(spark, rows):
    sums = defaultdict(int)
    for k, v in rows:
        sums[k] += v
    half = jdiv(max(sums.values()), 2)
    below = [s for s in sums.values() if s < half]
    above = [s for s in sums.values() if s > half]
    r = W.around_half_max(df(spark, rows), "k", "v").first()
    assert (r.half_max, r.max_below, r.min_above) == (half, max(below, default=None), min(above, default=None))


@SETTINGS
@given(ROWS, st.lists(st.tuples(st.integers(0, 5), st.integers(-1000, 1000)), min_size=1, max_size=12),
       st.booleans())
def test_theta_join(spark, fact, dim, broadcast):
    last = {}
    for k, v in dim:
        last[k] = v
    want_right, want_left = defaultdict(int), defaultdict(int)
    for k, v1 in fact:
        for dk, v2 in dim:
            if dk == k and v1 < v2:
                want_left[k] += v1
        if k in last and v1 < last[k]:
            want_right[k] += last[k]
    f = df(spark, fact)
    d = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(dim)], "k int, v int, i int")
    parts = None if broadcast else 7
    right = W.theta_join_sum(f, d, "k", "v", "k", "v", sum_of="right", dim_order=F.col("i"))
    left = W.theta_join_sum(f, d, "k", "v", "k", "v", sum_of="left", dedup=False, ranges=parts)
    assert {r.k: r.total for r in right.collect()} == dict(want_right)
    assert {r.k: r.total for r in left.collect()} == dict(want_left)
    pairs = [(k, v2) for k, v1 in fact for dk, v2 in dim if dk == k and v1 < v2]
    both = W.theta_join_sum(f, d, "k", "v", "k", "v", sum_of="right", dedup=False, ranges=parts)
    assert {r.k: r.total for r in both.collect()} == {k: sum(v for j, v in pairs if j == k) for k, _ in pairs}


def test_theta_join_hot_key_on_shuffle_path(spark):
    """A key with a third of the fact rows: the fact side is reduced to
    (key, value, count) before the shuffle join, and the sums stay exact."""
    fact = [(0, i % 7) for i in range(300)] + [(k % 20 + 1, k % 11) for k in range(600)]
    dim = [(k, 5) for k in range(21)]
    want = defaultdict(int)
    for k, v1 in fact:
        if v1 < 5:
            want[k] += 5
    d = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(dim)], "k int, v int, i int")
    got = W.theta_join_sum(df(spark, fact), d, "k", "v", "k", "v", dim_order=F.col("i"))
    assert {r.k: r.total for r in got.collect()} == dict(want)
