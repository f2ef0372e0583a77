"""Workload operators on small CSV fixtures (headerless, as the workloads read them)."""

from pyspark.sql import functions as F

from yarnscope.operators import workloads as W
from yarnscope.sources import csv as C

DATA3 = "a,1,25\na,2,-7\nb,1,9\nb,2,100\n"
DATA4 = "a,10\nb,50\nb,60\nc,1\n"
DATA1 = "1,10\n1,5\n2,7\n"
DATA2 = "1,10\n2,4\n3,6\n3,1\n"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_scaled_sum(spark, write_text):
    df = C.read_str_int_int(spark, write_text("d3.csv", DATA3))
    assert rows(W.scaled_sum(df, "c1", "c2", 10), "c1", "total") == [(1, 2), (2, 10)]


def test_scaled_sum_truncates_toward_zero(spark, write_text):
    df = C.read_str_int_int(spark, write_text("d3.csv", "a,1,-19\na,1,19\n"))
    assert rows(W.scaled_sum(df, "c1", "c2", 10), "c1", "total") == [(1, 0)]


def test_composite_sum(spark, write_text):
    df = C.read_str_int_int(spark, write_text("d3.csv", DATA3))
    got = rows(W.composite_sum(df, ["c0", "c1"], "c2"), "c0", "c1", "total")
    assert got == [("a", 1, 25), ("a", 2, -7), ("b", 1, 9), ("b", 2, 100)]


def test_theta_join_last_dimension_value_wins(spark, write_text):
    from yarnscope.sources.text import position
    fact = C.read_str_int_int(spark, write_text("d3.csv", DATA3))
    dim = spark.read.text(write_text("d4.csv", DATA4)).select(
        F.split("value", ",")[0].alias("c0"), F.split("value", ",")[1].cast("int").alias("c1"),
        position().alias("pos"))
    got = W.theta_join_sum(fact, dim, "c0", "c2", "c0", "c1", sum_of="right", dim_order="pos")
    assert rows(got, "c0", "total") == [("a", 10), ("b", 60)]


def test_theta_join_original_form_multiplies_duplicates(spark, write_text):
    fact = C.read_str_int_int(spark, write_text("d3.csv", DATA3))
    dim = C.read_str_int(spark, write_text("d4.csv", DATA4))
    got = W.theta_join_sum(fact, dim, "c0", "c2", "c0", "c1", sum_of="left", dedup=False)
    assert rows(got, "c0", "total") == [("a", -7), ("b", 18)]


def test_theta_join_without_broadcast_bound(spark, write_text):
    fact = C.read_str_int_int(spark, write_text("d3.csv", DATA3))
    dim = C.read_str_int(spark, write_text("d4.csv", "a,10\nb,60\n"))
    got = W.theta_join_sum(fact, dim, "c0", "c2", "c0", "c1", ranges=1)
    assert rows(got, "c0", "total") == [("a", 10), ("b", 60)]


def test_modsum_total(spark, write_text):
    df = C.read_int_int(spark, write_text("d1.csv", DATA1))
    assert W.modsum_total(df, "k", "v", 2, 100).collect()[0]["total"] == 2629


def test_modsum_by_key(spark, write_text):
    df = C.read_int_int(spark, write_text("d5.csv", DATA1))
    assert rows(W.modsum_by_key(df, "k", "v", 2, 50), "k", "total") == [(1, 642), (2, 309)]


def test_around_half_max(spark, write_text):
    df = C.read_int_int(spark, write_text("d2.csv", DATA2))
    r = W.around_half_max(df, "k", "v").collect()[0]
    assert (r["half_max"], r["max_below"], r["min_above"]) == (5, 4, 7)
    r = W.around_half_max(df, "k", "v", range_partitions=3).collect()[0]
    assert (r["half_max"], r["max_below"], r["min_above"]) == (5, 4, 7)


def test_around_half_max_empty_side_is_null(spark, write_text):
    df = C.read_int_int(spark, write_text("d2.csv", "1,10\n2,10\n"))
    r = W.around_half_max(df, "k", "v").collect()[0]
    assert (r["half_max"], r["max_below"], r["min_above"]) == (5, None, 10)


def test_wrap32(spark, write_text):
    df = C.read_str_int_int(spark, write_text("d3.csv", "a,1,2147483647\na,1,1\n"))
    exact = W.composite_sum(df, ["c1"], "c2").collect()[0]["total"]
    wrapped = W.composite_sum(df, ["c1"], "c2", wrap=True).collect()[0]["total"]
    assert exact == 2147483648 and wrapped == -2147483648


def test_theta_join_paths_agree_on_driver_tables(spark):
    import os
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    part = spark.read.parquet(f"{sf}/part.parquet")
    q = F.col("l_quantity").cast("bigint")
    for side in ("right", "left"):
        a = W.theta_join_sum(li, part, "l_partkey", q, "p_partkey", "p_size", sum_of=side, dedup=False)
        b = W.theta_join_sum(li, part, "l_partkey", q, "p_partkey", "p_size", sum_of=side, dedup=False,
                             ranges=5)
        assert rows(a, "l_partkey", "total") == rows(b, "l_partkey", "total")
