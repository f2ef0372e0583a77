"""The aggregation / join workloads on the TPC-H-like tables.

Mapping of the workload inputs onto the driver tables:

* three-column input ``(c0 string, c1 int, c2 int)``: ``lineitem`` as
  ``(l_returnflag, l_suppkey, truncated l_extendedprice)``
* two-column inputs ``(k, v)``: ``lineitem (l_suppkey, truncated
  l_extendedprice)``, or ``orders (o_custkey, truncated o_totalprice)``
* join workload: fact ``lineitem (l_partkey, truncated l_quantity)`` and
  dimension ``part (p_partkey, p_size)``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..jobs import workload
from ..operators import workloads as W
from ..session import scratch_path
from ..sources import csv as C
from .tables import table


def _price(col: str):
    return F.col(col).cast("bigint")   # truncation toward zero


def scaled_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return W.scaled_sum(li, "l_suppkey", _price("l_extendedprice"), 10)


def composite_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return W.composite_sum(li, ["l_returnflag", "l_suppkey"], _price("l_extendedprice"))


def modsum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return W.modsum_by_key(li, "l_suppkey", _price("l_extendedprice"), 2, 50)


def modsum_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return W.modsum_total(li, "l_suppkey", _price("l_extendedprice"), 2, 100)


def _part_pos():
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def broadcast_theta_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return W.theta_join_sum(li, part, "l_partkey", _price("l_quantity"), "p_partkey", "p_size",
                            sum_of="right", dim_order=_part_pos(), dedup=True)


def broadcast_theta_sum_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return W.theta_join_sum(li, part, "l_partkey", _price("l_quantity"), "p_partkey", "p_size",
                            sum_of="left", dedup=False)


def around_half_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return W.around_half_max(orders, "o_custkey", _price("o_totalprice"))


# ---- the same workloads over comma-separated files, written from the tables


def _csv(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Folder of headerless comma-separated lines with the columns of ``rows``."""
    path = scratch_path(spark, name)
    rows.select(F.concat_ws(",", *rows.columns).alias("value")).write.text(path)
    return path


def _lineitem_csv(spark: SparkSession, sf_dir: str) -> str:
    li = table(spark, sf_dir, "lineitem")
    return _csv(spark, li.select("l_partkey", "l_suppkey", _price("l_quantity").alias("q"), "l_returnflag"), "lineitem-csv")


def csv_scaled_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workload(spark, "scaled_sum", _lineitem_csv(spark, sf_dir))


def csv_theta_join_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _csv(spark, table(spark, sf_dir, "part").select("p_partkey", "p_size"), "part-csv")
    return workload(spark, "theta_join_sum", _lineitem_csv(spark, sf_dir), dim)


def csv_around_half_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _csv(spark, table(spark, sf_dir, "orders").select("o_custkey", _price("o_totalprice").alias("v")), "orders-csv")
    return W.around_half_max(C.read_int_int(spark, orders), "k", "v", range_partitions=8)


def _order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with many rows for a key: the orders of a customer."""
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 50).alias("v"))


def theta_sum_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.theta_join_sum(table(spark, sf_dir, "lineitem"), _order_values(spark, sf_dir), "l_suppkey", _price("l_quantity"),
                            "o_custkey", "v", sum_of="right", dim_order=F.col("o_orderkey"))


def theta_sum_multiply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.theta_join_sum(table(spark, sf_dir, "lineitem"), _order_values(spark, sf_dir), "l_suppkey", _price("l_quantity"),
                            "o_custkey", "v", sum_of="left", dedup=False, ranges=16)


QUERIES = {
    "csv_scaled_sum": csv_scaled_sum,
    "csv_theta_join_sum": csv_theta_join_sum,
    "csv_around_half_max": csv_around_half_max,
    "theta_sum_last_wins": theta_sum_last_wins,
    "theta_sum_multiply": theta_sum_multiply,
    "scaled_sum": scaled_sum,
    "composite_sum": composite_sum,
    "modsum_by_key": modsum_by_key,
    "modsum_total": modsum_total,
    "broadcast_theta_sum": broadcast_theta_sum,
    "broadcast_theta_sum_left": broadcast_theta_sum_left,
    "around_half_max": around_half_max,
}

_V = "CAST(trunc({c}) AS BIGINT)"

ORACLE = {
    "scaled_sum": f"""
        SELECT l_suppkey, CAST(sum({_V.format(c='l_extendedprice')} // 10) AS BIGINT) AS total
        FROM lineitem GROUP BY l_suppkey""",
    "composite_sum": f"""
        SELECT l_returnflag, l_suppkey, CAST(sum({_V.format(c='l_extendedprice')}) AS BIGINT) AS total
        FROM lineitem GROUP BY l_returnflag, l_suppkey""",
    "modsum_by_key": f"""
        SELECT l_suppkey, CAST(sum(v % i) AS BIGINT) AS total
        FROM (SELECT l_suppkey, {_V.format(c='l_extendedprice')} AS v FROM lineitem) li,
             range(2, 51) r(i)
        GROUP BY l_suppkey""",
    "modsum_total": f"""
        WITH s AS (SELECT CAST(l_suppkey AS BIGINT) AS k,
                          CAST(sum({_V.format(c='l_extendedprice')}) AS BIGINT) AS s
                   FROM lineitem GROUP BY l_suppkey)
        SELECT CAST(sum(k * (s % i)) AS BIGINT) AS total FROM s, range(2, 101) r(i)""",
    "broadcast_theta_sum": f"""
        SELECT l_partkey, CAST(sum(CAST(p_size AS BIGINT)) AS BIGINT) AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE {_V.format(c='l_quantity')} < p_size
        GROUP BY l_partkey""",
    "broadcast_theta_sum_left": f"""
        SELECT l_partkey, CAST(sum({_V.format(c='l_quantity')}) AS BIGINT) AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE {_V.format(c='l_quantity')} < p_size
        GROUP BY l_partkey""",
    "around_half_max": f"""
        WITH t AS (SELECT o_custkey, CAST(sum({_V.format(c='o_totalprice')}) AS BIGINT) AS s
                   FROM orders GROUP BY o_custkey),
             h AS (SELECT max(s) // 2 AS half FROM t)
        SELECT CAST(max(half) AS BIGINT) AS half_max,
               CAST(max(CASE WHEN s < half THEN s END) AS BIGINT) AS max_below,
               CAST(min(CASE WHEN s > half THEN s END) AS BIGINT) AS min_above
        FROM t, h""",
    "csv_scaled_sum": f"""
        SELECT l_suppkey AS c1, CAST(sum({_V.format(c='l_quantity')} // 10) AS BIGINT) AS total
        FROM lineitem GROUP BY l_suppkey""",
    "csv_theta_join_sum": f"""
        SELECT CAST(l_partkey AS VARCHAR) AS c0, CAST(sum(CAST(p_size AS BIGINT)) AS BIGINT) AS total
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {_V.format(c='l_quantity')} < p_size GROUP BY l_partkey""",
    "theta_sum_last_wins": f"""
        SELECT l_suppkey, CAST(sum(v) AS BIGINT) AS total
        FROM lineitem JOIN (SELECT o_custkey, arg_max(o_orderkey % 50, o_orderkey) AS v FROM orders GROUP BY o_custkey)
             ON l_suppkey = o_custkey WHERE {_V.format(c='l_quantity')} < v GROUP BY l_suppkey""",
    "theta_sum_multiply": f"""
        SELECT l_suppkey, CAST(sum({_V.format(c='l_quantity')}) AS BIGINT) AS total
        FROM lineitem JOIN orders ON l_suppkey = o_custkey WHERE {_V.format(c='l_quantity')} < o_orderkey % 50 GROUP BY l_suppkey""",
}
ORACLE["csv_around_half_max"] = ORACLE["around_half_max"]
