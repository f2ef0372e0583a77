"""The keyed aggregation and join workloads.

* ``scaled_sum``       integer-scaled values summed per key (map-side combine)
* ``composite_sum``    sum per composite key
* ``modsum_by_key``    per key, the sum over rows of  sum_{i=lo..hi} v mod i
* ``modsum_total``     sum over keys of  k * sum_{i=lo..hi} (sum_k v) mod i
* ``theta_join_sum``   equi-join with a small dimension plus ``v1 < v2``, summed
* ``around_half_max``  group totals nearest to half the largest total

Integer arithmetic is exact BIGINT by default; ``wrap=True`` reproduces
32-bit two's-complement wraparound of the summed values. Integer division
truncates toward zero and ``%`` keeps the dividend's sign, as in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wrap32(c: Column) -> Column:
    """Two's-complement 32-bit wraparound of a BIGINT expression."""
    return F.shiftright(F.shiftleft(c.cast("bigint"), 32), 32)


def _sum(c: Column, wrap: bool) -> Column:
    s = F.sum(c.cast("bigint"))
    return wrap32(s) if wrap else s


def scaled_sum(df: DataFrame, key: str, value, divisor: int = 10, *, wrap: bool = False,
               out: str = "total") -> DataFrame:
    """``sum(value div divisor)`` per ``key``; partial aggregation before the shuffle."""
    rows = df.select(F.col(key), _col(value).cast("bigint").alias("_v"))
    return rows.groupBy(key).agg(_sum(F.expr(f"_v div {int(divisor)}"), wrap).alias(out))


def composite_sum(df: DataFrame, keys: Sequence[str], value, *, wrap: bool = False,
                  out: str = "total") -> DataFrame:
    """``sum(value)`` per composite key (one grouping, no nested group)."""
    return df.groupBy(*keys).agg(_sum(_col(value), wrap).alias(out))


def modsum_by_key(df: DataFrame, key: str, value, lo: int = 2, hi: int = 50, *,
                  wrap: bool = False, out: str = "total") -> DataFrame:
    """Per key, ``sum over rows of sum_{i=lo..hi} (v % i)``."""
    rows = df.select(F.col(key), _col(value).cast("bigint").alias("_v"),
                     F.explode(F.sequence(F.lit(int(lo)), F.lit(int(hi)))).alias("_i"))
    return rows.groupBy(key).agg(_sum(F.col("_v") % F.col("_i"), wrap).alias(out))


def modsum_total(df: DataFrame, key: str, value, lo: int = 2, hi: int = 100, *,
                 wrap: bool = False, out: str = "total") -> DataFrame:
    """One row: ``sum over keys of k * sum_{i=lo..hi} (s_k % i)`` with ``s_k = sum(v)``.

    Two-level aggregation: the per-key sums are small, the fan-out over
    ``i`` happens on them, and the final sum is a global aggregate.
    """
    sums = df.groupBy(key).agg(_sum(_col(value), wrap).alias("_s"))
    fanned = sums.select(F.col(key).cast("bigint").alias("_k"), F.col("_s"),
                         F.explode(F.sequence(F.lit(int(lo)), F.lit(int(hi)))).alias("_i"))
    term = F.col("_k") * (F.col("_s") % F.col("_i"))
    return fanned.agg(_sum(term, wrap).alias(out))


def theta_join_sum(fact: DataFrame, dim: DataFrame, key: str, fact_value, dim_key: str, dim_value,
                   *, sum_of: str = "right", dim_order=None, dedup: bool = True,
                   ranges: int | None = None,
                   out: str = "total") -> DataFrame:
    """Inner equi-join on the key with the extra predicate ``v1 < v2``, summed per key.

    ``sum_of="right"`` sums the dimension value (the map-side join form);
    ``"left"`` sums the fact value. With ``dedup`` the dimension keeps one
    value per key, the last one by ``dim_order`` (a column or struct of
    positions; without it the key is assumed unique). Without ``dedup``
    duplicate dimension keys multiply matches, as a plain join does.

    Both sides are first collapsed to ``(key, value, count)`` with map-side
    combine. A dimension of one value per key meets each fact row once, in a
    plain equi-join (broadcast if Catalyst / AQE find it small). A dimension
    with many values per key would meet it in pairs, so there the sums come
    from running totals instead (``prefix_theta_sum``, dealt to ``ranges``
    partitions). Rows with a null key or value match nothing; keys without a
    match have no row.
    """
    d = dim.select(F.col(dim_key).alias("_dk"), _col(dim_value).cast("bigint").alias("_v2"),
                   *([_col(dim_order).alias("_pos")] if dim_order is not None else []))
    f = fact.groupBy(F.col(key).alias(key), _col(fact_value).cast("bigint").alias("_v1")).agg(F.count(F.lit(1)).alias("_n"))
    if not (dedup and dim_order is not None):
        d = d.groupBy("_dk", "_v2").agg(F.count(F.lit(1)).alias("_m"))
        return prefix_theta_sum(f, d, key, sum_of=sum_of, ranges=ranges, out=out)
    d = d.groupBy("_dk").agg(F.max_by("_v2", "_pos").alias("_v2"))
    j = f.join(d, f[key] == d["_dk"], "inner").where(F.col("_v1") < F.col("_v2"))
    summed = F.col("_v2") if sum_of == "right" else F.col("_v1")
    return j.groupBy(key).agg(F.sum(summed * F.col("_n")).alias(out))


def prefix_theta_sum(f: DataFrame, d: DataFrame, key: str, *, sum_of: str, ranges: int | None = None, out: str = "total") -> DataFrame:
    """Sum over all pairs with equal key and ``v1 < v2``, without making the pairs.

    ``f(key, _v1, _n)`` and ``d(_dk, _v2, _m)`` hold distinct values with their
    counts. Both are laid in one order of (key, value), dimension first among
    equal values, and cut into ranges. Inside a range a running total of the
    fact side gives every dimension value what lies below it; a second pass
    over the totals of the ranges of a key, one row each, adds what lies in
    the ranges before. Linear in the rows but for the sort, and a key may fill
    any number of ranges.
    """
    none = F.lit(0).cast("bigint")
    rows = f.where(F.col(key).isNotNull() & F.col("_v1").isNotNull()) \
        .select(F.col(key).alias("_k"), F.col("_v1").alias("_v"), F.lit(1).alias("_side"), F.col("_n"),
                (F.col("_n") if sum_of == "right" else F.col("_v1") * F.col("_n")).alias("_below"), none.alias("_m"), none.alias("_weight")) \
        .unionByName(d.where(F.col("_dk").isNotNull() & F.col("_v2").isNotNull())
                     .select(F.col("_dk").alias("_k"), F.col("_v2").alias("_v"), F.lit(0).alias("_side"), none.alias("_n"), none.alias("_below"),
                             F.col("_m"), (F.col("_v2") * F.col("_m") if sum_of == "right" else F.col("_m")).alias("_weight")))
    parts = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "_k", "_v").withColumn("_range", F.spark_partition_id())
    so_far = Window.partitionBy("_k", "_range").orderBy("_v", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_seen", F.sum("_n").over(so_far)).withColumn("_run", F.sum("_below").over(so_far))
    blocks = rows.groupBy("_k", "_range").agg(
        F.sum(F.col("_weight") * F.col("_run")).alias("_inside"), F.sum("_weight").alias("_weight"), F.sum("_below").alias("_below"),
        F.sum("_n").alias("_n"), F.max("_m").alias("_m"), F.max(F.when(F.col("_m") > 0, F.col("_seen")).otherwise(0)).alias("_seen"))
    before = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_under", F.coalesce(F.sum("_below").over(before), none)).withColumn("_facts", F.coalesce(F.sum("_n").over(before), none))
    matched = (F.col("_seen") > 0) | ((F.col("_m") > 0) & (F.col("_facts") > 0))
    return blocks.groupBy("_k").agg(F.sum(F.col("_inside") + F.col("_weight") * F.col("_under")).alias(out), F.max(matched).alias("_matched")) \
        .where("_matched").select(F.col("_k").alias(key), out)


def around_half_max(df: DataFrame, key: str, value, *, range_partitions: int | None = None) -> DataFrame:
    """One row ``(half_max, max_below, min_above)`` over the per-key totals.

    ``half_max = max(total) div 2``; ``max_below`` is the largest total below
    it and ``min_above`` the smallest above it (NULL when there is none).
    ``half_max`` is a scalar subquery over the same totals, so no join and no
    driver round trip is involved; the per-key totals are computed with a
    partial aggregate, which already absorbs hot keys. ``range_partitions``
    range-partitions the input by key first instead.
    """
    src = df.select(F.col(key), _col(value).cast("bigint").alias("_v"))
    if range_partitions:
        src = src.repartitionByRange(int(range_partitions), key)
    totals = src.groupBy(key).agg(F.sum("_v").alias("_s"))
    half = totals.select(F.expr("max(_s) div 2")).scalar()
    return totals.agg(
        F.max(half).alias("half_max"),
        F.max(F.when(F.col("_s") < half, F.col("_s"))).alias("max_below"),
        F.min(F.when(F.col("_s") > half, F.col("_s"))).alias("min_above"),
    )
