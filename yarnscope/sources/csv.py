"""Headerless comma-separated inputs of the aggregation workloads.

Each line is split on ``,`` and the needed fields are cast; extra columns are
ignored and no quoting is handled, like a plain ``split``. Casts run in ANSI
mode, so a malformed number fails the job instead of being dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(spark: SparkSession, path: str, spec: list[tuple[int, str, T.DataType]], *more: Column) -> DataFrame:
    parts = F.split(F.col("value"), ",")
    return (spark.read.text(path)
            .select(*[parts.getItem(i).cast(t).alias(name) for i, name, t in spec], *more))


def read_str_int_int(spark: SparkSession, path: str) -> DataFrame:
    """``c0 string, c1 int, c2 int`` (the three-column workload input)."""
    return _fields(spark, path, [(0, "c0", T.StringType()), (1, "c1", T.IntegerType()),
                                 (2, "c2", T.IntegerType())])


def read_int_int(spark: SparkSession, path: str) -> DataFrame:
    """``k int, v int`` (the two-column workload inputs)."""
    return _fields(spark, path, [(0, "k", T.IntegerType()), (1, "v", T.IntegerType())])


def read_str_int(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    """``c0 string, c1 int`` (the small dimension of the join workload), and further columns of the scan."""
    return _fields(spark, path, [(0, "c0", T.StringType()), (1, "c1", T.IntegerType())], *more)
