"""yarnscope: Spark-native analytics over cluster resource-manager logs and
aggregated container logs, plus the keyed aggregation / join workloads that
go with them.

Everything is expressed with DataFrames and built-in column expressions so
Catalyst can push filters into scans, prune columns and pick join strategies,
and Tungsten can keep the hot paths inside whole-stage code generation.
"""

__all__ = ["session"]
