"""Session defaults and the shared scratch location.

Library code never builds its own session: every entry point takes the
caller's ``SparkSession``. ``build_session`` is for tests, the benchmark and
local use only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "yarnscope", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above: local unless a master is configured
    (tests, bench and the command line)."""
    from pyspark import SparkConf

    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name)
    # a master given by spark-submit (or the environment) wins over the local default;
    # only a local session gets driver memory and one shuffle partition per core
    # (on a cluster the deployment sizes them; AQE coalesces small partitions)
    if master or not SparkConf().contains("spark.master"):
        builder = (builder.master(master or f"local[{cpus}]")
                   .config("spark.driver.memory", os.environ.get("YARNSCOPE_DRIVER_MEMORY", "16g"))
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus))))
    elif shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a path every executor
    can reach). Only a local-mode session without the setting gets a fresh
    folder of its own, as in tests. No setting of the session is changed.
    """
    conf = spark.sparkContext.getConf()
    root = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        app = spark.sparkContext.applicationId
        root = _LOCAL_ROOTS.get(app) or _LOCAL_ROOTS.setdefault(app, tempfile.mkdtemp(prefix="yarnscope-ckpt-"))
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Used for small intermediates (one row per attempt or per container) that
    several branches of a plan consume: each branch would otherwise prune
    the producing aggregate differently and rescan the raw logs. The written
    table also cuts the lineage, so a lost executor later on never forces a
    rescan of the logs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
