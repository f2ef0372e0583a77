"""The seven usage questions over reconstructed applications and attempts.

Ties in the top-1 questions are broken by name ascending (the order among
equal counts is otherwise arbitrary). Means are truncated toward zero and
computed exactly as ``sum div count``. A timestamp that does not parse gives
a NULL duration, which is left out of the mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import RM_TIMESTAMP_FORMAT


def epoch_millis(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_millis(F.try_to_timestamp(c, F.lit(RM_TIMESTAMP_FORMAT)))


def truncated_mean(name: str) -> Column:
    return F.expr(f"CASE WHEN count({name}) > 0 THEN sum({name}) div count({name}) END")


def q1_top_user_by_apps(apps: DataFrame) -> DataFrame:
    """``(user, n_apps)``: the user with the most applications."""
    return (apps.groupBy("user").agg(F.count(F.lit(1)).alias("n_apps"))
            .orderBy(F.desc("n_apps"), F.asc("user")).limit(1))


def q2_top_user_by_unsuccessful(apps: DataFrame, atts: DataFrame) -> DataFrame:
    """``(user, n_unsuccessful)``: the user with the most attempts not ``FINISHING``."""
    per_app = atts.groupBy("app_id").agg(
        F.count_if(F.col("final_status") != "FINISHING").alias("_bad"))
    return (apps.join(per_app, "app_id", "left")
            .groupBy("user").agg(F.sum(F.coalesce(F.col("_bad"), F.lit(0))).alias("n_unsuccessful"))
            .orderBy(F.desc("n_unsuccessful"), F.asc("user")).limit(1))


def _first_last(atts: DataFrame) -> DataFrame:
    return atts.groupBy("app_id").agg(
        F.min_by("start_time", "attempt_nb").alias("first_start"),
        F.max_by("end_time", "attempt_nb").alias("last_end"))


def q3_apps_per_start_date(atts: DataFrame) -> DataFrame:
    """``(start_date, n_apps)``: applications by the date their first attempt started (if it did)."""
    return (_first_last(atts).where(F.col("first_start") != "")
            .groupBy(F.substring("first_start", 1, 10).alias("start_date"))
            .agg(F.count(F.lit(1)).alias("n_apps")))


def q4_mean_app_duration(atts: DataFrame) -> DataFrame:
    """``(mean_app_ms)``: first attempt start to last attempt end."""
    d = _first_last(atts).select((epoch_millis("last_end") - epoch_millis("first_start")).alias("d"))
    return d.agg(truncated_mean("d").alias("mean_app_ms"))


def q5_mean_success_duration(atts: DataFrame) -> DataFrame:
    """``(mean_success_ms)``: attempts whose final status is ``FINISHING``."""
    d = (atts.where(F.col("final_status") == "FINISHING")
         .select((epoch_millis("end_time") - epoch_millis("start_time")).alias("d")))
    return d.agg(truncated_mean("d").alias("mean_success_ms"))


def _app_hosts(atts: DataFrame) -> DataFrame:
    return (atts.select("app_id", F.explode("containers").alias("c"))
            .select("app_id", F.col("c.host").alias("host")))


def hosts_of_lines(lines: DataFrame) -> DataFrame:
    """``(app_id, host)`` pairs straight from the parsed lines: no container sets are built."""
    kept = (F.col("attempt_nb") > 0) & F.col("container").isNotNull() & ~((F.col("exit_code") == 0) & F.col("is_launch"))
    return lines.where(kept).select("app_id", F.col("container.host").alias("host")).distinct()


def q6_hosts(app_hosts: DataFrame) -> DataFrame:
    """``(n_hosts, hosts)``: distinct container hosts, sorted.

    The list holds one entry per machine of the cluster, a bounded set.
    """
    hosts = app_hosts.select("host").distinct()
    return hosts.agg(F.count(F.lit(1)).alias("n_hosts"),
                     F.array_join(F.sort_array(F.collect_list("host")), ", ").alias("hosts"))


def q7_top_host_by_apps(app_hosts: DataFrame) -> DataFrame:
    """``(host, n_apps)``: the host that ran containers of the most applications."""
    return (app_hosts.distinct()
            .groupBy("host").agg(F.count(F.lit(1)).alias("n_apps"))
            .orderBy(F.desc("n_apps"), F.asc("host")).limit(1))


def question_lines(apps: DataFrame, atts: DataFrame) -> DataFrame:
    """``(question, answer)``: the seven report lines ``n. answer``."""
    q3 = (q3_apps_per_start_date(atts)
          .agg(F.array_join(F.sort_array(F.collect_list(
              F.format_string("%s: %d", "start_date", "n_apps"))), ", ").alias("a")))
    parts = [
        (1, q1_top_user_by_apps(apps).select(F.format_string("%s, %d", "user", "n_apps").alias("a"))),
        (2, q2_top_user_by_unsuccessful(apps, atts)
         .select(F.format_string("%s, %d", "user", "n_unsuccessful").alias("a"))),
        (3, q3),
        (4, q4_mean_app_duration(atts).select(F.col("mean_app_ms").cast("string").alias("a"))),
        (5, q5_mean_success_duration(atts).select(F.col("mean_success_ms").cast("string").alias("a"))),
        (6, q6_hosts(_app_hosts(atts)).select(F.concat_ws(", ", F.col("n_hosts").cast("string"), F.col("hosts")).alias("a"))),
        (7, q7_top_host_by_apps(_app_hosts(atts)).select(F.format_string("%s, %d", "host", "n_apps").alias("a"))),
    ]
    out = None
    for n, df in parts:
        df = df.select(F.lit(n).cast("bigint").alias("question"), F.col("a").alias("answer"))
        out = df if out is None else out.unionByName(df)
    return out
