"""Attempt and application reconstruction from ``log_line`` rows.

The per-attempt fold over lines in log order is expressed as independent
last-wins aggregates, one per field, each ordered by ``pos``:

* a: ``exit_code = 0`` and launch                  -> ``start_time``
* b: ``exit_code = 0``, not launch, no container   -> ``end_time``, ``final_status``
* c: ``exit_code <> 0``, no container              -> ``exit_code``
* d: has a container (and not case a)              -> container set

``max_by(x, when(case, pos))`` ignores rows whose ordering is NULL, so each
field is the value of the last line of its case. All aggregates are
partial/final, so the shuffle carries one small row per attempt and task,
and a hot attempt is combined map-side. Containers are distinct and sorted
by ``(id, host)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ATTEMPT_KEY = ["app_id", "attempt_nb"]


def line_groups(lines: DataFrame) -> DataFrame:
    """One row per ``(app_id, attempt_nb)`` over all kept lines.

    Carries the attempt fields (meaningful for ``attempt_nb > 0``) and the
    group's last non-empty user with its position. Attempts, users and
    applications are all derived from this one aggregate, so a plan that
    needs several of them shuffles the parsed lines once (the identical
    exchange is reused).
    """
    exit0 = F.col("exit_code") == 0
    no_container = F.col("container").isNull()
    launch = F.col("is_launch")
    case_a = exit0 & launch
    case_b = exit0 & ~launch & no_container
    case_c = ~exit0 & no_container
    case_d = ~no_container & ~case_a
    pos = F.col("pos")
    named = F.when(F.col("user") != "", pos)
    return (lines.groupBy(*ATTEMPT_KEY)
            .agg(F.max("app_num").alias("app_num"),
                 F.coalesce(F.max_by("ts", F.when(case_a, pos)), F.lit("")).alias("start_time"),
                 F.coalesce(F.max_by("ts", F.when(case_b, pos)), F.lit("")).alias("end_time"),
                 F.coalesce(F.max_by("final_status", F.when(case_b, pos)), F.lit("")).alias("final_status"),
                 F.coalesce(F.max_by("exit_code", F.when(case_c, pos)), F.lit(0)).alias("exit_code"),
                 F.sort_array(F.collect_set(F.when(case_d, F.col("container")))).alias("containers"),
                 F.max_by("user", named).alias("user_last"),
                 F.max(named).alias("user_pos")))


def attempts_of(groups: DataFrame) -> DataFrame:
    """``(app_id, app_num, attempt_nb, start_time, end_time, final_status, exit_code, containers)``."""
    return (groups.where(F.col("attempt_nb") > 0)
            .select(*ATTEMPT_KEY, "app_num", "start_time", "end_time", "final_status", "exit_code", "containers"))


def users_of(groups: DataFrame) -> DataFrame:
    """Last non-empty user per application: ``(app_id, user)``."""
    return (groups.where(F.col("user_pos").isNotNull()).groupBy("app_id")
            .agg(F.max_by("user_last", "user_pos").alias("user")))


def applications_of(groups: DataFrame) -> DataFrame:
    """``(app_id, user, num_attempts)``: distinct non-zero attempts and last non-empty user."""
    return (groups.groupBy("app_id")
            .agg(F.coalesce(F.max_by("user_last", "user_pos"), F.lit("")).alias("user"),
                 F.count_if(F.col("attempt_nb") != 0).cast("int").alias("num_attempts")))


def applications_with_attempts(apps: DataFrame, atts: DataFrame) -> DataFrame:
    """Applications with their attempts in attempt order (left join on ``app_id``).

    Attempts per application are few (already aggregated), so collecting
    them per application is bounded.
    """
    per_app = (atts.groupBy("app_id")
               .agg(F.sort_array(F.collect_list(F.struct(
                   "attempt_nb", "start_time", "end_time", "final_status", "containers"))).alias("attempts")))
    return (apps.join(per_app, "app_id", "left")
            .select("app_id", "user", "num_attempts",
                    F.coalesce(F.col("attempts"), F.array()).alias("attempts")))


def failed_attempts(atts: DataFrame, users: DataFrame) -> DataFrame:
    """Attempts with ``exit_code <> 0`` or ``final_status = 'FAILED'``, with their user."""
    failed = atts.where((F.col("exit_code") != 0) | (F.col("final_status") == "FAILED"))
    return (failed.join(users, "app_id", "left")
            .withColumn("user", F.coalesce(F.col("user"), F.lit(""))))


def containers_text(c: str = "containers"):
    """``(1,host), (2,host)`` rendering of a container array."""
    return F.array_join(F.transform(F.col(c), lambda x: F.format_string("(%d,%s)", x["id"], x["host"])), ", ")
