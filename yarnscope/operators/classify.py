"""Failure classification of attempts into error categories 1-9.

Plan (all shuffles carry small feature rows, never log text):

1. ``record_features``: one feature row per container-log record (narrow).
2. Level 1, per ``(attempt, container)``: the last record of the container
   (a later record of the same container replaces an earlier one) plus the
   earliest record, by position, that triggers each "first record decides"
   rule. Partial aggregation absorbs duplicate records map-side.
3. Level 2, per attempt: the driver's last record, the earliest triggering
   records, and the first executor (ascending container id) that yields a
   block-fetch / cache / heartbeat diagnosis.
4. The executor named as lost by the driver is looked up with an equi-join
   on ``(attempt, container)`` against level 1.
5. The rule cascade is one ``coalesce`` of nullable result structs, in rule
   order: class not found (1), missing input (2), driver code failure (3),
   driver/executor infrastructure (4), executor code vs shuffle failure
   (5/6), other driver error (7), other executor error (8), unknown (9).

Rules that need the driver log are skipped when an attempt has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import CLS, DEFAULT_EXCEPTION, DEFAULT_FORMAT, NOT_AVAILABLE, LogFormat
from .containers import RECORD_KEY, keyed_records, record_features

CLASS_NOT_FOUND = "java.lang.ClassNotFoundException"
INVALID_INPUT = "org.apache.hadoop.mapred.InvalidInputException"


def _result(cat, exc, stage, line) -> Column:
    def lit(x):
        return F.lit(x) if not isinstance(x, Column) else x
    return F.struct(lit(cat).cast("int").alias("error_category"), lit(exc).cast("string").alias("exception"),
                    lit(stage).cast("int").alias("stage"), lit(line).cast("int").alias("source_line"))


def per_container(features: DataFrame) -> DataFrame:
    """Level 1: one row per ``(attempt, container)``."""
    pos = F.col("pos")
    a = F.col("any_f")
    d = F.col("drv_f")
    return features.groupBy(*RECORD_KEY, "cid").agg(
        F.max_by(F.struct("any_f", "drv_f", "exe_f"), pos).alias("last"),
        F.min_by(F.struct(pos.alias("pos"), d.alias("d")), F.when(F.col("is_drv_header"), pos)).alias("drv_first"),
        F.min_by(F.struct(pos.alias("pos"), a["f2_line"].alias("line")), F.when(a["f2_hit"], pos)).alias("f2_first"),
        F.min_by(F.struct(pos.alias("pos"), a["generic"].alias("g")), F.when(a["has_error"], pos)).alias("err_first"),
    )


def per_attempt(level1: DataFrame) -> DataFrame:
    """Level 2: one row per attempt with everything the cascade reads."""
    cid = F.col("cid")
    exe = F.col("last.exe_f")
    infra = exe["kind"].isin("fetch", "cache")
    pick = F.struct(cid.alias("cid"), exe["exc"].alias("exc"))
    return level1.groupBy(*RECORD_KEY).agg(
        F.max_by(F.col("last"), F.when(cid == 1, cid)).alias("drv_last"),
        F.max(cid == 1).alias("has_driver"),
        F.min_by(F.col("drv_first"), F.col("drv_first.pos")).alias("drv_first"),
        F.min_by(F.col("f2_first"), F.col("f2_first.pos")).alias("f2_first"),
        F.min_by(F.col("err_first"), F.col("err_first.pos")).alias("err_first"),
        F.min_by(pick, F.when((cid > 1) & infra, cid)).alias("infra_any"),
        F.min_by(pick, F.when((cid > 1) & infra & (exe["exc"] != ""), cid)).alias("infra_exc"),
        F.min(F.when((cid > 1) & (exe["kind"] == "heartbeat") & exe["hb_driver"], cid)).alias("hb_cid"),
    )


def _rule4(drv: Column, infra_any: Column, infra_exc: Column, hb_cid: Column) -> Column:
    fb = drv["fallback_exc"]

    def choose(e: Column) -> Column:
        return F.when(e != "", e).when(fb != "", fb)

    driver_exc = (F.when(drv["max_result"], F.lit(DEFAULT_EXCEPTION))
                  .when(drv["bm"], choose(drv["bm_exc"]))
                  .when(drv["tch"], choose(drv["tch_exc"]))
                  .when(drv["trg"] & ~drv["ycs"], choose(F.lit("")))
                  .when(drv["leak"] | drv["trh"], choose(F.lit("")))
                  .when(drv["tsm_driver"], choose(F.lit("")))
                  .when(drv["am_ok"] & drv["am_nested"].isNotNull(), choose(drv["am_nested"])))
    # executors in ascending container id; the first one with a diagnosis wins
    infra = F.when(fb != "", infra_any).otherwise(infra_exc)
    infra_wins = infra.isNotNull() & (hb_cid.isNull() | (infra["cid"] < hb_cid))
    exec_exc = (F.when(infra_wins, F.when(infra["exc"] != "", infra["exc"]).otherwise(fb))
                .when(hb_cid.isNotNull(), F.lit(DEFAULT_EXCEPTION)))
    exc = F.coalesce(driver_exc, exec_exc)
    return F.when(exc.isNotNull(), _result(4, exc, drv["final_stage"], drv["final_line"]))


def _rule56(drv: Column, lost: Column) -> Column:
    has_lost = drv["lost_hit"] & lost.isNotNull()
    matched = has_lost & lost["ex_hit"]
    exc0 = F.when(matched, lost["ex_exc"]).otherwise(F.lit(""))
    typ = F.when(matched, lost["ex_type"]).otherwise(F.lit(-1))
    line0 = F.when(has_lost, lost["ex_app_line"]).otherwise(F.lit(-1))
    exc1 = F.when((exc0 == "") & (drv["utils_before"] != 0), drv["utils_info_exc"]).otherwise(exc0)
    exc2 = F.when(exc1 == "", drv["am_user_exc"]).otherwise(exc1)
    line = F.when(line0 == -1, drv["dag_line"]).otherwise(line0)
    stage = drv["cancel_stage"]
    ok = (drv["first_actor"] == CLS["scheduler_actor"]) & (exc2 != "") & (typ != -1) & (stage != -1)
    return F.when(ok, _result(typ, exc2, stage, line))


def diagnose(level2: DataFrame, level1: DataFrame) -> DataFrame:
    """Per attempt ``(app_num, attempt_nb, error_category, exception, stage, source_line)``."""
    lost = level1.select(*RECORD_KEY, F.col("cid").alias("_lost_cid"), F.col("last.any_f").alias("lost"))
    j = level2.join(lost, (level2["app_num"] == lost["app_num"]) & (level2["attempt_nb"] == lost["attempt_nb"])
                    & (F.col("drv_last.drv_f.lost_cid") == F.col("_lost_cid")), "left")
    first = F.col("drv_first.d")
    drv = F.col("drv_last.drv_f")
    drv_any = F.col("drv_last.any_f")
    has_drv = F.coalesce(F.col("has_driver"), F.lit(False))
    err = F.col("err_first.g")
    verdict = F.coalesce(
        F.when(first["f1_hit"], _result(1, CLASS_NOT_FOUND, -1, -1)),
        F.when(F.col("f2_first").isNotNull(), _result(2, INVALID_INPUT, -1, F.col("f2_first.line"))),
        F.when(first["f3_hit"], _result(3, first["f3_exc"], first["f3_stage"], first["f3_line"])),
        F.when(has_drv, _rule4(drv, F.col("infra_any"), F.col("infra_exc"), F.col("hb_cid"))),
        F.when(has_drv, _rule56(drv, F.col("lost"))),
        F.when(has_drv & drv_any["has_error"], _result(7, drv_any["generic"]["exception"],
                                                       drv_any["generic"]["stage"], drv_any["generic"]["line"])),
        F.when(err.isNotNull(), _result(8, err["exception"], err["stage"], err["line"])),
        _result(9, NOT_AVAILABLE, -1, -1),
    )
    return j.select(level2["app_num"], level2["attempt_nb"], verdict.alias("v")).select(
        "app_num", "attempt_nb", "v.error_category", "v.exception", "v.stage", "v.source_line")


def classify_attempts(records: DataFrame, rm_lines: DataFrame, *, app_range: tuple[int, int] | None = None,
                      materialize_steps: bool = True, all_frames: bool = False,
                      fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """Diagnose every failed attempt that has container logs.

    ``records``: ``(value, pos)`` container-log records; ``rm_lines``: parsed
    resource-manager lines (with exit codes, already range-filtered). Records
    of attempts that did not fail are dropped map-side, before any feature is
    extracted, by a bitmap filter of fixed size over the failed keys; the few
    that pass it are dropped by the final join. With ``materialize_steps``
    the two small intermediates are written to the checkpoint folder (eager).
    ``all_frames`` makes the generic rule read every source-line alternative.

    Output: ``(app_id, attempt_nb, user, start_time, end_time, containers,
    error_category, exception, stage, source_line)``.
    """
    from ..session import materialize
    from .attempts import attempts_of, failed_attempts, line_groups, users_of
    from .joins import prefilter

    # one row per (application, attempt), written once: attempts, users and
    # the prefilter keys all read it, so the resource-manager log is scanned once
    groups = materialize(line_groups(rm_lines), "attempt-groups") if materialize_steps else line_groups(rm_lines)
    failed = failed_attempts(attempts_of(groups), users_of(groups))
    keyed = keyed_records(records, app_range=app_range, fmt=fmt)
    keyed = prefilter(keyed, failed.select(*RECORD_KEY), RECORD_KEY)
    # one small row per (attempt, container), written once: the per-attempt
    # aggregate and the lost-executor lookup both read it, so the container
    # logs are scanned (and their regexes run) exactly once
    level1 = per_container(record_features(keyed, fmt, all_frames=all_frames))
    if materialize_steps:
        level1 = materialize(level1, "container-features")
    verdicts = diagnose(per_attempt(level1), level1)
    return (failed.join(verdicts, RECORD_KEY, "inner")
            .select("app_id", "attempt_nb", "user", "start_time", "end_time", "containers",
                    "error_category", "exception", "stage", "source_line"))
