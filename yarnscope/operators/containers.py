"""Aggregated container-log records -> keyed records -> small feature rows.

Every classification rule needs only a few facts from each container log, so
they are extracted here, record by record, right after the scan (narrow, no
shuffle); the log text is dropped before anything is grouped or joined.
Driver-only facts are computed only for driver records and executor-only
facts only for executor records (``CASE WHEN`` evaluates the chosen branch
only), which keeps the regex work per byte small.

A record is kept when it has a ``Container:`` header naming an application.
Its attempt comes from the first line that carries any attempt or container
id (the last such id in that line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.patterns import DEFAULT_EXCEPTION, DEFAULT_FORMAT, LogFormat

RECORD_KEY = ["app_num", "attempt_nb"]


def keyed_records(records: DataFrame, *, app_range: tuple[int, int] | None = None,
                  fmt: LogFormat = DEFAULT_FORMAT, keep: list[str] | None = None) -> DataFrame:
    """``(value, pos)`` -> ``(app_num, attempt_nb, cid, host, is_drv_header, value, pos)`` and the columns of ``keep``."""
    p = fmt.container_log
    v = F.col("value")
    out = (records.where(v.rlike(p["header_app"]))
           .select(F.regexp_extract(v, p["header_app"], 1).try_cast("int").alias("app_num"),
                   F.regexp_extract(v, X.line_start(p["record_attempt"]), 2).try_cast("int").alias("attempt_nb"),
                   F.regexp_extract(v, p["header_container"], 1).try_cast("int").alias("cid"),
                   F.regexp_extract(v, p["header_container"], 2).alias("host"),
                   v.rlike(p["driver_header"]).alias("is_drv_header"),
                   v, F.col("pos"), *(keep or [])))
    if app_range is not None:
        out = out.where(F.col("app_num").between(int(app_range[0]), int(app_range[1])))
    return out


# ---- fixed values: literals that every match of the corresponding pattern
# contains. A pattern only runs on records that contain its literal, which
# gives the same result and skips the (backtracking) regex on most records.
GUARDS = {
    "class_not_found": ("ClassNotFoundException",),
    "missing_input": ("InvalidInputException",),
    "frame_line": ("(App",),
    "driver_failure": ("INFO ApplicationMaster: Final app status: ",),
    "cancel_stage_any": ("INFO YarnClusterScheduler: Cancelling stage ",),
    "final_stage": ("INFO DAGScheduler: Final stage: ResultStage ",),
    "channel_handler_exc": ("WARN TransportChannelHandler: ",),
    "am_error": (" ERROR ApplicationMaster: ",),
    "am_nested_exc": (" ERROR ApplicationMaster: User class threw exception: ",),
    "task_set_manager": (" ERROR TaskSetManager: ",),
    "short_circuit_exc": ("ERROR ShortCircuitCache:",),
    "executor_msg": (" ERROR Executor: ",),
    "utils_error_exc": (" ERROR Utils: ",),
    "am_threw_exc": (" threw exception: ",),
    "error_actor": (" ERROR ",),
    "lost_executor": (" ERROR YarnClusterScheduler: Lost executor ",),
    "executor_exc": (" ERROR Executor: ",),
    "app_line": ("scala:",),
    "utils_info_exc": (" INFO Utils: ",),
    "am_user_exc": (" ERROR ApplicationMaster: User class threw exception: ",),
    "dag_failed": (" INFO DAGScheduler: ",),
    "cancel_stage": (" INFO YarnClusterScheduler: Cancelling stage ",),
    "any_error": (" ERROR",),
    "generic_stage": ("stage ",),
    "generic_exc": ("java.", "org.apache.spark."),
    "generic_line": ("App",),
}


def _g(v: Column, key: str) -> Column:
    return X.contains_any(v, GUARDS[key])


def _found(c: dict, v: Column, key: str) -> Column:
    """``rlike`` behind its guard."""
    return _g(v, key) & v.rlike(X.line_start(c[key]))


def _extract(c: dict, v: Column, key: str, group: int) -> Column:
    """First-match group behind its guard; NULL when there is no match."""
    return F.when(_found(c, v, key), F.regexp_extract(v, X.line_start(c[key]), group))


def _extract_or(c: dict, v: Column, key: str, group: int, default: str = "") -> Column:
    return F.coalesce(_extract(c, v, key, group), F.lit(default))


def _extract_all(c: dict, v: Column, key: str, group: int) -> Column:
    return F.when(_g(v, key), X.extract_all(v, c[key], group)).otherwise(F.array().cast("array<string>"))


def _choose_exception(c: dict, v: Column) -> Column:
    """The driver's fallback exception: after an ``ERROR Utils`` line, else
    from an ``ApplicationMaster ... threw exception`` line, else ''."""
    utils = _extract_or(c, v, "utils_error_exc", 1)
    am = _extract_or(c, v, "am_threw_exc", 2)
    return F.when(utils != "", utils).otherwise(am)


def _generic(c: dict, v: Column, all_frames: bool = False) -> Column:
    """Facts for the generic rule: max stage, first specific
    exception, lowest failed-stage source line.

    Only the failed-stage alternative of the line pattern yields a number
    (the other two alternatives capture into groups that are never read);
    ``all_frames=True`` also reads those (``main`` frames and ``failed``
    lines). No higher-order functions, so the projection stays in
    whole-stage code generation: stage and line captures are digit strings
    cast as arrays; a value beyond the int range is no valid stage or line
    and is ignored.
    """
    stage = F.array_max(_extract_all(c, v, "generic_stage", 1).try_cast("array<bigint>")).try_cast("int")
    specific = F.try_element_at(F.array_remove(_extract_all(c, v, "generic_exc", 1), DEFAULT_EXCEPTION), F.lit(1))
    groups = [2, 3, 4] if all_frames else [2]
    found = F.concat(*[_extract_all(c, v, "generic_line", g) for g in groups]) if len(groups) > 1 \
        else _extract_all(c, v, "generic_line", 2)
    low = F.array_min(F.array_remove(found, "").try_cast("array<bigint>"))
    return F.struct(F.coalesce(stage, F.lit(-1)).alias("stage"),
                    F.coalesce(specific, F.lit(DEFAULT_EXCEPTION)).alias("exception"),
                    F.when(low <= F.lit(2147483647), low.cast("int")).otherwise(F.lit(-1)).alias("line"))


def _frame_line(c: dict, trace: Column) -> Column:
    return X.int_or(_extract(c, trace, "frame_line", 1), -1)


def record_features(keyed: DataFrame, fmt: LogFormat = DEFAULT_FORMAT, *, all_frames: bool = False) -> DataFrame:
    """Keyed records -> ``(app_num, attempt_nb, cid, pos, is_drv_header, any_f, drv_f, exe_f)``.

    ``any_f``: facts every record contributes (missing-input rule, first
    error for the generic executor rule, the lost-executor exception).
    ``drv_f``: driver facts, NULL unless the record is a driver record.
    ``exe_f``: executor facts for the block-fetch / cache / heartbeat rules,
    NULL for the driver.
    """
    c = fmt.cls
    v = F.col("value")
    flat = X.flatten_lines(v)
    is_driver = (F.col("cid") == 1) | F.col("is_drv_header")

    # -- facts of every record; the two patterns that run up to the last
    # boundary of the record are searched in the text before it
    before = F.when(_g(v, "missing_input") | _g(v, "driver_failure"), X.before_last(v, c["boundary"]))
    missing_input, driver_failure = (X.until_boundary(c[k], c["boundary"]) for k in ("missing_input", "driver_failure"))
    missing = _g(v, "missing_input") & before.rlike(missing_input)
    ex_hit = _found(c, v, "executor_exc")
    any_f = F.struct(
        missing.alias("f2_hit"),
        F.when(missing, _frame_line(c, F.regexp_extract(before, missing_input, 2))).alias("f2_line"),
        _found(c, v, "any_error").alias("has_error"),
        F.when(_found(c, v, "any_error"), _generic(c, v, all_frames)).alias("generic"),
        ex_hit.alias("ex_hit"),
        F.when(ex_hit, F.regexp_extract(v, c["executor_exc"], 1)).alias("ex_exc"),
        F.when(ex_hit, F.when(F.regexp_extract(v, c["executor_exc"], 2).contains(c["user_code_marker"]), 5)
               .otherwise(6)).alias("ex_type"),
        X.int_or(_extract(c, v, "app_line", 1), -1).alias("ex_app_line"),
    )

    # -- driver facts
    f3_match = _g(v, "driver_failure") & before.rlike(driver_failure)
    f3_exc_text = F.when(f3_match, F.regexp_extract(before, driver_failure, 2)).otherwise(F.lit(""))
    cancels = _extract_all(c, v, "cancel_stage_any", 2)
    actors = _extract_all(c, v, "error_actor", 1)
    # leading "Utils" actors: actor names are \w*, so joined with commas the
    # leading run is matched by one anchored pattern of "Utils," items
    u = c["utils_actor"]
    leading = F.regexp_extract(F.array_join(actors, ","), rf"^((?:{u}(?:,|$))*)", 1)
    utils_before = F.floor((F.length(leading) + 1) / (len(u) + 1)).cast("int")
    am_err = _extract(c, v, "am_error", 1)
    final_stage = X.line_start(c["final_stage"])
    final_stage_on = _g(v, "final_stage")
    drv_f = F.when(is_driver, F.struct(
        _found(c, v, "class_not_found").alias("f1_hit"),
        (f3_match & ~f3_exc_text.contains(c["stage_failure"])).alias("f3_hit"),
        X.prefix_to_colon(f3_exc_text).alias("f3_exc"),
        X.int_or(F.try_element_at(cancels, F.lit(-1)), -1).alias("f3_stage"),
        F.when(f3_match, _frame_line(c, F.regexp_extract(before, driver_failure, 3))).otherwise(-1).alias("f3_line"),
        # one extraction per group: '' is "no match" (or an empty number)
        F.when(final_stage_on, X.int_or(F.regexp_extract(v, final_stage, 1), -1)).otherwise(-1).alias("final_stage"),
        F.when(final_stage_on, X.int_or(F.regexp_extract(v, final_stage, 2), -1)).otherwise(-1).alias("final_line"),
        v.contains(c["max_result_size"]).alias("max_result"),
        v.contains(c["block_manager"]).alias("bm"),
        F.when(v.contains(c["block_manager"]), X.prefix_to_colon(
            X.last_exception_word(flat, c["block_manager"] + " "))).otherwise(F.lit("")).alias("bm_exc"),
        v.contains(c["channel_handler"]).alias("tch"),
        _extract_or(c, v, "channel_handler_exc", 1).alias("tch_exc"),
        v.contains(c["result_getter"]).alias("trg"),
        v.contains(c["yarn_scheduler"]).alias("ycs"),
        v.contains(c["leak_detector"]).alias("leak"),
        v.contains(c["response_handler"]).alias("trh"),
        (am_err.isNotNull() & ~am_err.contains(c["executor_lost_failure"])).alias("am_ok"),
        _extract(c, v, "am_nested_exc", 1).alias("am_nested"),
        F.coalesce(_extract(c, v, "task_set_manager", 1).contains(c["driver_word"]), F.lit(False))
         .alias("tsm_driver"),
        _choose_exception(c, v).alias("fallback_exc"),
        F.coalesce(F.try_element_at(actors, utils_before + 1), F.lit("")).alias("first_actor"),
        utils_before.alias("utils_before"),
        _found(c, v, "lost_executor").alias("lost_hit"),
        _extract(c, v, "lost_executor", 1).try_cast("int").alias("lost_cid"),
        _extract_or(c, v, "utils_info_exc", 1).alias("utils_info_exc"),
        _extract_or(c, v, "am_user_exc", 1).alias("am_user_exc"),
        X.int_or(_extract(c, v, "dag_failed", 1), -1).alias("dag_line"),
        X.int_or(_extract(c, v, "cancel_stage", 1), -1).alias("cancel_stage"),
    ))

    # -- executor facts (first matching kind wins, as in an if / else-if chain)
    kind = (F.when(v.contains(c["block_fetcher"]), F.lit("fetch"))
            .when(v.contains(c["short_circuit"]), F.lit("cache"))
            .when(v.contains(c["executor_error"]), F.lit("heartbeat")))
    exe_exc = (F.when(kind == "fetch", X.exception_after(flat, c["block_fetcher"] + " "))
               .when(kind == "cache", _extract_or(c, v, "short_circuit_exc", 1))
               .otherwise(F.lit("")))
    exe_f = F.when(F.col("cid") > 1, F.struct(
        kind.alias("kind"),
        exe_exc.alias("exc"),
        F.coalesce(F.when(kind == "heartbeat", _extract(c, v, "executor_msg", 1).contains(c["driver_word"])),
                   F.lit(False)).alias("hb_driver"),
    ))

    return keyed.select(*RECORD_KEY, "cid", "pos", "is_drv_header",
                        any_f.alias("any_f"), drv_f.alias("drv_f"), exe_f.alias("exe_f"))
