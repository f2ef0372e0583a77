"""End-to-end jobs over log files and CSV inputs.

* ``run_reconstruction``  resource-manager log -> applications, attempts,
  application report blocks for an id range, the seven question lines
* ``failure_report``      resource-manager log + aggregated container logs +
  inclusive id range -> diagnosis of every failed attempt (optionally
  written as the text report)
* ``validate_report``     a written report -> parsed blocks and the
  accept / reject summary
* ``workload``            one of the CSV aggregation / join workloads

Every function returns DataFrames; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.patterns import DEFAULT_FORMAT, RECORD_DELIMITER, LogFormat
from .operators import attempts as A
from .operators import questions as Q
from .operators import report as R
from .operators import workloads as W
from .operators.classify import classify_attempts
from .operators.condense import read_long_records
from .operators.lines import parse_rm_lines
from .session import materialize
from .sources import csv as C
from .sources.text import position, read_lines


def run_reconstruction(spark: SparkSession, rm_log: str | list[str], *,
                       report_range: tuple[int, int] = (121, 130), by_time: bool = False,
                       fmt: LogFormat = DEFAULT_FORMAT) -> dict[str, DataFrame]:
    """Applications and attempts of a resource-manager log, the application
    report for ``report_range`` (inclusive) and the question lines. ``by_time``
    orders rotated files by their first timestamp instead of their names."""
    groups = materialize(A.line_groups(parse_rm_lines(read_lines(spark, rm_log, by_time=by_time), with_exit_code=False, fmt=fmt)),
                         "run-groups")
    apps, atts = A.applications_of(groups), A.attempts_of(groups)
    full = A.applications_with_attempts(apps, atts)
    lo, hi = report_range
    in_range = full.where(F.col("app_id").try_cast("int").between(int(lo), int(hi)))
    return {"applications": apps, "attempts": atts,
            "report": R.application_blocks(in_range, fmt).orderBy("app_id"),
            "questions": Q.question_lines(apps, atts)}


def failure_report(spark: SparkSession, rm_log: str | list[str], container_logs: str | list[str],
                   first_id: int, last_id: int, *, out: str | None = None, by_time: bool = False,
                   delimiter: str = RECORD_DELIMITER, fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """Diagnose the failed attempts of applications ``first_id..last_id``.

    Container logs are read by lines, so a container's log may have any size.
    """
    rng = (int(first_id), int(last_id))
    lines = parse_rm_lines(read_lines(spark, rm_log, by_time=by_time), with_exit_code=True, app_range=rng, fmt=fmt)
    diag = classify_attempts(read_long_records(spark, container_logs, delimiter), lines, app_range=rng, fmt=fmt)
    if out is not None:
        diag = materialize(diag, "diagnosis")  # sorting, writing and the caller read it
        R.write_report(R.failure_blocks(diag, fmt), out, ["app_id", "attempt_nb"])
    return diag


def validate_report(spark: SparkSession, path: str, fmt: LogFormat = DEFAULT_FORMAT) -> dict[str, DataFrame]:
    """Parsed blocks (``valid`` flag per block) and the one-row summary."""
    parsed = R.parse_report(R.read_report(spark, path, fmt), fmt)
    return {"blocks": parsed, "summary": R.validate_report(parsed)}


def workload(spark: SparkSession, name: str, path: str, dim_path: str | None = None) -> DataFrame:
    """Run one CSV workload: ``scaled_sum``, ``composite_sum``, ``modsum_total``,
    ``modsum_by_key``, ``theta_join_sum`` (needs ``dim_path``) or ``around_half_max``."""
    if name == "scaled_sum":
        return W.scaled_sum(C.read_str_int_int(spark, path), "c1", "c2", 10)
    if name == "composite_sum":
        return W.composite_sum(C.read_str_int_int(spark, path), ["c0", "c1"], "c2")
    if name == "modsum_total":
        return W.modsum_total(C.read_int_int(spark, path), "k", "v", 2, 100)
    if name == "modsum_by_key":
        return W.modsum_by_key(C.read_int_int(spark, path), "k", "v", 2, 50)
    if name == "theta_join_sum":
        fact = C.read_str_int_int(spark, path)
        dim = C.read_str_int(spark, dim_path, position().alias("pos"))
        return W.theta_join_sum(fact, dim, "c0", "c2", "c0", "c1", sum_of="right", dim_order="pos")
    if name == "around_half_max":
        return W.around_half_max(C.read_int_int(spark, path), "k", "v")
    raise ValueError(f"unknown workload {name!r}")
