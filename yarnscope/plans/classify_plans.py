"""Failure classification plans.

``classify`` renders the resource-manager log and the aggregated container
logs from ``events``, parses both, reconstructs the failed attempts and
diagnoses them. Its oracle takes the failed attempts straight from the event
columns and the expected diagnosis from the case each attempt's logs follow.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import attempts as A
from ..operators import report as R
from ..operators.classify import classify_attempts
from ..operators.condense import read_long_records
from .classify_cases import CASES
from .log_plans import FULL_RANGE, WITH_ALL, classifier_lines
from ..sources.text import read_records
from .render import container_log_path


def diagnosis(spark: SparkSession, sf_dir: str, read=read_records):
    records = read(spark, container_log_path(spark, sf_dir))
    return classify_attempts(records, classifier_lines(spark, sf_dir), app_range=FULL_RANGE)


def q_classify(spark, sf_dir, read=read_records):
    return diagnosis(spark, sf_dir, read).select(
        "app_id", F.col("attempt_nb").cast("bigint"), "user", "start_time", "end_time",
        A.containers_text().alias("containers"),
        *[F.col(c).cast("bigint").alias(c) for c in ("error_category",)], "exception",
        F.col("stage").cast("bigint"), F.col("source_line").cast("bigint"))


def q_classify_by_lines(spark, sf_dir):
    """The same from condensed records: container logs of any size."""
    return q_classify(spark, sf_dir, read_long_records)


def q_report_text(spark, sf_dir):
    return R.failure_blocks(diagnosis(spark, sf_dir)).select(
        "app_id", F.col("attempt_nb").cast("bigint"), "text")


QUERIES = {
    "classify": q_classify,
    "classify_by_lines": q_classify_by_lines,
    "report_text": q_report_text,
}


def _case(i: int) -> str:
    keys = "(CAST(app_id AS BIGINT) * 3 + attempt_nb - 1) % " + str(len(CASES))
    whens = " ".join(f"WHEN {k} THEN {repr(c[3][i]) if isinstance(c[3][i], str) else c[3][i]}"
                     for k, c in enumerate(CASES))
    return f"CASE {keys} {whens} END"


_FAILED = WITH_ALL + """,
    users AS (SELECT app_id, arg_max("user", event_id) AS "user" FROM rm WHERE "user" <> '' GROUP BY app_id),
    failed AS (
      SELECT att.*, coalesce(users."user", '') AS "user",
             CAST(""" + _case(0) + """ AS BIGINT) AS error_category,
             """ + _case(1) + """ AS exception,
             CAST(""" + _case(2) + """ AS BIGINT) AS stage,
             CAST(""" + _case(3) + """ AS BIGINT) AS source_line
      FROM att LEFT JOIN users USING (app_id)
      WHERE exit_code <> 0 OR final_status = 'FAILED')"""

ORACLE = {
    "classify": _FAILED + """
        SELECT app_id, attempt_nb, "user", start_time, end_time, containers,
               error_category, exception, stage, source_line FROM failed""",
    "report_text": _FAILED + """,
        rc AS (
          SELECT DISTINCT app_id, attempt_nb, container_id, container_host FROM rm
          WHERE attempt_nb > 0 AND container_id IS NOT NULL AND NOT (exit_code = 0 AND is_launch)),
        rcs AS (
          SELECT app_id, attempt_nb,
                 string_agg(printf('container_e02_1580812675067_%s_%02d_%06d -> %s', app_id, attempt_nb,
                                   container_id, container_host), ', ' ORDER BY container_id, container_host) AS c
          FROM rc GROUP BY app_id, attempt_nb)
        SELECT f.app_id, f.attempt_nb,
               printf(chr(10) || chr(10) || 'AppAttempt  : appattempt_1580812675067_%s_%06d'
                      || chr(10) || chr(10) || 'User          : %s'
                      || chr(10) || chr(10) || 'StartTime     : %s'
                      || chr(10) || chr(10) || 'EndTime       : %s'
                      || chr(10) || chr(10) || 'Containers    : %s'
                      || chr(10) || chr(10) || 'ErrorCategory : %d'
                      || chr(10) || chr(10) || 'Exception     : %s'
                      || chr(10) || chr(10) || 'Stage         : %d'
                      || chr(10) || chr(10) || 'SourceCodeLine: %d ',
                      f.app_id, f.attempt_nb, f."user", f.start_time, f.end_time, coalesce(rcs.c, ''),
                      f.error_category, f.exception, f.stage, f.source_line) AS text
        FROM failed f LEFT JOIN rcs ON f.app_id = rcs.app_id AND f.attempt_nb = rcs.attempt_nb""",
}
ORACLE["classify_by_lines"] = ORACLE["classify"]
