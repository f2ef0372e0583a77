"""Report sink / reader plans and the record scan of container logs.

``report_roundtrip`` writes the failure report as text (one block per
failed attempt, in key order, as distributed part files), reads it back
split at the block keyword and parses every block. ``report_quarantine``
does the same after damaging one field in the blocks of every second
attempt (four kinds of damage in turn), and reports which blocks parse;
``report_validation`` is the accept / reject summary. ``container_records``
scans the star-delimited container logs and keys each record;
``record_scan`` reads every ``documents`` text back from star-delimited
record files, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_CLUSTER
from ..operators import report as R
from ..operators.condense import read_long_records
from ..operators.containers import keyed_records
from ..session import scratch_path
from ..sources.text import read_records
from .classify_plans import _FAILED, diagnosis
from .render import container_log_path, document_records_path

# ---- fixed values: the four kinds of damage of a report block -----------------
DAMAGE = [
    ("Stage         : ", "Stage         : x"),            # non-numeric stage
    ("User          : ", "Usr           : "),             # missing User field
    ("StartTime     : ", "StartTime     : 2020-04-07 "),  # timestamp without time
    ("EndTime       : ", "EndTime       ; "),             # broken separator
]


def _damaged(blocks: DataFrame) -> DataFrame:
    kind = F.col("app_num") % len(DAMAGE)
    text = F.col("text")
    hit = F.col("attempt_nb") == 2
    out = text
    for i, (a, b) in enumerate(DAMAGE):
        out = F.when(hit & (kind == i), F.replace(text, F.lit(a), F.lit(b))).otherwise(out)
    return blocks.withColumn("text", out)


def _written_report(spark: SparkSession, sf_dir: str, damage: bool) -> DataFrame:
    blocks = (R.failure_blocks(diagnosis(spark, sf_dir))
              .withColumn("app_num", F.col("app_id").try_cast("int")))
    if damage:
        blocks = _damaged(blocks)
    path = scratch_path(spark, "failure-report")
    R.write_report(blocks, path, ["app_id", "attempt_nb"])
    return R.parse_report(R.read_report(spark, path))


def q_report_roundtrip(spark, sf_dir):
    parsed = _written_report(spark, sf_dir, damage=False)
    return parsed.select(
        "attempt_id", "user", "start_time", "end_time",
        F.array_join(F.transform("containers", lambda c: F.concat_ws(" -> ", c["container"], c["host"])),
                     ", ").alias("containers"),
        F.col("error_category").cast("bigint"), "exception", F.col("stage").cast("bigint"),
        F.col("source_line").cast("bigint"))


def q_report_quarantine(spark, sf_dir):
    return _written_report(spark, sf_dir, damage=True).select("attempt_ref", "valid", "misfit.field", F.col("misfit.at").cast("bigint").alias("char_at"))


def q_report_validation(spark, sf_dir):
    return R.validate_report(_written_report(spark, sf_dir, damage=True)).select(
        "n_blocks", "n_invalid", "accepted", "first_invalid_ref", "first_invalid_field", F.col("first_invalid_offset").cast("bigint"))


def q_container_records(spark, sf_dir):
    keyed = keyed_records(read_records(spark, container_log_path(spark, sf_dir)))
    return keyed.select(F.col("app_num").cast("bigint"), F.col("attempt_nb").cast("bigint"),
                        F.col("cid").cast("bigint"), "host", "is_drv_header",
                        F.length("value").cast("bigint").alias("n_chars"))


def q_container_records_by_lines(spark, sf_dir):
    """The same from condensed records; their length is that of the whole ones."""
    keyed = keyed_records(read_long_records(spark, container_log_path(spark, sf_dir)), keep=["n_chars"])
    return keyed.select(F.col("app_num").cast("bigint"), F.col("attempt_nb").cast("bigint"), F.col("cid").cast("bigint"), "host", "is_drv_header", "n_chars")


def q_record_scan(spark, sf_dir):
    """Every document as one star-delimited record, read back whole."""
    recs = read_records(spark, document_records_path(spark, sf_dir))
    return recs.select(F.md5("value").alias("text_md5"), F.length("value").cast("bigint").alias("n_chars"))


QUERIES = {
    "record_scan": q_record_scan,
    "report_roundtrip": q_report_roundtrip,
    "report_quarantine": q_report_quarantine,
    "report_validation": q_report_validation,
    "container_records": q_container_records,
    "container_records_by_lines": q_container_records_by_lines,
}

# A block parses when its user and both timestamps are present (the report
# grammar has no empty user or time); attempts without a launch line have no
# start time, so their blocks are rejected, as the grammar requires.
_GRAMMAR_OK = "(f.\"user\" <> '' AND f.start_time <> '' AND f.end_time <> '')"
_ATTEMPT_REF = f"'appattempt_{DEFAULT_CLUSTER}_' || app_id || '_' || lpad(CAST(attempt_nb AS VARCHAR), 6, '0')"


def _container_records_sql() -> str:
    from .classify_cases import CASES, DRIVER_DECOY, DRIVER_FILLER, EXECUTOR_FILLER, IDLE_EXECUTOR
    n = len(CASES)
    with_exec = ", ".join(str(i) for i, c in enumerate(CASES) if c[2])
    # an application number of more than four digits makes the header longer
    header_len = len("Container: container_e02_1580812675067_0000_00_000000 on iccluster000.iccluster.epfl.ch"
                     "_45454_1589561045949\nLogType:stderr\nLogContents:\n")
    # body lengths with the placeholders filled: {T} is 17 characters, {A} 4, {N2} 2, {C} 13
    def filled(t: str) -> int:
        return (len(t) + t.count("{T}") * (17 - 3) + t.count("{A}") * (4 - 3) + t.count("{N2}") * (2 - 4)
                + t.count("{C}") * (13 - 3))
    drv = " ".join(f"WHEN {i} THEN {filled(DRIVER_FILLER + c[1])}" for i, c in enumerate(CASES))
    exe = " ".join(f"WHEN {i} THEN {filled(EXECUTOR_FILLER + c[2])}" for i, c in enumerate(CASES) if c[2])
    drv_a = " ".join(f"WHEN {i} THEN {(DRIVER_FILLER + c[1]).count('{A}')}" for i, c in enumerate(CASES))
    exe_a = " ".join(f"WHEN {i} THEN {(EXECUTOR_FILLER + c[2]).count('{A}')}" for i, c in enumerate(CASES) if c[2])
    return f"""
        WITH a AS (SELECT DISTINCT user_id, event_id % 3 + 1 AS attempt_nb FROM events),
             r AS (SELECT user_id, attempt_nb, cid, (user_id * 3 + attempt_nb - 1) % {n} AS k
                   FROM a, (VALUES (1), (2), (3)) c(cid)
                   UNION ALL SELECT user_id, attempt_nb, 1, -1 FROM a WHERE (user_id + attempt_nb) % 6 < 2
                   UNION ALL SELECT user_id, attempt_nb, 1, -1 FROM a WHERE (user_id + attempt_nb) % 6 = 0)
        SELECT CAST(user_id AS BIGINT) AS app_num, CAST(attempt_nb AS BIGINT) AS attempt_nb,
               CAST(cid AS BIGINT) AS cid,
               'iccluster' || lpad(CAST(40 + (user_id + cid) % 20 AS VARCHAR), 3, '0') || '.iccluster.epfl.ch' AS host,
               cid = 1 AS is_drv_header,
               CAST({header_len} + 1 + greatest(0, length(CAST(user_id AS VARCHAR)) - 4) * (1 + CASE WHEN cid = 1 THEN CASE k {drv_a} ELSE 0 END WHEN cid = 2 THEN CASE k {exe_a} END ELSE {IDLE_EXECUTOR.count("{A}")} END) + CASE WHEN cid = 1 THEN CASE k {drv} ELSE {filled(DRIVER_DECOY)} END
                                         WHEN cid = 2 THEN CASE k {exe} END
                                         ELSE {filled(IDLE_EXECUTOR)} END AS BIGINT) AS n_chars
        FROM r WHERE cid <> 2 OR k IN ({with_exec})"""


# every field label has 16 characters and a blank line before it; the block begins with "  : ", behind the keyword
_JUDGED = _FAILED + f""",
    rc AS (SELECT DISTINCT app_id, attempt_nb, container_id, container_host FROM rm
           WHERE attempt_nb > 0 AND container_id IS NOT NULL AND NOT (exit_code = 0 AND is_launch)),
    rcs AS (SELECT app_id, attempt_nb, sum(length(printf('container_e02_{DEFAULT_CLUSTER}_%s_%02d_%06d -> %s', app_id, attempt_nb, container_id, container_host)) + 2) - 2 AS n
            FROM rc GROUP BY app_id, attempt_nb),
    sized AS (SELECT f.*, {_ATTEMPT_REF.replace('app_id', 'f.app_id').replace('attempt_nb', 'f.attempt_nb')} AS attempt_ref, f.app_id || '_' || lpad(CAST(f.attempt_nb AS VARCHAR), 6, '0') AS place,
                     CASE WHEN f.attempt_nb = 2 THEN CAST(f.app_id AS BIGINT) % 4 ELSE -1 END AS kind, coalesce(rcs.n, 0) AS listed
              FROM failed f LEFT JOIN rcs ON f.app_id = rcs.app_id AND f.attempt_nb = rcs.attempt_nb),
    judged AS (SELECT attempt_ref, place, field IS NULL AS valid, field,
                      CAST(CASE WHEN field IS NOT NULL THEN 6 + length(attempt_ref) END
                           + CASE field WHEN 'User' THEN 0 WHEN 'StartTime' THEN 18 + length("user") WHEN 'EndTime' THEN 36 + length("user") + length(start_time)
                             ELSE 108 + length("user") + length(start_time) + length(end_time) + listed + length(CAST(error_category AS VARCHAR)) + length(exception) END AS BIGINT) AS char_at
               FROM (SELECT *, CASE WHEN kind = 1 OR "user" = '' THEN 'User' WHEN kind = 2 OR start_time = '' THEN 'StartTime'
                                    WHEN kind = 3 OR end_time = '' THEN 'EndTime' WHEN kind = 0 THEN 'Stage' END AS field FROM sized))"""

ORACLE = {
    "record_scan": """SELECT md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents""",
    "report_roundtrip": _FAILED + f""",
        rc AS (
          SELECT DISTINCT app_id, attempt_nb, container_id, container_host FROM rm
          WHERE attempt_nb > 0 AND container_id IS NOT NULL AND NOT (exit_code = 0 AND is_launch)),
        rcs AS (
          SELECT app_id, attempt_nb,
                 string_agg(printf('container_e02_1580812675067_%s_%02d_%06d -> %s', app_id, attempt_nb,
                                   container_id, container_host), ', ' ORDER BY container_id, container_host) AS c
          FROM rc GROUP BY app_id, attempt_nb)
        SELECT CASE WHEN {_GRAMMAR_OK} THEN {_ATTEMPT_REF.replace('app_id', 'f.app_id').replace('attempt_nb', 'f.attempt_nb')} END AS attempt_id,
               CASE WHEN {_GRAMMAR_OK} THEN f."user" END AS "user",
               CASE WHEN {_GRAMMAR_OK} THEN f.start_time END AS start_time,
               CASE WHEN {_GRAMMAR_OK} THEN f.end_time END AS end_time,
               CASE WHEN {_GRAMMAR_OK} THEN coalesce(rcs.c, '') END AS containers,
               CASE WHEN {_GRAMMAR_OK} THEN f.error_category END AS error_category,
               CASE WHEN {_GRAMMAR_OK} THEN f.exception END AS exception,
               CASE WHEN {_GRAMMAR_OK} THEN f.stage END AS stage,
               CASE WHEN {_GRAMMAR_OK} THEN f.source_line END AS source_line
        FROM failed f LEFT JOIN rcs ON f.app_id = rcs.app_id AND f.attempt_nb = rcs.attempt_nb""",
    "report_quarantine": _JUDGED + " SELECT attempt_ref, valid, field, char_at FROM judged",
    "report_validation": _JUDGED + """
        SELECT CAST(count(*) AS BIGINT) AS n_blocks, CAST(count(*) FILTER (WHERE NOT valid) AS BIGINT) AS n_invalid,
               count(*) FILTER (WHERE NOT valid) = 0 AS accepted, arg_min(attempt_ref, place) FILTER (WHERE NOT valid) AS first_invalid_ref,
               arg_min(field, place) FILTER (WHERE NOT valid) AS first_invalid_field, arg_min(char_at, place) FILTER (WHERE NOT valid) AS first_invalid_offset
        FROM judged""",
    "container_records": _container_records_sql(),
}
ORACLE["container_records_by_lines"] = ORACLE["container_records"]
