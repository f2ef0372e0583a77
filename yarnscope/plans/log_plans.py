"""Run reconstruction plans: resource-manager lines rendered from ``events``,
parsed, folded into attempts and applications, and the seven questions.

Every plan reads the whole ``events`` table. The classifier variant keeps
exit codes and applies the (inclusive) application range, here the full
integer range; the run-reconstruction variant reads no exit codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import attempts as A
from ..operators import questions as Q
from ..operators import report as R
from ..operators.lines import INT_MAX, parse_rm_lines
from ..session import materialize, scratch_path
from ..sources.text import read_lines
from .render import rm_log_path

FULL_RANGE = (0, INT_MAX)
#: A range of application numbers that leaves out both ends of the smallest tables.
SOME_RANGE = (5, 11)


def classifier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rm_lines(read_lines(spark, rm_log_path(spark, sf_dir)),
                          with_exit_code=True, app_range=FULL_RANGE)


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_rm_lines(read_lines(spark, rm_log_path(spark, sf_dir)), with_exit_code=False)


def _attempt_out(df: DataFrame, *extra: str) -> DataFrame:
    return df.select("app_id", F.col("attempt_nb").cast("bigint"), "start_time", "end_time", "final_status",
                     F.col("exit_code").cast("bigint"), A.containers_text().alias("containers"), *extra)


def q_rm_lines(spark, sf_dir):
    return classifier_lines(spark, sf_dir).select(
        "app_id", F.col("attempt_nb").cast("bigint"), F.col("exit_code").cast("bigint"), "user", "ts",
        "is_launch", "final_status", F.col("container.id").cast("bigint").alias("container_id"),
        F.col("container.host").alias("container_host"))


def q_attempts_in_range(spark, sf_dir):
    lines = parse_rm_lines(read_lines(spark, rm_log_path(spark, sf_dir)), with_exit_code=True, app_range=SOME_RANGE)
    return _attempt_out(A.attempts_of(A.line_groups(lines)))


def q_application_text_in_range(spark, sf_dir):
    from ..jobs import run_reconstruction
    # written in its order and read back: ``place`` is where a block stands in the report
    path = scratch_path(spark, "application-report")
    run_reconstruction(spark, rm_log_path(spark, sf_dir), report_range=SOME_RANGE)["report"].write.parquet(path)
    written = spark.read.parquet(path).select("app_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return written.select("app_id", "text", F.row_number().over(Window.orderBy("file", "row")).cast("bigint").alias("place"))


def q_attempts(spark, sf_dir):
    return _attempt_out(A.attempts_of(A.line_groups(classifier_lines(spark, sf_dir))))


def q_applications(spark, sf_dir):
    return A.applications_of(A.line_groups(run_lines(spark, sf_dir))).select(
        "app_id", "user", F.col("num_attempts").cast("bigint"))


def q_failed_attempts(spark, sf_dir):
    g = materialize(A.line_groups(classifier_lines(spark, sf_dir)), "attempt-groups")
    return _attempt_out(A.failed_attempts(A.attempts_of(g), A.users_of(g)), "user")


def _run(spark, sf_dir, shared: bool = False):
    """Applications and attempts from one per-attempt aggregate; when both are
    used (``shared``), the aggregate is written once and read by both."""
    g = A.line_groups(run_lines(spark, sf_dir))
    if shared:
        g = materialize(g, "run-groups")
    return A.applications_of(g), A.attempts_of(g)


def q_q1(spark, sf_dir):
    apps, _ = _run(spark, sf_dir)
    return Q.q1_top_user_by_apps(apps)


def q_q2(spark, sf_dir):
    apps, atts = _run(spark, sf_dir, shared=True)
    return Q.q2_top_user_by_unsuccessful(apps, atts).select("user", F.col("n_unsuccessful").cast("bigint"))


def q_q3(spark, sf_dir):
    return Q.q3_apps_per_start_date(_run(spark, sf_dir)[1])


def q_q4(spark, sf_dir):
    return Q.q4_mean_app_duration(_run(spark, sf_dir)[1])


def q_q5(spark, sf_dir):
    return Q.q5_mean_success_duration(_run(spark, sf_dir)[1])


def q_q6(spark, sf_dir):
    return Q.q6_hosts(Q.hosts_of_lines(run_lines(spark, sf_dir)))


def q_q7(spark, sf_dir):
    return Q.q7_top_host_by_apps(Q.hosts_of_lines(run_lines(spark, sf_dir)))


def q_question_lines(spark, sf_dir):
    apps, atts = _run(spark, sf_dir, shared=True)
    return Q.question_lines(apps, atts)


def q_application_text(spark, sf_dir):
    apps, atts = _run(spark, sf_dir, shared=True)
    return R.application_blocks(A.applications_with_attempts(apps, atts))


QUERIES = {
    "rm_lines": q_rm_lines,
    "attempts": q_attempts,
    "attempts_in_range": q_attempts_in_range,
    "application_text_in_range": q_application_text_in_range,
    "applications": q_applications,
    "failed_attempts": q_failed_attempts,
    "q1": q_q1, "q2": q_q2, "q3": q_q3, "q4": q_q4, "q5": q_q5, "q6": q_q6, "q7": q_q7,
    "question_lines": q_question_lines,
    "application_text": q_application_text,
}

# ---- oracles: expected values straight from the event columns --------------

EVENTS_CTE = """
e AS (
  SELECT event_id, event_type,
         lpad(CAST(user_id AS VARCHAR), greatest(4, length(CAST(user_id AS VARCHAR)))::INT, '0') AS app_id,
         CAST(event_id % 3 + 1 AS BIGINT) AS n,
         strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS ts_text,
         event_id % 13 = 0 AS warn,
         'u' || translate(CAST((user_id * 7 + event_id % 2) % 29 AS VARCHAR), '0123456789', 'abcdefghij') AS uname,
         CAST(event_id % 5 + 1 AS BIGINT) AS cid,
         'iccluster' || lpad(CAST(40 + CAST(floor(value) AS BIGINT) % 20 AS VARCHAR), 3, '0')
           || '.iccluster.epfl.ch' AS host,
         CAST(floor(value) AS BIGINT) % 4 - 1 AS x
  FROM events),
rm AS (
  SELECT app_id,
         CASE WHEN event_type = 'signup' THEN 0 ELSE n END AS attempt_nb,
         CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN x ELSE 0 END AS exit_code,
         CASE WHEN event_type = 'signup' THEN uname ELSE '' END AS "user",
         ts_text AS ts,
         event_type = 'view' AS is_launch,
         CASE WHEN event_type = 'purchase' THEN 'FINISHING'
              WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'FAILED' ELSE '' END AS final_status,
         CASE WHEN event_type = 'click' THEN cid END AS container_id,
         CASE WHEN event_type = 'click' THEN host END AS container_host,
         event_id
  FROM e
  WHERE NOT warn
    AND NOT (event_type = 'view' AND event_id % 11 = 0)
    AND NOT (event_type = 'purchase' AND event_id % 4 = 0)
    AND NOT (event_type = 'error' AND event_id % 2 = 1 AND x = 0)),
rm1 AS (SELECT * FROM rm WHERE exit_code = 0)"""


def _attempts_cte(name: str, src: str) -> str:
    return f"""
{name}_c AS (
  SELECT app_id, attempt_nb,
         string_agg('(' || container_id || ',' || container_host || ')', ', '
                    ORDER BY container_id, container_host) AS containers
  FROM (SELECT DISTINCT app_id, attempt_nb, container_id, container_host FROM {src}
        WHERE attempt_nb > 0 AND container_id IS NOT NULL AND NOT (exit_code = 0 AND is_launch))
  GROUP BY app_id, attempt_nb),
{name} AS (
  SELECT a.app_id, CAST(a.attempt_nb AS BIGINT) AS attempt_nb,
         coalesce(arg_max(ts, event_id) FILTER (WHERE exit_code = 0 AND is_launch), '') AS start_time,
         coalesce(arg_max(ts, event_id) FILTER (WHERE exit_code = 0 AND NOT is_launch
                                                  AND container_id IS NULL), '') AS end_time,
         coalesce(arg_max(final_status, event_id) FILTER (WHERE exit_code = 0 AND NOT is_launch
                                                            AND container_id IS NULL), '') AS final_status,
         CAST(coalesce(arg_max(exit_code, event_id) FILTER (WHERE exit_code <> 0
                                                            AND container_id IS NULL), 0) AS BIGINT) AS exit_code,
         coalesce(any_value(c.containers), '') AS containers
  FROM {src} a LEFT JOIN {name}_c c ON a.app_id = c.app_id AND a.attempt_nb = c.attempt_nb
  WHERE a.attempt_nb > 0
  GROUP BY a.app_id, a.attempt_nb)"""


APPS_CTE = """
apps AS (
  SELECT app_id,
         coalesce(arg_max("user", event_id) FILTER (WHERE "user" <> ''), '') AS "user",
         CAST(count(DISTINCT attempt_nb) FILTER (WHERE attempt_nb <> 0) AS BIGINT) AS num_attempts
  FROM rm1 GROUP BY app_id),
fl AS (
  SELECT app_id, arg_min(start_time, attempt_nb) AS first_start, arg_max(end_time, attempt_nb) AS last_end
  FROM att1 GROUP BY app_id),
hosts AS (
  SELECT DISTINCT app_id, container_host AS host FROM rm1
  WHERE attempt_nb > 0 AND container_id IS NOT NULL AND NOT is_launch)"""

MS = "epoch_ms(try_strptime({c}, '%Y-%m-%d %H:%M:%S,%g'))"

WITH_ALL = "WITH " + EVENTS_CTE + "," + _attempts_cte("att", "rm") + "," + _attempts_cte("att1", "rm1") + "," + APPS_CTE

Q1 = """SELECT "user", CAST(count(*) AS BIGINT) AS n_apps FROM apps GROUP BY "user"
        ORDER BY n_apps DESC, "user" ASC LIMIT 1"""
Q2 = """SELECT "user", CAST(sum(coalesce(bad, 0)) AS BIGINT) AS n_unsuccessful
        FROM apps LEFT JOIN (SELECT app_id, count(*) FILTER (WHERE final_status <> 'FINISHING') AS bad
                             FROM att1 GROUP BY app_id) b USING (app_id)
        GROUP BY "user" ORDER BY n_unsuccessful DESC, "user" ASC LIMIT 1"""
Q3 = """SELECT substring(first_start, 1, 10) AS start_date, CAST(count(*) AS BIGINT) AS n_apps
        FROM fl WHERE first_start <> '' GROUP BY 1"""
Q4 = f"""SELECT CAST(CASE WHEN count(d) > 0 THEN sum(d) // count(d) END AS BIGINT) AS mean_app_ms
         FROM (SELECT {MS.format(c='last_end')} - {MS.format(c='first_start')} AS d FROM fl)"""
Q5 = f"""SELECT CAST(CASE WHEN count(d) > 0 THEN sum(d) // count(d) END AS BIGINT) AS mean_success_ms
         FROM (SELECT {MS.format(c='end_time')} - {MS.format(c='start_time')} AS d FROM att1
               WHERE final_status = 'FINISHING')"""
Q6 = """SELECT CAST(count(*) AS BIGINT) AS n_hosts, coalesce(string_agg(host, ', ' ORDER BY host), '') AS hosts
        FROM (SELECT DISTINCT host FROM hosts)"""
Q7 = """SELECT host, CAST(count(*) AS BIGINT) AS n_apps FROM hosts GROUP BY host
        ORDER BY n_apps DESC, host ASC LIMIT 1"""

ORACLE = {
    "rm_lines": "WITH " + EVENTS_CTE + """
        SELECT app_id, CAST(attempt_nb AS BIGINT) AS attempt_nb, CAST(exit_code AS BIGINT) AS exit_code,
               "user", ts, is_launch, final_status, container_id, container_host FROM rm""",
    "attempts": WITH_ALL + " SELECT * FROM att",
    "applications": WITH_ALL + " SELECT * FROM apps",
    "failed_attempts": WITH_ALL + """,
        users AS (SELECT app_id, arg_max("user", event_id) AS "user" FROM rm WHERE "user" <> '' GROUP BY app_id)
        SELECT att.*, coalesce(users."user", '') AS "user" FROM att LEFT JOIN users USING (app_id)
        WHERE exit_code <> 0 OR final_status = 'FAILED'""",
    "q1": WITH_ALL + " " + Q1,
    "q2": WITH_ALL + " " + Q2,
    "q3": WITH_ALL + " " + Q3,
    "q4": WITH_ALL + " " + Q4,
    "q5": WITH_ALL + " " + Q5,
    "q6": WITH_ALL + " " + Q6,
    "q7": WITH_ALL + " " + Q7,
    "question_lines": WITH_ALL + f""",
        q3t AS (SELECT string_agg(start_date || ': ' || n_apps, ', ' ORDER BY start_date || ': ' || n_apps) AS a
                FROM ({Q3}))
        SELECT CAST(1 AS BIGINT) AS question, (SELECT "user" || ', ' || n_apps FROM ({Q1})) AS answer
        UNION ALL SELECT 2, (SELECT "user" || ', ' || n_unsuccessful FROM ({Q2}))
        UNION ALL SELECT 3, (SELECT coalesce(a, '') FROM q3t)
        UNION ALL SELECT 4, (SELECT CAST(mean_app_ms AS VARCHAR) FROM ({Q4}))
        UNION ALL SELECT 5, (SELECT CAST(mean_success_ms AS VARCHAR) FROM ({Q5}))
        UNION ALL SELECT 6, (SELECT CAST(n_hosts AS VARCHAR) || ', ' || hosts FROM ({Q6}))
        UNION ALL SELECT 7, (SELECT host || ', ' || n_apps FROM ({Q7}))""",
    "application_text": WITH_ALL + """,
        blocks AS (
          SELECT app_id, string_agg(
                   chr(10) || chr(10) || 'AttemptNumber : ' || attempt_nb ||
                   chr(10) || chr(10) || 'StartTime     : ' || start_time ||
                   chr(10) || chr(10) || 'EndTime       : ' || end_time ||
                   chr(10) || chr(10) || 'FinalStatus   : ' || final_status ||
                   chr(10) || chr(10) || 'Containers    : ' || containers, '' ORDER BY attempt_nb) AS t
          FROM att1 GROUP BY app_id)
        SELECT app_id,
               'ApplicationId : application_1580812675067_' || app_id ||
               chr(10) || chr(10) || 'User          : ' || "user" ||
               chr(10) || chr(10) || 'NumAttempts   : ' || num_attempts ||
               coalesce(t, '') || chr(10) || chr(10) AS text
        FROM apps LEFT JOIN blocks USING (app_id)""",
}

_RANGE = f"WHERE CAST(app_id AS BIGINT) BETWEEN {SOME_RANGE[0]} AND {SOME_RANGE[1]}"
ORACLE["attempts_in_range"] = f"SELECT * FROM ({ORACLE['attempts']}) {_RANGE}"
ORACLE["application_text_in_range"] = f"SELECT *, row_number() OVER (ORDER BY app_id) AS place FROM ({ORACLE['application_text']}) {_RANGE}"
