"""Resource-manager log parsing, attempt / application reconstruction and the
seven questions on the line fixture of FIXTURES.md section 3."""

import pytest
from pyspark.sql import functions as F

from yarnscope.operators import attempts as A
from yarnscope.operators import questions as Q
from yarnscope.operators import report as R
from yarnscope.operators.lines import parse_rm_lines
from yarnscope.sources.text import read_lines

RM_LOG = """2020-04-07 15:58:17,101 INFO  capacity.ParentQueue (ParentQueue.java:addApplication(468)) - Application added - appId: application_1580812675067_8123 user: mira leaf-queue of parent: root #applications: 1
2020-04-07 15:58:18,210 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container container_e02_1580812675067_8123_01_000001 of capacity <memory:2048, vCores:1> on host iccluster041.iccluster.epfl.ch:45454
2020-04-07 15:58:18,644 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8123_000001 State change from ALLOCATED to LAUNCHED on event = LAUNCHED
2020-04-07 15:58:25,000 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container container_e02_1580812675067_8123_01_000003 of capacity <memory:2048, vCores:1> on host iccluster041.iccluster.epfl.ch:45454
2020-04-07 15:58:25,001 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container container_e02_1580812675067_8123_01_000002 of capacity <memory:2048, vCores:1> on host iccluster042.iccluster.epfl.ch:45454
2020-04-07 15:58:26,001 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container container_e02_1580812675067_8123_01_000002 of capacity <memory:2048, vCores:1> on host iccluster042.iccluster.epfl.ch:45454
2020-04-07 15:59:32,600 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:rememberTarget(1291)) - Updating application attempt appattempt_1580812675067_8123_000001 with final state: FAILED, and exit status: 15
2020-04-07 15:59:32,625 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8123_000001 State change from FINAL_SAVING to FAILED on event = ATTEMPT_UPDATE_SAVED
2020-04-07 16:00:00,000 INFO  capacity.ParentQueue (ParentQueue.java:addApplication(468)) - Application added - appId: application_1580812675067_8130 user: alice leaf-queue of parent: root #applications: 1
2020-04-07 16:00:01,000 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8130_000001 State change from ALLOCATED to LAUNCHED on event = LAUNCHED
2020-04-07 16:00:05,500 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8130_000001 State change from RUNNING to FINISHING on event = UNREGISTERED
2020-04-07 16:00:06,000 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8130_000001 State change from FINISHING to FINISHED on event = CONTAINER_FINISHED
2020-04-07 16:00:06,500 INFO one-space appattempt_1580812675067_8130_000001 State change from RUNNING to FAILED
2020-04-07 16:00:07,000 DEBUG  x appattempt_1580812675067_8130_000001 State change from RUNNING to FAILED
2020-04-07 16:00:08,000 INFO  rmapp.RMAppImpl - no identifier on this line, State change from RUNNING to FAILED
\tat java.lang.Thread.run(Thread.java:748)
"""


@pytest.fixture
def rm_path(write_text):
    return write_text("rm.log", RM_LOG)


def test_line_filters(spark, rm_path):
    raw = read_lines(spark, rm_path)
    assert parse_rm_lines(raw, with_exit_code=True).count() == 11
    assert parse_rm_lines(raw, with_exit_code=False).count() == 10


def test_line_fields(spark, rm_path):
    lines = parse_rm_lines(read_lines(spark, rm_path), app_range=(0, 99999))
    got = {(r.app_id, r.ts): r for r in lines.collect()}
    r = got[("8123", "2020-04-07 15:59:32,600")]
    assert (r.attempt_nb, r.exit_code, r.final_status, r.container) == (1, 15, "", None)
    r = got[("8123", "2020-04-07 15:58:18,210")]
    assert (r.container.id, r.container.host) == (1, "iccluster041.iccluster.epfl.ch")
    r = got[("8123", "2020-04-07 15:58:17,101")]
    assert (r.user, r.attempt_nb) == ("mira", 0)


def test_app_range_filter(spark, rm_path):
    lines = parse_rm_lines(read_lines(spark, rm_path), app_range=(8124, 8130))
    assert {r.app_id for r in lines.collect()} == {"8130"}


def test_attempt_fold(spark, rm_path):
    lines = parse_rm_lines(read_lines(spark, rm_path), app_range=(0, 99999))
    atts = {(r.app_id, r.attempt_nb): r for r in A.attempts_of(A.line_groups(lines)).collect()}
    a = atts[("8123", 1)]
    assert (a.start_time, a.end_time, a.final_status, a.exit_code) == (
        "2020-04-07 15:58:18,644", "2020-04-07 15:59:32,625", "FAILED", 15)
    assert [(c.id, c.host) for c in a.containers] == [
        (1, "iccluster041.iccluster.epfl.ch"), (2, "iccluster042.iccluster.epfl.ch"),
        (3, "iccluster041.iccluster.epfl.ch")]
    b = atts[("8130", 1)]
    assert (b.start_time, b.end_time, b.final_status, b.exit_code, b.containers) == (
        "2020-04-07 16:00:01,000", "2020-04-07 16:00:05,500", "FINISHING", 0, [])


def test_fold_matches_sequential_fold_on_shuffled_lines(spark, rm_path):
    """The last-wins aggregates equal a literal left fold in line order."""
    import random
    lines = parse_rm_lines(read_lines(spark, rm_path), app_range=(0, 99999)).where("attempt_nb > 0")
    rows = sorted(lines.collect(), key=lambda r: r.pos)
    expected = {}
    for r in rows:
        st = expected.setdefault((r.app_id, r.attempt_nb), ["", "", "", 0, set()])
        if r.exit_code == 0 and r.is_launch:
            st[0] = r.ts
        elif r.exit_code == 0 and r.container is None:
            st[1], st[2] = r.ts, r.final_status
        elif r.container is None:
            st[3] = r.exit_code
        else:
            st[4].add((r.container.id, r.container.host))
    shuffled = spark.createDataFrame(random.Random(7).sample(rows, len(rows)), lines.schema).repartition(3)
    got = {(r.app_id, r.attempt_nb): [r.start_time, r.end_time, r.final_status, r.exit_code,
                                      {(c.id, c.host) for c in r.containers}]
           for r in A.attempts_of(A.line_groups(shuffled)).collect()}
    assert got == expected


def test_failed_attempts_with_users(spark, rm_path):
    lines = parse_rm_lines(read_lines(spark, rm_path), app_range=(0, 99999))
    g = A.line_groups(lines)
    failed = A.failed_attempts(A.attempts_of(g), A.users_of(g)).collect()
    assert [(r.app_id, r.attempt_nb, r.user) for r in failed] == [("8123", 1, "mira")]


@pytest.fixture
def run(spark, rm_path):
    g = A.line_groups(parse_rm_lines(read_lines(spark, rm_path), with_exit_code=False))
    return A.applications_of(g), A.attempts_of(g)


def test_applications(run):
    apps, _ = run
    assert sorted((r.app_id, r.user, r.num_attempts) for r in apps.collect()) == [
        ("8123", "mira", 1), ("8130", "alice", 1)]


def test_questions(run):
    apps, atts = run
    assert tuple(Q.q1_top_user_by_apps(apps).first()) == ("alice", 1)
    assert tuple(Q.q2_top_user_by_unsuccessful(apps, atts).first()) == ("mira", 1)
    assert [tuple(r) for r in Q.q3_apps_per_start_date(atts).collect()] == [("2020-04-07", 2)]
    assert Q.q4_mean_app_duration(atts).first()[0] == 39240
    assert Q.q5_mean_success_duration(atts).first()[0] == 4500
    assert Q.q6_hosts(Q._app_hosts(atts)).first()["n_hosts"] == 2
    assert tuple(Q.q7_top_host_by_apps(Q._app_hosts(atts)).first()) == ("iccluster041.iccluster.epfl.ch", 1)
    lines = {r.question: r.answer for r in Q.question_lines(apps, atts).collect()}
    assert lines[1] == "alice, 1" and lines[3] == "2020-04-07: 2" and lines[4] == "39240"
    assert lines[6] == "2, iccluster041.iccluster.epfl.ch, iccluster042.iccluster.epfl.ch"


def test_application_block(run):
    apps, atts = run
    text = {r.app_id: r.text for r in R.application_blocks(A.applications_with_attempts(apps, atts)).collect()}
    assert text["8130"] == (
        "ApplicationId : application_1580812675067_8130\n\nUser          : alice\n\nNumAttempts   : 1"
        "\n\nAttemptNumber : 1\n\nStartTime     : 2020-04-07 16:00:01,000\n\nEndTime       : "
        "2020-04-07 16:00:05,500\n\nFinalStatus   : FINISHING\n\nContainers    : \n\n")
