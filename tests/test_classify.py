"""Failure classifier: every case of FIXTURES.md section 4, duplicate records,
a lost executor without a log, executor order, and an end-to-end run from
files (resource-manager log + star-delimited container logs)."""

import pytest
from pyspark.sql import functions as F

from yarnscope.functions.patterns import DEFAULT_CLUSTER, RECORD_DELIMITER
from yarnscope.operators.classify import classify_attempts, diagnose, per_attempt, per_container
from yarnscope.operators.containers import keyed_records, record_features
from yarnscope.plans.classify_cases import CASES, DRIVER_FILLER, EXECUTOR_FILLER
from yarnscope.sources.text import read_records, synthetic_position

T = "20/04/07 16:00:00"


def header(app: int, attempt: int, cid: int, host: str = "iccluster041.iccluster.epfl.ch") -> str:
    return (f"Container: container_e02_{DEFAULT_CLUSTER}_{app:04d}_{attempt:02d}_{cid:06d} on {host}_45454_1\n"
            "LogType:stderr\nLogContents:\n")


def fill(body: str, app: int, attempt: int = 1) -> str:
    return (body.replace("{T}", T).replace("{A}", f"{app:04d}").replace("{N2}", f"{attempt:02d}")
            .replace("{C}", DEFAULT_CLUSTER))


def record(app, cid, body, attempt=1):
    return header(app, attempt, cid) + fill(body, app, attempt) + "\n"


def diagnose_records(spark, recs):
    """recs: list of record texts in log order -> {app: (category, exception, stage, line)}."""
    df = spark.createDataFrame([(t, i) for i, t in enumerate(recs)], "value string, i long")
    df = df.select("value", synthetic_position("t", F.col("i")).alias("pos"))
    l1 = per_container(record_features(keyed_records(df)))
    out = diagnose(per_attempt(l1), l1).collect()
    return {r.app_num: (r.error_category, r.exception, r.stage, r.source_line) for r in out}


def test_every_case(spark):
    recs = []
    for i, (_, drv, exe, _) in enumerate(CASES):
        app = 5000 + i
        recs.append(record(app, 1, DRIVER_FILLER + drv))
        if exe:
            recs.append(record(app, 2, EXECUTOR_FILLER + exe))
    got = diagnose_records(spark, recs)
    for i, (name, _, _, expected) in enumerate(CASES):
        assert got[5000 + i] == expected, name


def test_class_not_found_sample_shape(spark):
    body = ("SLF4J: Class path contains multiple SLF4J bindings.\n"
            "20/05/15 18:44:04 INFO ApplicationMaster: Starting the user application in a separate Thread\n"
            "20/05/15 18:44:04 ERROR ApplicationMaster: Uncaught exception: \n"
            "java.lang.ClassNotFoundException: App77\n\tat java.net.URLClassLoader.findClass(URLClassLoader.java:381)\n")
    assert diagnose_records(spark, [record(9471, 1, body)])[9471] == (1, "java.lang.ClassNotFoundException", -1, -1)


def test_first_driver_record_decides_rule_1(spark):
    cnf = CASES[0][1]
    recs = [record(7000, 1, "{T} INFO X: nothing here"), record(7000, 1, cnf)]
    # the first driver record has no class-not-found line; the last one decides the later rules
    got = diagnose_records(spark, recs)[7000]
    assert got[0] == 7


def test_last_driver_record_decides_rule_4(spark):
    fs = "{T} INFO DAGScheduler: Final stage: ResultStage 0 (collect at App14.scala:31)"
    recs = [record(7001, 1, fs), record(7001, 1, fs + "\n{T} WARN X: bigger than spark.driver.maxResultSize")]
    assert diagnose_records(spark, recs)[7001] == (4, "org.apache.spark.SparkException", 0, 31)
    recs.reverse()
    assert diagnose_records(spark, recs)[7001] == (9, "N/A", -1, -1)


def test_lost_executor_without_log_falls_through(spark):
    lost, cs = CASES[15][1], "{T} INFO YarnClusterScheduler: Cancelling stage 1"
    got = diagnose_records(spark, [record(7002, 1, lost + "\n" + cs)])[7002]
    assert got == (7, "org.apache.spark.SparkException", 1, -1)


def test_first_executor_by_container_id_wins(spark):
    fs = "{T} INFO DAGScheduler: Final stage: ResultStage 0 (collect at App14.scala:31)"
    fetch = "{T} ERROR OneForOneBlockFetcher: Failed while starting block fetches\njava.io.IOException: reset"
    heartbeat = "{T} ERROR Executor: Exit as unable to send heartbeats to driver more than 60 times"
    recs = [record(7003, 1, fs), record(7003, 3, fetch), record(7003, 2, heartbeat)]
    assert diagnose_records(spark, recs)[7003] == (4, "org.apache.spark.SparkException", 0, 31)
    recs = [record(7004, 1, fs), record(7004, 2, fetch), record(7004, 3, heartbeat)]
    assert diagnose_records(spark, recs)[7004] == (4, "java.io.IOException", 0, 31)


def test_no_driver_record_uses_executor_error(spark):
    recs = [record(7005, 2, "{T} ERROR CoarseGrainedExecutorBackend: RECEIVED SIGNAL TERM stage 3")]
    assert diagnose_records(spark, recs)[7005] == (8, "org.apache.spark.SparkException", 3, -1)


RM = """2020-04-07 15:58:17,101 INFO  capacity.ParentQueue (ParentQueue.java:addApplication(468)) - Application added - appId: application_1580812675067_8106 user: mira leaf-queue of parent: root #applications: 1
2020-04-07 15:58:18,644 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8106_000001 State change from ALLOCATED to LAUNCHED on event = LAUNCHED
2020-04-07 15:58:25,000 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container container_e02_1580812675067_8106_01_000001 of capacity <memory:2048, vCores:1> on host iccluster041.iccluster.epfl.ch:45454
2020-04-07 15:59:32,600 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:rememberTarget(1291)) - Updating application attempt appattempt_1580812675067_8106_000001 with final state: FAILED, and exit status: 15
2020-04-07 15:59:32,625 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8106_000001 State change from FINAL_SAVING to FAILED on event = ATTEMPT_UPDATE_SAVED
2020-04-07 16:00:00,000 INFO  capacity.ParentQueue (ParentQueue.java:addApplication(468)) - Application added - appId: application_1580812675067_8107 user: alice leaf-queue of parent: root #applications: 1
2020-04-07 16:00:01,000 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8107_000001 State change from ALLOCATED to LAUNCHED on event = LAUNCHED
2020-04-07 16:00:05,500 INFO  attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - appattempt_1580812675067_8107_000001 State change from RUNNING to FINISHING on event = UNREGISTERED
"""


def test_end_to_end_from_files(spark, write_text):
    from yarnscope.operators.lines import parse_rm_lines
    from yarnscope.sources.text import read_lines
    logs = "".join(r + RECORD_DELIMITER for r in [
        record(8106, 1, DRIVER_FILLER + CASES[6][1]),          # failed attempt, block-manager case
        record(8107, 1, DRIVER_FILLER + CASES[0][1]),          # attempt that succeeded: dropped
        "\n",                                                   # trailing blank record: dropped
    ])
    rm = parse_rm_lines(read_lines(spark, write_text("rm.log", RM)), app_range=(0, 9999))
    recs = read_records(spark, write_text("logs.txt", logs))
    out = classify_attempts(recs, rm, app_range=(0, 9999)).collect()
    assert [(r.app_id, r.attempt_nb, r.user, r.start_time, r.end_time, r.error_category, r.exception,
             r.stage, r.source_line) for r in out] == [
        ("8106", 1, "mira", "2020-04-07 15:58:18,644", "2020-04-07 15:59:32,625", 4, "java.io.IOException", 0, 31)]
    assert [(c.id, c.host) for c in out[0].containers] == [(1, "iccluster041.iccluster.epfl.ch")]


def test_generic_rule_all_frames_option(spark):
    body = "{T} ERROR X: boom\n\tat App13$.main(App3.scala:17)\n"
    df = spark.createDataFrame([(record(7100, 1, body), 0)], "value string, i long")
    df = df.select("value", synthetic_position("t", F.col("i")).alias("pos"))
    default = record_features(keyed_records(df)).first().any_f.generic.line
    every = record_features(keyed_records(df), all_frames=True).first().any_f.generic.line
    assert (default, every) == (-1, 17)


def test_every_case_with_shuffled_and_extra_records(spark):
    import random
    from yarnscope.plans.classify_cases import IDLE_EXECUTOR
    rnd = random.Random(17)
    recs = []
    for i, (_, drv, exe, _) in enumerate(CASES):
        app = 6000 + i
        group = [record(app, 1, DRIVER_FILLER + drv)]
        if exe:
            group.append(record(app, 2, EXECUTOR_FILLER + exe))
        for cid in rnd.sample(range(3, 10), rnd.randint(1, 3)):
            idle = record(app, cid, IDLE_EXECUTOR)
            group += [idle] * rnd.randint(1, 2)
        recs += group
    rnd.shuffle(recs)
    df = spark.createDataFrame([(t, i) for i, t in enumerate(recs)], "value string, i long").repartition(5)
    df = df.select("value", synthetic_position("t", F.col("i")).alias("pos"))
    l1 = per_container(record_features(keyed_records(df)))
    got = {r.app_num: (r.error_category, r.exception, r.stage, r.source_line)
           for r in diagnose(per_attempt(l1), l1).collect()}
    for i, (name, _, _, expected) in enumerate(CASES):
        assert got[6000 + i] == expected, name


FS_LINE = "{T} INFO DAGScheduler: Final stage: ResultStage 0 (collect at App14.scala:31)"
CS_LINE = "{T} INFO YarnClusterScheduler: Cancelling stage 1"


def test_block_manager_without_exception_falls_through_to_executors(spark):
    drv = FS_LINE + "\n{T} WARN BlockManager: Failed to fetch block broadcast_3 after retries"
    exe = "{T} ERROR Executor: Exit as unable to send heartbeats to driver more than 60 times"
    got = diagnose_records(spark, [record(7200, 1, drv), record(7200, 2, exe)])[7200]
    assert got == (4, "org.apache.spark.SparkException", 0, 31)


def test_nested_exception_with_lost_executor_failure_is_not_rule_4(spark):
    drv = (FS_LINE + "\n{T} ERROR ApplicationMaster: User class threw exception: org.apache.spark.SparkException: "
           "Job aborted due to stage failure: ExecutorLostFailure: java.io.IOException: x")
    assert diagnose_records(spark, [record(7201, 1, drv)])[7201] == (7, "java.io.IOException", -1, -1)


def test_rule_5_empty_exception_uses_utils_fallback(spark):
    lost = CASES[15][1].split("\n")[0]
    drv = ("{T} ERROR Utils: Uncaught exception in thread x\n"
           "{T} INFO Utils: shutdown hook\njava.lang.OutOfMemoryError: Java heap space\n" + lost + "\n" + CS_LINE)
    exe = "{T} ERROR Executor: Exception in task 0.0\n: no class\n\tat App11$.main(App1.scala:7)\n"
    got = diagnose_records(spark, [record(7202, 1, drv), record(7202, 2, exe)])[7202]
    assert got == (5, "java.lang.OutOfMemoryError", 1, 7)


def test_rule_5_exception_without_message_crosses_lines(spark):
    lost = CASES[15][1].split("\n")[0]
    exe = ("{T} ERROR Executor: Exception in task 0.0\njava.lang.OutOfMemoryError\n"
           "\tat App2$.f(App2.scala:9)\n\tat App2$.g(App2.scala:11)\n")
    got = diagnose_records(spark, [record(7203, 1, lost + "\n" + CS_LINE), record(7203, 2, exe)])[7203]
    assert got == (5, "java.lang.OutOfMemoryError\n\tat App2$.f(App2.scala", 1, 9)


def test_driver_failure_due_to_stage_failure_is_not_rule_3(spark):
    drv = (CS_LINE + "\n{T} INFO ApplicationMaster: Final app status: FAILED, exitCode: 15, (reason: User class "
           "threw exception: org.apache.spark.SparkException: Job aborted due to stage failure: Task 3 failed: "
           "java.lang.OutOfMemoryError: Java heap space\n\tat App13$.main(App13.scala:38)\n)\n"
           "{T} INFO ShutdownHookManager: bye")
    assert diagnose_records(spark, [record(7204, 1, drv)])[7204] == (9, "N/A", -1, -1)


def test_missing_input_in_an_executor_record(spark):
    exe = ("{T} ERROR ApplicationMaster: User class threw exception: org.apache.hadoop.mapred.InvalidInputException: "
           "Input path does not exist\n\tat App11$.main(App11.scala:52)\n{T} INFO X: y")
    got = diagnose_records(spark, [record(7205, 1, FS_LINE), record(7205, 2, exe)])[7205]
    assert got == (2, "org.apache.hadoop.mapred.InvalidInputException", -1, 52)


def test_result_getter_with_scheduler_error_is_not_rule_4(spark):
    drv = (FS_LINE + "\n{T} ERROR Utils: Uncaught exception in thread task-result-getter-0\n"
           "java.lang.OutOfMemoryError: Java heap space\n{T} ERROR TaskResultGetter: Exception while getting result\n"
           "{T} ERROR YarnClusterScheduler: something else")
    assert diagnose_records(spark, [record(7206, 1, drv)])[7206] == (7, "java.lang.OutOfMemoryError", -1, -1)


def test_rendered_repeats_tell_the_first_record_from_the_last(spark):
    """Every repeated driver record of the rendered logs gives another diagnosis if first and last are swapped."""
    from yarnscope.plans.classify_cases import DRIVER_DECOY, FIRST_DECIDES
    for swapped in (False, True):
        recs = []
        for i, (_, drv, exe, expected) in enumerate(CASES):
            group = [record(7300 + i, 1, DRIVER_FILLER + drv), record(7300 + i, 1, DRIVER_DECOY)]
            recs += group if (expected[0] in FIRST_DECIDES) != swapped else group[::-1]
            if exe:
                recs.append(record(7300 + i, 2, EXECUTOR_FILLER + exe))
        got = diagnose_records(spark, recs)
        for i, (name, _, _, expected) in enumerate(CASES):
            same = got[7300 + i] == expected
            assert same if not swapped else (not same or expected[0] == 2), name
