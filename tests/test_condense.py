"""Container logs read by lines: condensed records give the features of whole ones."""

import random

import pytest
from pyspark.sql import functions as F

from yarnscope.functions.patterns import DEFAULT_CLUSTER, RECORD_DELIMITER
from yarnscope.operators import condense
from yarnscope.operators.classify import diagnose, per_attempt, per_container
from yarnscope.operators.containers import keyed_records, record_features
from yarnscope.plans.classify_cases import CASES, DRIVER_FILLER, EXECUTOR_FILLER
from yarnscope.sources.text import read_records

T = "20/04/07 16:00:00"


@pytest.fixture
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def header(app, cid):
    return f"Container: container_e02_{DEFAULT_CLUSTER}_{app:04d}_01_{cid:06d} on iccluster041.iccluster.epfl.ch_45454_1\nLogType:stderr\n"


def features(records):
    keyed = keyed_records(records)
    key = ["app_num", "attempt_nb", "cid", "is_drv_header", "any_f", "drv_f", "exe_f", "host"]
    out = record_features(keyed).join(keyed.select(F.col("pos").alias("p"), "host"), F.col("pos") == F.col("p")).orderBy("pos").select(*key)
    return [tuple(r) for r in out.collect()]


BITS = ["ERROR Utils: Uncaught exception", "INFO Utils: shutdown", "ERROR ShortCircuitCache: failed", "WARN TransportChannelHandler: Exception in connection", "INFO A: quiet",
        "INFO TaskSetManager: Finished task 0.0 in stage 7.0 (TID 1)", "INFO B: in stage 3.0 at AppX here", "INFO C: looked at it = x", "ERROR Executor: Exception in task", "INFO D: x: y = z",
        "INFO DAGScheduler: ResultStage 1 (collect at App7.scala:25) failed in 3 s", "INFO DAGScheduler: Final stage: ResultStage 0 (collect at App4.scala:24)",
        "WARN BlockManager: Failed to fetch block java.io.IOException: reset", "WARN BlockManager: Failed to fetch block", "INFO YarnClusterScheduler: Cancelling stage 1",
        "ERROR ApplicationMaster: User class threw exception: org.apache.hadoop.mapred.InvalidInputException: none", "WARN X: than spark.driver.maxResultSize",
        "INFO ApplicationMaster: Final app status: FAILED, exitCode: 15, (reason: User class threw exception: a.B: c", "ERROR TaskSetManager: lost contact with driver",
        "ERROR OneForOneBlockFetcher: Failed while starting block fetches", "ERROR Executor: Exit as unable to send heartbeats to driver", "INFO E: caf\ré"]
LOOSE = ["java.io.IOException: reset", "java.lang.OutOfMemoryError", "\tat App1$.main(App1.scala:29)", "\tat java.util.Arrays.copyOf(Arrays.java:1)", "", "a = b", "plain words", "end:"]


def logs(seed, n):
    rng = random.Random(seed)
    records = []
    for app in range(n):
        for cid in rng.sample([1, 1, 2, 3], rng.randrange(1, 4)):
            lines = [f"{T} {rng.choice(BITS)}" if rng.random() < 0.7 else rng.choice(LOOSE) for _ in range(rng.randrange(0, 40))]
            lines += [f"{T} INFO A: quiet {i}" for i in range(rng.choice([0, 0, 1, 2, 60]))]
            if rng.random() < 0.5:
                rng.shuffle(lines)
            records.append(header(app + 1, cid) + "".join(x + "\n" for x in lines))
    return records


@pytest.mark.parametrize("seed", [1, 2])
def test_features_equal_those_of_whole_records(spark, write_text, small_blocks, seed):
    path = write_text("logs.txt", "".join(r + RECORD_DELIMITER for r in logs(seed, 60)))
    whole, lines = read_records(spark, path), condense.read_long_records(spark, path)
    want = features(whole)
    assert features(lines) == want and len(want) > 80
    assert sorted(r[0] for r in lines.select("n_chars").collect()) == sorted(len(r.value) for r in whole.collect())


def test_every_case_through_small_blocks(spark, write_text, small_blocks):
    quiet = "".join(f"{T} INFO TaskSetManager: Finished task {i}.0 (TID {i})\n" for i in range(300))
    out = []
    for i, (_, driver, executor, _) in enumerate(CASES):
        for cid, filler, body in ((1, DRIVER_FILLER, driver), (2, EXECUTOR_FILLER, executor)):
            if body:
                text = quiet + filler + body + "\n"
                text = text.replace("{T}", T).replace("{A}", f"{6000 + i:04d}").replace("{N2}", "01").replace("{C}", DEFAULT_CLUSTER)
                out.append(header(6000 + i, cid) + text)
    path = write_text("logs.txt", "".join(r + RECORD_DELIMITER for r in out))
    assert spark.read.text(path).rdd.getNumPartitions() > 100
    records = condense.read_long_records(spark, path)
    assert records.agg(F.max(F.length("value"))).first()[0] < 2000 < records.agg(F.min("n_chars")).first()[0]
    level = per_container(record_features(keyed_records(records)))
    got = {r.app_num: (r.error_category, r.exception, r.stage, r.source_line) for r in diagnose(per_attempt(level), level).collect()}
    assert got == {6000 + i: c[3] for i, c in enumerate(CASES)}


def test_records_over_several_files_and_without_end(spark, tmp_path, small_blocks):
    a, b = logs(5, 4), logs(6, 4)
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "1.txt").write_text("".join(r + RECORD_DELIMITER for r in a[:-1]) + a[-1])
    (tmp_path / "logs" / "2.txt").write_text(RECORD_DELIMITER.join(b))
    got = condense.read_long_records(spark, str(tmp_path / "logs")).orderBy("pos").collect()
    assert [r.n_chars for r in got] == [len(r) for r in a + b]
    assert [r.value.split("Container: ")[1][:60] for r in got] == [r.split("Container: ")[1][:60] for r in a + b]


def test_no_text_of_dropped_lines_is_shuffled(spark, write_text):
    path = write_text("logs.txt", header(1, 1) + f"{T} INFO A: a secret word\n" * 50)
    rows = condense.log_lines(condense.read_log_lines(spark, path)).where("text is null").collect()
    assert len(rows) == 50 and all(r.stamp == T for r in rows)
