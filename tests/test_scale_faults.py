"""Long ids, long logs and long reports."""

import random
import time

import pytest
from pyspark.sql import functions as F

from yarnscope.functions import text as X
from yarnscope.functions.patterns import CLS, LogFormat
from yarnscope.operators import joins
from yarnscope.operators import report as R
from yarnscope.operators import workloads as W


def test_extraction_equals_the_patterns(spark):
    rng = random.Random(6)
    bits = ["WARN BlockManager: Failed to fetch ", "ERROR OneForOneBlockFetcher: Failed while starting block fetches ", "java.io.IOException: ", "OutOfMemoryError: ", "Exception", "Error",
            ": ", ":", " ", "a", "x:y", "\r", "Exception:", "é😀 "]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randrange(0, 9))),) for _ in range(6000)]
    df = spark.createDataFrame(rows, "flat string")
    flat = F.col("flat")
    old = lambda k: X.prefix_to_colon(X.extract_or(flat, "^(?:" + CLS[k] + ")$", 1))
    got = df.select("flat", old("block_manager_exc").alias("a"), X.prefix_to_colon(X.last_exception_word(flat, CLS["block_manager"] + " ")).alias("b"),
                    old("block_fetcher_exc").alias("c"), X.exception_after(flat, CLS["block_fetcher"] + " ").alias("d")).collect()
    bad = [r for r in got if r.a != r.b or r.c != r.d]
    assert not bad, bad[:5]
    assert sum(r.a != "" for r in got) > 50 and sum(r.c != "" for r in got) > 50


def test_five_megabyte_log_is_quick(spark):
    line = "20/04/07 15:58:18 INFO Executor: Finished task 0.0 in stage 1.0 (TID 1). 1024 bytes result sent to driver "
    log = "20/04/07 15:58:18 WARN BlockManager: Failed to fetch block after 1 fetch failures java.io.IOException: Failed " + line * 50_000
    df = spark.createDataFrame([(log,)], "flat string")
    t = time.time()
    assert df.select(X.last_exception_word(F.col("flat"), CLS["block_manager"] + " ")).first()[0] == "java.io.IOException"
    assert time.time() - t < 20


@pytest.mark.parametrize("key", ["driver_failure", "missing_input"])
def test_search_before_the_last_boundary_equals_the_pattern(spark, key):
    rng = random.Random(7)
    ts = "20/04/07 15:58:18"
    bits = {"driver_failure": [ts + " INFO ApplicationMaster: Final app status: FAILED, exitCode: 15, (reason: User class threw exception: ", ", exitCode: 1, (reason: User class threw exception: ", "java.io.IOException: "],
            "missing_input": [ts + " ERROR ApplicationMaster: User class threw exception: org.apache.hadoop.mapred.InvalidInputException:"]}[key]
    bits = bits + [": ", ":", "\n", "\n", "=", ts, " x", "\n\tat A.main(App3.scala:22)", "\r", "\u2028", ")", "😀"]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))),) for _ in range(8000)]
    df = spark.createDataFrame(rows, "v string")
    groups = 3 if key == "driver_failure" else 2
    before, short = X.before_last(F.col("v"), CLS["boundary"]), X.until_boundary(CLS[key], CLS["boundary"])
    got = df.select("v", F.col("v").rlike(CLS[key]).alias("a"), before.rlike(short).alias("b"),
                    *[F.regexp_extract("v", CLS[key], g).alias(f"a{g}") for g in range(1, groups + 1)],
                    *[F.regexp_extract(before, short, g).alias(f"b{g}") for g in range(1, groups + 1)]).collect()
    bad = [r for r in got if r.a != r.b or any(r[f"a{g}"] != r[f"b{g}"] for g in range(1, groups + 1))]
    assert not bad, bad[:3]
    assert sum(r.a for r in got) > 300


def test_five_megabyte_driver_log_is_quick(spark):
    """Many colons, a long trace, and no boundary behind it: the whole pattern needs minutes for a megabyte."""
    from yarnscope.operators.containers import record_features
    ts = "20/04/07 15:58:18"
    head = ts + " INFO ApplicationMaster: Final app status: FAILED, exitCode: 15, (reason: User class threw exception: " + "a.B: " * 40
    head += "\n" + ts + " ERROR ApplicationMaster: User class threw exception: org.apache.spark.SparkException: " + "x: " * 40
    log = head + "\n\tat org.example.Frame.run(Frame.java:1)" * 130_000
    assert len(log) > 5_000_000
    df = spark.createDataFrame([(1, 1, 1, log)], "app_num int, attempt_nb int, cid int, value string") \
        .withColumn("is_drv_header", F.lit(True)).withColumn("pos", F.lit(1))
    t = time.time()
    r = record_features(df).collect()[0]
    assert time.time() - t < 30
    assert not r.any_f.f2_hit and r.drv_f.f3_hit and r.drv_f.f3_exc == "a.B"


def test_users_beyond_ten_thousand(spark, tmp_path):
    from yarnscope.plans import registry, render
    rows = [(i, 9998 + i % 15, kind, float(i % 40), "2020-04-07 10:00:%02d" % (i % 60)) for i, kind in
            enumerate(["signup", "view", "click", "purchase", "error"] * 60)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, ts string").withColumn("ts", F.to_timestamp("ts"))
    sf = str(tmp_path / "sf")
    df.write.parquet(f"{sf}/events.parquet")
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    for name in ("applications", "classify", "container_records"):
        got = registry.queries()[name](spark, sf)
        rel = con.sql(registry.oracle_sql()[name])
        order = [got.columns.index(c) for c in rel.columns]
        key = lambda r: tuple(map(str, r))
        mine = sorted((tuple(r[i] for i in order) for r in got.collect()), key=key)
        assert list(map(key, mine)) == sorted(map(key, rel.fetchall())), name
        if name == "applications":
            assert len(mine) == 15
    assert render.rm_log_path(spark, sf)


def test_report_block_with_many_containers(spark, tmp_path):
    host = "iccluster040.iccluster.epfl.ch"
    block = lambda n, a: (f"\n\nAppAttempt  : appattempt_1580812675067_8106_{a:06d}\n\nUser          : u\n\nStartTime     : 2020-04-07 15:58:18,644"  # noqa: E731
                          "\n\nEndTime       : 2020-04-07 15:59:32,625\n\nContainers    : "
                          + ", ".join(f"container_e02_1580812675067_8106_01_{i:06d} -> {host}" for i in range(n))
                          + "\n\nErrorCategory : 4\n\nException     : java.io.IOException\n\nStage         : 0\n\nSourceCodeLine: 24 ")
    path = tmp_path / "report.txt"
    path.write_text(block(50_000, 1) + block(0, 2) + block(2, 3).replace(" -> ", " => ") + block(1, 4))
    parsed = R.parse_report(R.read_report(spark, str(path)))
    assert [(r.attempt_ref[-1], r.valid, r.n) for r in parsed.select("attempt_ref", "valid", F.size("containers").alias("n"), "pos").orderBy("pos").collect()] == [
        ("1", True, 50_000), ("2", True, 0), ("3", False, None if parsed is None else parsed.where("not valid").select(F.size("containers")).first()[0]), ("4", True, 1)]
    s = R.validate_report(parsed).first()
    assert (s.n_blocks, s.n_invalid, s.accepted, s.first_invalid_block, s.first_invalid_ref[-1]) == (4, 1, False, 3, "3")
    assert s.first_invalid_path.endswith("report.txt")


def test_report_host_comes_from_the_format(spark, tmp_path):
    fmt = LogFormat(host=r"node\d+")
    path = tmp_path / "report.txt"
    path.write_text("\nAppAttempt  : appattempt_1580812675067_1_000001\nUser : u\nStartTime : 2020-04-07 15:58:18,644\nEndTime : 2020-04-07 15:59:32,625\n"
                    "Containers : container_e02_1580812675067_1_01_000001 -> node7\nErrorCategory : 4\nException : N/A\nStage : 0\nSourceCodeLine : 1\n")
    assert R.validate_report(R.parse_report(R.read_report(spark, str(path), fmt), fmt)).first().accepted


@pytest.mark.parametrize("n", [0, 1, 500])
def test_prefilter_keeps_all_members(spark, n):
    rows = spark.range(4000).select((F.col("id") % 40).alias("a"), (F.col("id") % 100).alias("b"), F.col("id").alias("v"))
    keys = spark.range(n).select((F.col("id") % 40).alias("a"), (F.col("id") % 100).alias("b"))
    got = joins.prefilter(rows, keys, ["a", "b"])
    want = rows.join(keys.distinct(), ["a", "b"], "left_semi")
    assert want.exceptAll(got.join(keys.distinct(), ["a", "b"], "left_semi")).count() == 0
    assert got.count() <= want.count() + 40


def test_prefilter_passes_few_others(spark):
    """One hash on a bitmap of 2^26 bits let 63 % of the others pass at 67 million keys."""
    assert joins.passes(10**4) < 0.02 and joins.passes(67_000_000) < 0.02 and joins.passes(10**8) < 0.02
    keys = spark.range(0, 200_000, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    others = spark.range(1, 200_001, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert joins.prefilter(keys, keys, ["a", "b"]).count() == 100_000
    assert joins.prefilter(others, keys, ["a", "b"]).count() < 2_000


def test_hot_key_fills_several_ranges(spark):
    fact = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    dim = spark.createDataFrame([(1, 2000), (1, 10)], "k int, v long")
    j = W.theta_join_sum(fact, dim, "k", "v", "k", "v", dedup=False, ranges=9)
    assert j.first().total == 2000 * 2000 + 10 * 10
    plan = j._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "_v1" in plan


def test_theta_join_of_a_million_values_a_side(spark):
    """One key; pairs would be 5 * 10^11."""
    n = 1_000_000
    fact = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    dim = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    t = time.time()
    right = W.theta_join_sum(fact, dim, "k", "v", "k", "v", sum_of="right", dedup=False).first().total
    left = W.theta_join_sum(fact, dim, "k", "v", "k", "v", sum_of="left", dedup=False).first().total
    assert right == sum(v * v for v in range(n)) and left == sum(v * (n - 1 - v) for v in range(n))
    assert time.time() - t < 120


def test_theta_join_nulls_and_no_match(spark):
    fact = spark.createDataFrame([(None, 1), (1, None), (2, 5), (3, -4)], "k int, v long")
    dim = spark.createDataFrame([(None, 9), (1, 9), (2, 5), (3, 0), (3, None)], "k int, v long")
    for side, want in (("right", 0), ("left", -4)):
        assert [tuple(r) for r in W.theta_join_sum(fact, dim, "k", "v", "k", "v", sum_of=side, dedup=False).collect()] == [(3, want)]


def test_container_ids_of_another_epoch(spark, write_text):
    from yarnscope.operators.lines import parse_rm_lines
    from yarnscope.sources.text import read_lines
    line = ("2020-04-07 10:00:00,000 INFO  scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container "
            "container_{}_1580812675067_0007_01_000003 of capacity <memory:2048, vCores:1> on host iccluster040.iccluster.epfl.ch:45454\n")
    got = parse_rm_lines(read_lines(spark, write_text("rm.log", line.format("e02") + line.format("e117"))), with_exit_code=False)
    assert [(r.app_id, r.attempt_nb, r.container.id) for r in got.collect()] == [("0007", 1, 3)] * 2
