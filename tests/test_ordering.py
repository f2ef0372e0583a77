"""Order-dependent results must not depend on how files are split.

A seeded random resource-manager log is read with tiny file splits, so the
lines of one attempt are spread over many partitions and map tasks; the
last-wins aggregates must equal a sequential fold in file order. Records
separated by the star delimiter must all come back whole across splits.
"""

import random

import pytest

from yarnscope.functions.patterns import DEFAULT_CLUSTER, RECORD_DELIMITER
from yarnscope.operators import attempts as A
from yarnscope.operators.lines import parse_rm_lines
from yarnscope.sources.text import read_lines, read_records

C = DEFAULT_CLUSTER


@pytest.fixture
def tiny_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def random_log(seed: int, n: int):
    rnd = random.Random(seed)
    lines, expected = [], {}
    for i in range(n):
        app, att = rnd.randint(1, 12), rnd.randint(1, 3)
        ts = f"2020-04-07 {10 + i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d},{rnd.randint(0, 999):03d}"
        st = expected.setdefault((f"{app:04d}", att), ["", "", "", 0, set()])
        kind = rnd.choice(["launch", "status", "exit", "container", "noise"])
        aid = f"appattempt_{C}_{app:04d}_{att:06d}"
        if kind == "launch":
            lines.append(f"{ts} INFO  a.B (B.java:h(1)) - {aid} State change from ALLOCATED to LAUNCHED on event = X")
            st[0] = ts
        elif kind == "status":
            to = rnd.choice(["FINISHING", "FAILED", "KILLED"])
            lines.append(f"{ts} INFO  a.B (B.java:h(1)) - {aid} State change from RUNNING to {to} on event = X")
            st[1], st[2] = ts, to
        elif kind == "exit":
            code = rnd.choice([-100, 1, 13, 15])
            lines.append(f"{ts} INFO  a.B (B.java:r(2)) - Updating application attempt {aid} "
                         f"with final state: FAILED, and exit status: {code}")
            st[3] = code
        elif kind == "container":
            cid, host = rnd.randint(1, 6), f"iccluster{rnd.randint(40, 45):03d}.iccluster.epfl.ch"
            lines.append(f"{ts} INFO  s.N (N.java:a(3)) - Assigned container container_e02_{C}_{app:04d}_{att:02d}_"
                         f"{cid:06d} of capacity <memory:2048, vCores:1> on host {host}:45454")
            st[4].add((cid, host))
        else:
            lines.append(f"{ts} DEBUG  a.B - {aid} State change from RUNNING to FAILED")
    expected = {k: v for k, v in expected.items() if v != ["", "", "", 0, set()]}
    return "\n".join(lines) + "\n", expected


def test_fold_is_split_independent(spark, write_text, tiny_splits):
    text, expected = random_log(11, 3000)
    raw = read_lines(spark, write_text("rm.log", text))
    assert raw.rdd.getNumPartitions() > 20
    got = {(r.app_id, r.attempt_nb): [r.start_time, r.end_time, r.final_status, r.exit_code,
                                      {(c.id, c.host) for c in r.containers}]
           for r in A.attempts_of(A.line_groups(parse_rm_lines(raw))).collect()}
    assert got == expected


def test_records_survive_splits(spark, write_text, tiny_splits):
    rnd = random.Random(5)
    recs = [f"Container: r{i}\n" + "x" * rnd.randint(0, 5000) + "\nend" for i in range(200)]
    df = read_records(spark, write_text("logs.txt", "".join(r + RECORD_DELIMITER for r in recs)))
    assert df.rdd.getNumPartitions() > 20
    got = sorted(r.value for r in df.collect())
    assert got == sorted(recs)
    seqs = [r.value.split("\n")[0] for r in df.orderBy("pos").collect()]
    assert seqs == [f"Container: r{i}" for i in range(200)]


def test_hot_attempt_holding_a_third_of_the_lines(spark, write_text, tiny_splits):
    """One attempt carries a third of all lines; the partial aggregates keep it exact."""
    rnd = random.Random(3)
    lines, last_launch, hosts = [], None, set()
    for i in range(3000):
        hot = i % 3 == 0
        app, att = (7, 1) if hot else (rnd.randint(8, 40), rnd.randint(1, 3))
        ts = f"2020-04-07 {10 + i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d},{i % 1000:03d}"
        if hot and i % 2 == 0:
            lines.append(f"{ts} INFO  a.B (B.java:h(1)) - appattempt_{C}_{app:04d}_{att:06d} State change from "
                         "ALLOCATED to LAUNCHED on event = X")
            last_launch = ts
        else:
            host = f"iccluster{i % 7 + 40:03d}.iccluster.epfl.ch"
            lines.append(f"{ts} INFO  s.N (N.java:a(3)) - Assigned container container_e02_{C}_{app:04d}_{att:02d}_"
                         f"{i % 9 + 1:06d} of capacity <memory:2048, vCores:1> on host {host}:45454")
            if hot:
                hosts.add((i % 9 + 1, host))
    raw = read_lines(spark, write_text("rm.log", "\n".join(lines) + "\n"))
    atts = A.attempts_of(A.line_groups(parse_rm_lines(raw))).where("app_id = '0007'").collect()
    assert len(atts) == 1
    assert atts[0].start_time == last_launch
    assert {(c.id, c.host) for c in atts[0].containers} == hosts


def test_rotated_files_in_order_of_their_first_timestamp(spark, tmp_path, tiny_splits):
    text, expected = random_log(4, 600)
    lines = text.splitlines(keepends=True)
    whole = tmp_path / "one"
    rotated = tmp_path / "rotated"
    for d in (whole, rotated):
        d.mkdir()
    (whole / "rm.log").write_text(text)
    # .log is the newest, .log.11 the oldest; the second line of a file may be the first with a timestamp
    for i in range(12):
        part = "".join(lines[50 * i:50 * i + 50])
        (rotated / ("rm.log" if i == 11 else f"rm.log.{11 - i}")).write_text(("continued\n" if i % 2 else "") + part)

    def attempts(path, **how):
        out = A.attempts_of(A.line_groups(parse_rm_lines(read_lines(spark, str(path), **how), with_exit_code=True)))
        return sorted(tuple(map(str, r)) for r in out.collect())

    assert attempts(rotated, by_time=True) == attempts(whole)
    assert attempts(rotated) != attempts(whole)


@pytest.mark.parametrize("files", [1, 3])
def test_least_number_of_scan_partitions(spark, tmp_path, files):
    for i in range(files):
        (tmp_path / f"{i}.log").write_text("a line of a log\n" * 3000)
    before = dict(spark.conf.getAll)
    fine = read_lines(spark, str(tmp_path), min_partitions=40)
    assert fine.rdd.getNumPartitions() >= 40 > read_lines(spark, str(tmp_path)).rdd.getNumPartitions()
    # the wish belongs to the scan, also inside a plan of the caller's session
    joined = spark.range(1).crossJoin(fine.select("value"))
    assert joined.rdd.getNumPartitions() >= 40 and joined.count() == 3000 * files
    assert dict(spark.conf.getAll) == before
