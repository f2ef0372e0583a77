"""End-to-end jobs on files."""

from yarnscope import jobs
from yarnscope.functions.patterns import RECORD_DELIMITER
from yarnscope.plans.classify_cases import CASES, DRIVER_FILLER

from test_classify import RM, record
from test_rm_log import RM_LOG


def test_run_reconstruction(spark, write_text):
    out = jobs.run_reconstruction(spark, write_text("rm.log", RM_LOG), report_range=(8130, 8130))
    assert [r.app_id for r in out["report"].collect()] == ["8130"]
    assert out["questions"].count() == 7


def test_failure_report_written_and_validated(spark, write_text, tmp_path):
    logs = "".join(r + RECORD_DELIMITER for r in [record(8106, 1, DRIVER_FILLER + CASES[6][1])])
    out = str(tmp_path / "report")
    diag = jobs.failure_report(spark, write_text("rm.log", RM), write_text("logs.txt", logs), 8100, 8110, out=out)
    assert [(r.app_id, r.error_category) for r in diag.collect()] == [("8106", 4)]
    v = jobs.validate_report(spark, out)
    s = v["summary"].first()
    assert (s.n_blocks, s.n_invalid, s.accepted) == (1, 0, True)


def test_failure_report_range_excludes(spark, write_text):
    logs = "".join(r + RECORD_DELIMITER for r in [record(8106, 1, DRIVER_FILLER + CASES[6][1])])
    diag = jobs.failure_report(spark, write_text("rm.log", RM), write_text("logs.txt", logs), 8107, 8110)
    assert diag.count() == 0


def test_workload_job(spark, write_text):
    d3 = write_text("d3.csv", "a,1,25\na,2,-7\nb,1,9\nb,2,100\n")
    d4 = write_text("d4.csv", "a,10\nb,50\nb,60\nc,1\n")
    got = sorted(tuple(r) for r in jobs.workload(spark, "theta_join_sum", d3, d4).collect())
    assert got == [("a", 10), ("b", 60)]
    assert sorted(tuple(r) for r in jobs.workload(spark, "scaled_sum", d3).collect()) == [(1, 2), (2, 10)]


def test_every_workload_job(spark, write_text):
    d3 = write_text("d3.csv", "a,1,25\na,2,-7\nb,1,9\nb,2,100\n")
    d1 = write_text("d1.csv", "1,10\n1,5\n2,7\n")
    d2 = write_text("d2.csv", "1,10\n2,4\n3,6\n3,1\n")
    assert sorted(tuple(r) for r in jobs.workload(spark, "composite_sum", d3).collect()) == [
        ("a", 1, 25), ("a", 2, -7), ("b", 1, 9), ("b", 2, 100)]
    assert jobs.workload(spark, "modsum_total", d1).first()[0] == 2629
    assert sorted(tuple(r) for r in jobs.workload(spark, "modsum_by_key", d1).collect()) == [(1, 642), (2, 309)]
    assert tuple(jobs.workload(spark, "around_half_max", d2).first()) == (5, 4, 7)
