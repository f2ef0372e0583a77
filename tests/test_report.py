"""Failure report: exact block layout, write / read / parse round trip, and
validation of damaged blocks."""

import pytest

from yarnscope.operators import report as R
from yarnscope.plans.report_plans import DAMAGE

SCHEMA = ("app_id string, attempt_nb int, user string, start_time string, end_time string, "
          "containers array<struct<id:int,host:string>>, error_category int, exception string, "
          "stage int, source_line int")

GOLDEN = [
    ("8123", 1, "mira", "2020-04-07 15:58:18,644", "2020-04-07 15:59:32,625",
     [(1, "iccluster041.iccluster.epfl.ch"), (2, "iccluster042.iccluster.epfl.ch"),
      (3, "iccluster041.iccluster.epfl.ch")], 4, "org.apache.spark.SparkException", 0, 24),
    ("8122", 1, "mira", "2020-04-07 15:53:57,629", "2020-04-07 15:57:11,676",
     [(1, "iccluster044.iccluster.epfl.ch"), (2, "iccluster041.iccluster.epfl.ch"),
      (3, "iccluster043.iccluster.epfl.ch")], 3, "java.lang.OutOfMemoryError", -1, 22),
    ("8130", 2, "alice", "2020-04-07 16:00:01,000", "2020-04-07 16:00:05,500", [], 9, "N/A", -1, -1),
]

BLOCK_8123 = (
    "\n\nAppAttempt  : appattempt_1580812675067_8123_000001\n\nUser          : mira"
    "\n\nStartTime     : 2020-04-07 15:58:18,644\n\nEndTime       : 2020-04-07 15:59:32,625"
    "\n\nContainers    : container_e02_1580812675067_8123_01_000001 -> iccluster041.iccluster.epfl.ch, "
    "container_e02_1580812675067_8123_01_000002 -> iccluster042.iccluster.epfl.ch, "
    "container_e02_1580812675067_8123_01_000003 -> iccluster041.iccluster.epfl.ch"
    "\n\nErrorCategory : 4\n\nException     : org.apache.spark.SparkException\n\nStage         : 0"
    "\n\nSourceCodeLine: 24 ")


@pytest.fixture
def diag(spark):
    return spark.createDataFrame(GOLDEN, SCHEMA)


def test_block_layout(diag):
    text = {(r.app_id, r.attempt_nb): r.text for r in R.failure_blocks(diag).collect()}
    assert text[("8123", 1)] == BLOCK_8123


def test_round_trip(spark, diag, tmp_path):
    path = str(tmp_path / "report")
    R.write_report(R.failure_blocks(diag), path, ["app_id", "attempt_nb"])
    parsed = R.parse_report(R.read_report(spark, path)).collect()
    assert all(r.valid for r in parsed) and len(parsed) == 3
    got = {r.attempt_id: r for r in parsed}
    r = got["appattempt_1580812675067_8123_000001"]
    assert (r.user, r.start_time, r.end_time, r.error_category, r.exception, r.stage, r.source_line) == (
        "mira", "2020-04-07 15:58:18,644", "2020-04-07 15:59:32,625", 4, "org.apache.spark.SparkException", 0, 24)
    assert [(c.container, c.host) for c in r.containers] == [
        ("container_e02_1580812675067_8123_01_000001", "iccluster041.iccluster.epfl.ch"),
        ("container_e02_1580812675067_8123_01_000002", "iccluster042.iccluster.epfl.ch"),
        ("container_e02_1580812675067_8123_01_000003", "iccluster041.iccluster.epfl.ch")]
    r = got["appattempt_1580812675067_8130_000002"]
    assert (r.exception, r.containers) == ("N/A", [])
    summary = R.validate_report(R.parse_report(R.read_report(spark, path))).first()
    assert (summary.n_blocks, summary.n_invalid, summary.accepted) == (3, 0, True)


def test_single_file_report_is_accepted(spark, write_text):
    path = write_text("report.txt", BLOCK_8123 + BLOCK_8123.replace("8123", "8124"))
    parsed = R.parse_report(R.read_report(spark, path)).collect()
    assert [r.valid for r in parsed] == [True, True]


@pytest.mark.parametrize("damage", DAMAGE)
def test_damaged_block_is_quarantined(spark, write_text, damage):
    a, b = damage
    path = write_text("bad.txt", BLOCK_8123 + BLOCK_8123.replace("8123", "8124").replace(a, b))
    parsed = R.parse_report(R.read_report(spark, path))
    flags = sorted((r.attempt_ref, r.valid) for r in parsed.collect())
    assert flags == [("appattempt_1580812675067_8123_000001", True), ("appattempt_1580812675067_8124_000001", False)]
    s = R.validate_report(parsed).first()
    assert (s.n_blocks, s.n_invalid, s.accepted) == (2, 1, False)


def test_text_before_first_block_is_rejected(spark, write_text):
    path = write_text("lead.txt", "garbage" + BLOCK_8123)
    flags = [r.valid for r in R.parse_report(R.read_report(spark, path)).collect()]
    assert sorted(flags) == [False, True]


@pytest.mark.parametrize(("a", "b", "field", "at"), [
    ("appattempt_", "attempt_", "AppAttempt", ":"), ("User ", "Usr ", "User", "Usr"), ("mira", "M", "User", "User"), ("StartTime  ", "Start ", "StartTime", "Start "),
    ("EndTime       :", "EndTime       ;", "EndTime", "EndTime"), ("Containers ", "Container ", "Containers", "Container "),
    (" -> iccluster042", " => iccluster042", "Containers", "container_e02_1580812675067_8123_01_000002"),
    ("ErrorCategory : 4", "ErrorCategory : x", "ErrorCategory", "ErrorCategory"), ("Exception     : org", "Exception     : 9", "Exception", "Exception"),
    ("Stage         : 0", "Stage         : z", "Stage", "Stage"), ("SourceCodeLine: 24", "SourceCodeLine: l", "SourceCodeLine", "SourceCodeLine"),
    ("SourceCodeLine: 24 ", "SourceCodeLine: 24 more", "end", "more")])
def test_place_inside_a_damaged_block(spark, write_text, a, b, field, at):
    text = BLOCK_8123.replace(a, b, 1)
    assert text != BLOCK_8123
    parsed = R.parse_report(R.read_report(spark, write_text("bad.txt", BLOCK_8123 + text)))
    rows = parsed.orderBy("pos").collect()
    assert rows[0].valid and rows[0].misfit is None and not rows[1].valid
    inside = text.split("AppAttempt", 1)[1]
    where = inside.index(at, inside.index("_000001") + 8 if field == "Containers" and at.startswith("container_") else 0)
    assert (rows[1].misfit.field, rows[1].misfit["at"]) == (field, where)
    s = R.validate_report(parsed).first()
    assert (s.first_invalid_block, s.first_invalid_field, s.first_invalid_offset) == (2, field, where)
