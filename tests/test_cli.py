"""Command line entry points."""

import glob
import os
import subprocess
import sys

from yarnscope.functions.patterns import RECORD_DELIMITER
from yarnscope.plans.classify_cases import CASES, DRIVER_FILLER

from test_classify import RM, record

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, BENCH_CPUS="2", YARNSCOPE_DRIVER_MEMORY="2g")
    return subprocess.run([sys.executable, "-m", "yarnscope", *args], cwd=ROOT, env=env,
                          capture_output=True, text=True, timeout=600)


def read_parts(folder):
    return "".join(open(p).read() for p in sorted(glob.glob(os.path.join(folder, "part-*"))))


def test_failure_report_and_validation(write_text, tmp_path):
    logs = "".join(r + RECORD_DELIMITER for r in [record(8106, 1, DRIVER_FILLER + CASES[6][1])])
    out = str(tmp_path / "report")
    r = run("failure-report", write_text("rm.log", RM), write_text("logs.txt", logs), "8100", "8110", out)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "ErrorCategory : 4" in read_parts(out)
    r = run("validate-report", out)
    assert r.returncode == 0 and r.stdout.strip().endswith("SUCCESS"), r.stdout + r.stderr[-2000:]


def test_run_report(write_text, tmp_path):
    out = str(tmp_path / "run")
    r = run("run-report", write_text("rm.log", RM), out, "--first", "8100", "--last", "8110")
    assert r.returncode == 0, r.stderr[-2000:]
    apps = read_parts(os.path.join(out, "applications"))
    assert apps.startswith("ApplicationId : application_1580812675067_8106\n\nUser          : mira")
    assert apps.endswith("\n\n")
    assert read_parts(os.path.join(out, "questions")).startswith("1. ")


def test_workload_command(write_text, tmp_path):
    out = str(tmp_path / "w")
    r = run("workload", "scaled_sum", write_text("d3.csv", "a,1,25\na,2,-7\nb,1,9\nb,2,100\n"), out)
    assert r.returncode == 0, r.stderr[-2000:]
    rows = sorted(l for l in read_parts(out).splitlines() if l and not l.startswith("c1"))
    assert rows == ["1,2", "2,10"]
