"""Command line: ``python -m yarnscope <command> ...``.

Commands::

    run-report      RM_LOG OUT [--first N --last N]
        application report for the id range and the seven question lines
    failure-report  RM_LOG CONTAINER_LOGS FIRST LAST OUT
        failure report of the failed attempts of applications FIRST..LAST
    validate-report REPORT
        prints SUCCESS when every block of the report parses, else the number
        of offending blocks and the position of the first one
    workload        NAME INPUT OUT [--dim DIM]
        one CSV workload (scaled_sum, composite_sum, modsum_total,
        modsum_by_key, theta_join_sum, around_half_max), written as CSV

Results are written by Spark's writers into OUT (part files); only the
one-row validation summary is brought to the driver.
"""

from __future__ import annotations

import argparse
import sys

from . import jobs
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="yarnscope")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("run-report")
    p.add_argument("rm_log")
    p.add_argument("out")
    p.add_argument("--first", type=int, default=121)
    p.add_argument("--last", type=int, default=130)
    p = sub.add_parser("failure-report")
    p.add_argument("rm_log")
    p.add_argument("container_logs")
    p.add_argument("first", type=int)
    p.add_argument("last", type=int)
    p.add_argument("out")
    p = sub.add_parser("validate-report")
    p.add_argument("report")
    p = sub.add_parser("workload")
    p.add_argument("name")
    p.add_argument("input")
    p.add_argument("out")
    p.add_argument("--dim")
    p.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(master=getattr(args, "master", None))
    if args.cmd == "run-report":
        res = jobs.run_reconstruction(spark, args.rm_log, report_range=(args.first, args.last))
        # each application block ends with a blank line; its last newline is
        # written as the line separator, so the part files concatenate exactly
        (res["report"].orderBy("app_id")
         .selectExpr("substring(text, 1, length(text) - 1) AS text")
         .write.mode("overwrite").option("lineSep", "\n").text(f"{args.out}/applications"))
        (res["questions"].orderBy("question")
         .selectExpr("concat(question, '. ', answer) AS line")
         .write.mode("overwrite").option("lineSep", "\n\n").text(f"{args.out}/questions"))
    elif args.cmd == "failure-report":
        jobs.failure_report(spark, args.rm_log, args.container_logs, args.first, args.last, out=args.out)
    elif args.cmd == "validate-report":
        s = jobs.validate_report(spark, args.report)["summary"].first()
        if s["accepted"]:
            print("SUCCESS")
        else:
            print(f"{s['n_invalid']} of {s['n_blocks']} blocks do not parse; first: block {s['first_invalid_block']} of {s['first_invalid_path']} ({s['first_invalid_ref']})")
            return 1
    elif args.cmd == "workload":
        (jobs.workload(spark, args.name, args.input, args.dim)
         .write.mode("overwrite").option("header", "true").csv(args.out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
