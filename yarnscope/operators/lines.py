"""Resource-manager log lines -> ``log_line`` rows.

Filters, in order: dated ``INFO`` lines (two spaces after the level), lines
carrying an application / attempt / container id, lines with at least one
useful field, and optionally an inclusive application-number range. All of
it is narrow (no shuffle) and stays inside whole-stage code generation.

Cost: every field pattern is preceded by a ``contains`` guard on a literal
that any match must include, so the (backtracking) regular expression only
runs on lines that can match. Each field is extracted with a single regex
call: a capture that is ``''`` stands for "no match" where the pattern
cannot match with an empty capture, and for "no number" where an empty
number would be an error.

Output schema::

    app_id string, app_num int, attempt_nb int, exit_code int, user string,
    ts string, is_launch boolean, final_status string,
    container struct<id int, host string>, pos struct<path, block, seq>
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_FORMAT, LogFormat

INT_MAX = 2147483647

# ---- fixed values: literals every match of the corresponding pattern contains
GUARDS = {
    "attempt_number": ("appattempt_", "container_e"),
    "user": ("user: ",),
    "final_state": ("State change from ",),
    "container": ("container_e",),
    "exit_status": (" with final state: ",),
    "launch": (" to LAUNCHED",),
}


def guard(v: Column, key: str) -> Column:
    lits = GUARDS[key]
    g = v.contains(lits[0])
    for s in lits[1:]:
        g = g | v.contains(s)
    return g


def guarded_extract(v: Column, key: str, pattern: str, group: int) -> Column:
    """``regexp_extract`` on lines that pass the guard, ``''`` on the others."""
    return F.when(guard(v, key), F.regexp_extract(v, pattern, group)).otherwise(F.lit(""))


def parse_rm_lines(lines: DataFrame, *, with_exit_code: bool = True,
                   app_range: tuple[int, int] | None = None,
                   fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """Parse and filter ``(value, pos)`` lines.

    ``with_exit_code=False`` is the run-reconstruction variant: exit codes are
    not read, so a line whose only content is an exit status is dropped.
    """
    p = fmt.rm
    v = F.col("value")
    kept = lines.where(v.rlike(p["info_line"]) & v.contains(f"{fmt.cluster}_") & v.rlike(p["has_id"]))

    exit_code = (F.coalesce(guarded_extract(v, "exit_status", p["exit_status"], 1).try_cast("int"), F.lit(0))
                 if with_exit_code else F.lit(0))
    host = guarded_extract(v, "container", p["container"], 2)
    parsed = kept.select(
        F.regexp_extract(v, p["app_number"], 2).alias("app_id"),
        F.coalesce(guarded_extract(v, "attempt_number", p["attempt_number"], 2).try_cast("int"),
                   F.lit(0)).alias("attempt_nb"),
        exit_code.alias("exit_code"),
        guarded_extract(v, "user", p["user"], 1).alias("user"),
        F.regexp_extract(v, p["timestamp"], 1).alias("ts"),
        (guard(v, "launch") & v.rlike(p["launch"])).alias("is_launch"),
        guarded_extract(v, "final_state", p["final_state"], 1).alias("final_status"),
        host.alias("_host"),
        F.when(guard(v, "container"), F.regexp_extract(v, p["container"], 1)).alias("_cid"),
        F.col("pos"),
    ).select(
        "app_id", F.col("app_id").try_cast("int").alias("app_num"), "attempt_nb", "exit_code", "user", "ts",
        "is_launch", "final_status",
        F.when(F.col("_host") != "", F.struct(F.col("_cid").try_cast("int").alias("id"),
                                              F.col("_host").alias("host"))).alias("container"),
        "pos")

    useless = ((F.col("exit_code") == 0) & (F.col("user") == "") & ~F.col("is_launch")
               & (F.col("final_status") == "") & F.col("container").isNull())
    out = parsed.where(~useless)
    if app_range is not None:
        lo, hi = app_range
        out = out.where(F.col("app_num").between(int(lo), int(hi)))
    return out
