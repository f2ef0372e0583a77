"""Text reports (sinks) and the report reader / validator.

* ``application_blocks``  one text block per application with its attempts
* ``failure_blocks``      one text block per classified attempt
* ``write_report``        distributed text sink; blocks are written in key
  order (range partitioned), so concatenating the part files in name order
  gives the whole report, with no single-task or driver-side write
* ``read_report`` / ``parse_report`` / ``validate_report``  split a report at
  its ``AppAttempt`` keyword, extract the fields of every block with one
  anchored pattern, and split valid blocks from quarantined ones
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_FORMAT, LogFormat
from ..session import materialize
from ..sources.text import position

# ---- fixed values: report layout -------------------------------------------
APP_HEADER = "ApplicationId : application_{c}_%s\n\nUser          : %s\n\nNumAttempts   : %d"
APP_ATTEMPT = "\n\nAttemptNumber : %d\n\nStartTime     : %s\n\nEndTime       : %s\n\nFinalStatus   : %s\n\nContainers    : %s"
FAILURE_BLOCK = ("\n\nAppAttempt  : appattempt_{c}_%s_%06d\n\nUser          : %s\n\nStartTime     : %s"
                 "\n\nEndTime       : %s\n\nContainers    : %s\n\nErrorCategory : %d\n\nException     : %s"
                 "\n\nStage         : %d\n\nSourceCodeLine: %d ")
FAILURE_CONTAINER = "container_e02_{c}_%s_%02d_%06d -> %s"


def application_blocks(apps_with_attempts: DataFrame, fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """``(app_id, text)``: the application block followed by a blank line."""
    head = APP_HEADER.replace("{c}", fmt.cluster)

    def attempt_text(a: Column) -> Column:
        containers = F.array_join(F.transform(
            a["containers"], lambda c: F.format_string("(%d,%s)", c["id"], c["host"])), ", ")
        return F.format_string(APP_ATTEMPT, a["attempt_nb"], a["start_time"], a["end_time"],
                               a["final_status"], containers)

    text = F.concat(F.format_string(head, "app_id", "user", "num_attempts"),
                    F.array_join(F.transform("attempts", attempt_text), ""), F.lit("\n\n"))
    return apps_with_attempts.select("app_id", text.alias("text"))


def failure_blocks(diagnosis: DataFrame, fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """``(app_id, attempt_nb, text)``: one report block per classified attempt."""
    block = FAILURE_BLOCK.replace("{c}", fmt.cluster)
    cfmt = FAILURE_CONTAINER.replace("{c}", fmt.cluster)
    containers = F.array_join(F.transform(
        "containers", lambda c: F.format_string(cfmt, F.col("app_id"), F.col("attempt_nb"), c["id"], c["host"])),
        ", ")
    text = F.format_string(block, "app_id", "attempt_nb", "user", "start_time", "end_time", containers,
                           "error_category", "exception", "stage", "source_line")
    return diagnosis.select("app_id", "attempt_nb", text.alias("text"))


def write_report(blocks: DataFrame, path: str, order: list[str]) -> None:
    """Write blocks as text in ``order`` (range partitioned, one part file per range).

    Each block starts with its blank-line separator; the first newline of
    the separator is written as the line separator of the previous row, so
    consecutive blocks are separated exactly as in a single-file report.
    """
    (blocks.orderBy(*order).select(F.substr("text", F.lit(2)).alias("text"))
     .write.mode("overwrite").option("lineSep", "\n").text(path))


def read_report(spark: SparkSession, path: str, fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """``(value, pos)``: one record per report block, split at ``AppAttempt``."""
    kw = fmt.report["block_keyword"]
    return (spark.read.option("lineSep", kw).text(path)
            .select("value", position().alias("pos")))


#: Names of the fields of a block, in order; the first is the keyword itself.
FIELDS = ("AppAttempt", "User", "StartTime", "EndTime", "Containers", "ErrorCategory", "Exception", "Stage", "SourceCodeLine")


def _fields(block: str) -> list[str]:
    """The block pattern up to and with each field, the last one without the end of the block."""
    out, at = [], 0
    for name in FIELDS[1:]:
        at = block.index(rf"\s+{name}\s*:", at)
        out.append(block[:at])
    return [*out, block.removesuffix(r"\s*$")]


def misfit(v: Column, items: Column, fmt: LogFormat = DEFAULT_FORMAT) -> Column:
    """``(field, at)`` of the first field of a block that does not fit, as its character offset in the block; null for a block that fits.

    The pattern is matched field by field: the longest prefix that matches
    ends where the offending field begins. Of a container list it is the first
    pair that does not fit. Text behind the last field is named ``end``.
    """
    prefixes, pair = _fields(fmt.report["block"]), fmt.report["container_pair"]

    def behind(prefix: str) -> Column:
        return F.length(F.regexp_extract(v, prefix + r"\s*", 0))

    def found(name: str, at: Column) -> Column:
        return F.struct(F.lit(name).alias("field"), at.cast("int").alias("at"))

    bad = F.array_position(F.transform(items, lambda s: s.rlike(pair)), False)
    before = F.aggregate(F.slice(items, 1, F.greatest(F.lit(1), bad).cast("int") - 1), F.lit(0), lambda n, s: n + F.length(s) + 1)
    pair_at = F.element_at(items, F.greatest(F.lit(1), bad).cast("int"))
    chain = F.when(~v.rlike(prefixes[0]), found(FIELDS[0], behind("^")))
    for i in range(1, len(prefixes)):
        at = behind(prefixes[i - 1])
        if FIELDS[i - 1] == "Containers":  # its pattern takes as little as it can: the next label is the word before the next colon
            label = F.length(F.regexp_extract(v, prefixes[i - 2] + r"\s+Containers\s*:[^:]*\s(?=[^\s:]+\s*:)", 0))
            at = F.when(label > 0, label).otherwise(at)
        chain = chain.when(~v.rlike(prefixes[i]), found(FIELDS[i], at))
        if FIELDS[i] == "Containers":
            chain = chain.when(bad > 0, found("Containers", behind(prefixes[i]) + before + F.length(pair_at) - F.length(F.ltrim(pair_at))))
    return chain.when(~v.rlike(fmt.report["block"]), found("end", behind(prefixes[-1])))


def parse_report(records: DataFrame, fmt: LogFormat = DEFAULT_FORMAT) -> DataFrame:
    """Blocks -> ``(pos, valid, misfit struct<field, at>, attempt_id, user, start_time, end_time,
    containers array<struct<container, host>>, error_category, exception, stage, source_line)``.

    The text before the first keyword must be blank; every later record must
    match the block pattern as a whole. Invalid blocks keep NULL fields, and
    ``misfit`` names the first one that does not fit and its offset in the
    block, counted from the end of the keyword (``start`` for other text
    before the first keyword).
    """
    p = fmt.report["block"]
    v = F.col("value")
    pair = fmt.report["container_pair"]

    def g(i: int) -> Column:
        return F.when(F.col("valid"), F.regexp_extract(v, p, i))

    # The text before the first keyword is the first record of its file: one
    # small row per file, joined back on the file path. The records are written
    # once, so that both sides see the same positions.
    records = materialize(records, "report-records")
    firsts = records.groupBy(F.col("pos.path").alias("_path")).agg(F.min("pos").alias("_first"))
    blocks = (records.join(firsts, F.col("pos.path") == F.col("_path"), "left")
              .withColumn("_lead", F.col("pos") == F.col("_first")))
    blocks = blocks.where(~(F.col("_lead") & v.rlike(r"^\s*$")))
    # containers are checked one by one: a repeated group in the pattern would recurse once for each
    listed = F.regexp_extract(v, p, 5)
    items = F.when(listed == "", F.array().cast("array<string>")).otherwise(F.split(listed, ","))
    blocks = blocks.withColumn("_items", items).withColumn("valid", ~F.col("_lead") & v.rlike(p) & F.forall("_items", lambda s: s.rlike(pair)))
    pairs = F.when(F.col("valid"), F.transform(
        "_items", lambda s: F.struct(F.regexp_extract(s, pair, 1).alias("container"),
                           F.regexp_extract(s, pair, 2).alias("host"))))
    loose = F.regexp_extract(v, fmt.report["attempt_ref"], 0)
    return blocks.select(
        "pos", "valid", F.when(F.col("_lead"), F.struct(F.lit("start").alias("field"), F.length(F.regexp_extract(v, r"^\s*", 0)).alias("at")))
        .when(~F.col("valid"), misfit(v, F.col("_items"), fmt)).alias("misfit"), F.when(loose != "", loose).alias("attempt_ref"),
        g(1).alias("attempt_id"), g(2).alias("user"), g(3).alias("start_time"), g(4).alias("end_time"),
        pairs.alias("containers"),
        g(6).try_cast("int").alias("error_category"), g(7).alias("exception"),
        g(8).try_cast("int").alias("stage"), g(9).try_cast("int").alias("source_line"))


def validate_report(parsed: DataFrame) -> DataFrame:
    """One row: ``(n_blocks, n_invalid, first_invalid_path, first_invalid_block, first_invalid_ref, first_invalid_field, first_invalid_offset, accepted)``.

    The report is accepted only when every block parses. The first offending
    block is given by its file, its number among the file's blocks (from 1,
    whatever the splits), the attempt it names, if any, and the field and
    offset inside it.
    """
    bad = parsed.where(~F.col("valid")).agg(F.min(F.struct("pos", "attempt_ref", "misfit")).alias("b"))
    before = parsed.join(F.broadcast(bad.select(F.col("b.pos").alias("_at"))), F.col("pos") <= F.col("_at")) \
        .where(F.col("pos.path") == F.col("_at.path")).agg(F.count("*").alias("n"))
    return parsed.agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.count_if(~F.col("valid")).alias("n_invalid"),
        F.max(bad.select("b.pos.path").scalar()).alias("first_invalid_path"),
        F.max(F.nullif(before.select("n").scalar(), F.lit(0))).alias("first_invalid_block"),
        F.max(bad.select("b.attempt_ref").scalar()).alias("first_invalid_ref"),
        F.max(bad.select("b.misfit.field").scalar()).alias("first_invalid_field"),
        F.max(bad.select("b.misfit.at").scalar()).alias("first_invalid_offset"),
        (F.count_if(~F.col("valid")) == 0).alias("accepted"))
