"""Render resource-manager log lines from the ``events`` table.

The real inputs of the log jobs (cluster logs) are not available, so the
plans render log text from a driver table inside Spark and then parse it
with the engine; the oracles compute the expected answer straight from the
table columns. Rendering is a narrow projection: one line per event, so the
log grows with the table.

Mapping (one event -> one line, ``pos = event_id``):

* application ``A = user_id`` with at least four digits, attempt ``N = event_id % 3 + 1``
* level ``WARN`` when ``event_id % 13 = 0`` (dropped by the INFO filter),
  otherwise ``INFO``
* ``signup``   -> "Application added" line with user
  ``'u' || translate(((user_id * 7 + event_id % 2) % 29), digits, 'a'..'j')``
* ``view``     -> LAUNCHED transition (no id at all when ``event_id % 11 = 0``)
* ``click``    -> container ``event_id % 5 + 1`` assigned on host
  ``iccluster{40 + floor(value) % 20:03d}.iccluster.epfl.ch``
* ``purchase`` -> FINISHING transition (FINISHED, a line without a useful
  field, when ``event_id % 4 = 0``)
* ``error``    -> FAILED transition for even ids, otherwise a final-state
  line with exit status ``floor(value) % 4 - 1``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import DEFAULT_CLUSTER
from ..sources.text import synthetic_position

HOST_BASE = 40
HOST_COUNT = 20


def _s(c: Column) -> Column:
    return c.cast("string")


def _digits(c: Column, least: int) -> Column:
    """Decimal digits, zero-padded to ``least``; longer numbers stay whole."""
    return F.lpad(_s(c), F.greatest(F.length(_s(c)), F.lit(least)), F.lit("0"))


def rm_log_lines(events: DataFrame, cluster: str = DEFAULT_CLUSTER) -> DataFrame:
    """``(value, pos)`` resource-manager log lines, one per event."""
    eid = F.col("event_id")
    app = _digits(F.col("user_id"), 4)
    n = eid % 3 + 1
    ts = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss,SSS")
    level = F.when(eid % 13 == 0, F.lit("WARN")).otherwise(F.lit("INFO"))
    prefix = F.concat(ts, F.lit(" "), level, F.lit("  "))
    name = F.concat(F.lit("u"), F.translate(_s((F.col("user_id") * 7 + eid % 2) % 29), "0123456789", "abcdefghij"))
    attempt_id = F.concat(F.lit(f"appattempt_{cluster}_"), app, F.lit("_"), F.lpad(_s(n), 6, "0"))
    fl = F.floor(F.col("value")).cast("bigint")
    host = F.concat(F.lit("iccluster"), F.lpad(_s(F.lit(HOST_BASE) + fl % HOST_COUNT), 3, "0"),
                    F.lit(".iccluster.epfl.ch"))
    container_id = F.concat(F.lit(f"container_e02_{cluster}_"), app, F.lit("_"), F.lpad(_s(n), 2, "0"),
                            F.lit("_"), F.lpad(_s(eid % 5 + 1), 6, "0"))
    handle = F.lit("attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:handle(925)) - ")
    et = F.col("event_type")
    body = (
        F.when(et == "signup", F.concat(
            F.lit("capacity.ParentQueue (ParentQueue.java:addApplication(468)) - Application added - appId: "),
            F.lit(f"application_{cluster}_"), app, F.lit(" user: "), name,
            F.lit(" leaf-queue of parent: root #applications: 1")))
        .when((et == "view") & (eid % 11 == 0), F.lit(
            "rmapp.RMAppImpl (RMAppImpl.java:handle(779)) - no identifier on this line, "
            "State change from RUNNING to FAILED"))
        .when(et == "view", F.concat(handle, attempt_id,
                                     F.lit(" State change from ALLOCATED to LAUNCHED on event = LAUNCHED")))
        .when(et == "click", F.concat(
            F.lit("scheduler.SchedulerNode (SchedulerNode.java:allocateContainer(163)) - Assigned container "),
            container_id, F.lit(" of capacity <memory:2048, vCores:1> on host "), host, F.lit(":45454")))
        .when((et == "purchase") & (eid % 4 == 0), F.concat(
            handle, attempt_id, F.lit(" State change from FINISHING to FINISHED on event = CONTAINER_FINISHED")))
        .when(et == "purchase", F.concat(
            handle, attempt_id, F.lit(" State change from RUNNING to FINISHING on event = UNREGISTERED")))
        .when((et == "error") & (eid % 2 == 0), F.concat(
            handle, attempt_id, F.lit(" State change from FINAL_SAVING to FAILED on event = ATTEMPT_UPDATE_SAVED")))
        .otherwise(F.concat(
            F.lit("attempt.RMAppAttemptImpl (RMAppAttemptImpl.java:rememberTarget(1291)) - "),
            F.lit("Updating application attempt "), attempt_id,
            F.lit(" with final state: FAILED, and exit status: "), _s(fl % 4 - 1)))
    )
    return events.select(F.concat(prefix, body).alias("value"), synthetic_position("events", eid).alias("pos"))


def case_index(user_id: Column, attempt_nb: Column) -> Column:
    """Which classifier case an attempt's container logs follow."""
    from .classify_cases import CASES
    return (user_id * 3 + attempt_nb - 1) % len(CASES)


def repeats(user_id: Column, attempt_nb: Column) -> Column:
    """Further driver records of an attempt: two for one in six, one for another in six."""
    turn = (user_id + attempt_nb) % 6
    return F.when(turn == 0, 2).when(turn == 1, 1).otherwise(0)


def container_log_records(events: DataFrame, cluster: str = DEFAULT_CLUSTER) -> DataFrame:
    """``(value, pos)`` aggregated container-log records, per attempt of ``events``.

    Attempts are ``(user_id, event_id % 3 + 1)``, found with a partial
    aggregate. Each attempt gets a driver record (container 1; some have one
    or two more, see ``repeats``), the case's executor record (container 2) when it has one, and an idle executor
    record (container 3); the case follows ``case_index``.
    """
    from .classify_cases import CASES, DRIVER_DECOY, DRIVER_FILLER, EXECUTOR_FILLER, FIRST_DECIDES, IDLE_EXECUTOR

    att = (events.groupBy(F.col("user_id"), (F.col("event_id") % 3 + 1).alias("attempt_nb"))
           .agg(F.min("ts").alias("t0")))
    idx = case_index(F.col("user_id"), F.col("attempt_nb")) + 1
    drv = F.element_at(F.array(*[F.lit(c[1]) for c in CASES]), idx.cast("int"))
    exe = F.element_at(F.array(*[F.lit(c[2] or "") for c in CASES]), idx.cast("int"))
    # repeated records of a container: one or two more driver records that name another diagnosis; they
    # stand behind the case where the first record decides and before it where the last one does
    again = repeats(F.col("user_id"), F.col("attempt_nb"))
    first_decides = F.element_at(F.array(*[F.lit(c[3][0] in FIRST_DECIDES) for c in CASES]), idx.cast("int"))
    recs = F.array(
        F.struct(F.lit(1).alias("cid"), F.lit(0).alias("turn"), F.concat(F.lit(DRIVER_FILLER), drv).alias("body")),
        *[F.when(again >= n, F.struct(F.lit(1).alias("cid"), F.when(first_decides, n).otherwise(-n).alias("turn"), F.lit(DRIVER_DECOY).alias("body"))) for n in (1, 2)],
        F.when(exe != "", F.struct(F.lit(2).alias("cid"), F.lit(0).alias("turn"), F.concat(F.lit(EXECUTOR_FILLER), exe).alias("body"))),
        F.struct(F.lit(3).alias("cid"), F.lit(0).alias("turn"), F.lit(IDLE_EXECUTOR).alias("body")),
    )
    app = _digits(F.col("user_id"), 4)
    n2 = _digits(F.col("attempt_nb"), 2)
    exploded = att.select("user_id", "attempt_nb", "t0", F.explode(recs).alias("r")).where(F.col("r").isNotNull())
    host = F.concat(F.lit("iccluster"),
                    F.lpad(_s(F.lit(HOST_BASE) + (F.col("user_id") + F.col("r.cid")) % HOST_COUNT), 3, "0"),
                    F.lit(".iccluster.epfl.ch"))
    header = F.concat(F.lit(f"Container: container_e02_{cluster}_"), app, F.lit("_"), n2, F.lit("_"),
                      F.lpad(_s(F.col("r.cid")), 6, "0"), F.lit(" on "), host,
                      F.lit("_45454_1589561045949\nLogType:stderr\nLogContents:\n"))
    text = F.concat(header, F.col("r.body"), F.lit("\n"))
    for key, val in (("{T}", F.date_format(F.col("t0"), "yy/MM/dd HH:mm:ss")), ("{A}", app), ("{N2}", n2),
                     ("{C}", F.lit(cluster))):
        text = F.replace(text, F.lit(key), val)
    seq = ((F.col("user_id") * 3 + F.col("attempt_nb")) * 4 + F.col("r.cid")) * 8 + F.col("r.turn")
    return exploded.select(text.alias("value"), synthetic_position("container_logs", seq).alias("pos"))


# Rendered inputs are written once per application and scale-factor folder
# into the shared checkpoint folder and read back through the text sources,
# exactly like log files collected from a cluster.
_WRITTEN: dict = {}


def _materialize(spark, key: str, sf_dir: str, build, delimiter: str | None) -> str:
    from ..session import scratch_path

    k = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), key)
    if k not in _WRITTEN:
        path = scratch_path(spark, key)
        # one file per range of positions, in order: like logs collected from
        # many nodes, and read back by as many tasks as there are cores
        files = max(1, spark.sparkContext.defaultParallelism)
        w = (build().repartitionByRange(files, "pos").sortWithinPartitions("pos")
             .select("value").write.mode("overwrite"))
        if delimiter is not None:
            w = w.option("lineSep", delimiter)
        w.text(path)
        _WRITTEN[k] = path
    return _WRITTEN[k]


def rm_log_path(spark, sf_dir: str) -> str:
    """Folder of the resource-manager log rendered from ``events`` (one line per event)."""
    from .tables import table
    return _materialize(spark, "rm-log", sf_dir, lambda: rm_log_lines(table(spark, sf_dir, "events")), None)


def container_log_path(spark, sf_dir: str) -> str:
    """Folder of the aggregated container logs rendered from ``events`` (star-delimited records)."""
    from ..functions.patterns import RECORD_DELIMITER
    from .tables import table
    return _materialize(spark, "container-logs", sf_dir,
                        lambda: container_log_records(table(spark, sf_dir, "events")), RECORD_DELIMITER)


def document_records_path(spark, sf_dir: str) -> str:
    """Folder of ``documents`` texts written as star-delimited records (in ``doc_id`` order)."""
    from ..functions.patterns import RECORD_DELIMITER
    from .tables import table

    def build():
        docs = table(spark, sf_dir, "documents")
        return docs.select(F.col("text").alias("value"), synthetic_position("documents", F.col("doc_id")).alias("pos"))
    return _materialize(spark, "document-records", sf_dir, build, RECORD_DELIMITER)
