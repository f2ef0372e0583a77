"""Container logs of any size: a line scan that gives back condensed records.

A record of an aggregated container log is one row only if it stays below
Spark's 2 GB; the log of a long-running driver does not. Here the log is read
line by line, so every file splits, and a record comes back as the text of the
lines that a rule can see:

* a stamped line (one that begins with a log timestamp) without any of KEEP is
  dropped; of a run of such lines the first two stay as a stamp, so that
  "the next line" and "up to the next timestamp" mean what they meant;
* stage numbers of dropped lines are summed up as the largest one of the
  record, which stands in front of its text;
* all other lines stay whole, in order.

Every pattern of the classifier gives on the condensed text what it gives on
the whole record. Lines are assigned to records by a running count of
separators: inside a split by a window, across the splits of a file by the
totals of the splits before it (one row each). Of dropped lines no text leaves
the scan but the stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.patterns import CLS, RECORD_DELIMITER
from ..sources.text import position

# ---- fixed values: literals of which every rule's line holds one ---------------
KEEP = ("ERROR", "Error", "Exception", "container_", "appattempt_", "scala:", "(App", "Final app status", "Cancelling stage ", "Final stage",
        "WARN BlockManager: Failed to fetch", "WARN TransportChannelHandler:", " INFO Utils: ", "maxResultSize", "due to stage failure",
        "\r", "\x85", "\u2028", "\u2029")
STAMP = r"^\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} "
# ---------------------------------------------------------------------------------
#: Stamped lines of a dropped run that stay as a stamp; no pattern looks further than two lines on.
STAMPS = 2


def read_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, pos)`` of every line; only a line feed ends one, as inside a record."""
    return spark.read.option("lineSep", "\n").text(path).select("value", position().alias("pos"))


def _stamp(line: Column) -> Column:
    """What stays of a dropped line: its timestamp, and whether a frame of user code could be read from it."""
    frame = F.substring_index(line, "at ", -1)
    return F.concat(F.substring(line, 1, 17), F.when(line.contains("at "), F.when(frame.contains(CLS["user_code_marker"]), F.lit(" at App")).otherwise(F.lit(" at "))).otherwise(F.lit("")))


def log_lines(lines: DataFrame, delimiter: str = RECORD_DELIMITER) -> DataFrame:
    """``path, block, seq, ends, size, text, stamp, stage``: one narrow row per line.

    ``ends`` marks a separator; ``text`` is null for a dropped line and
    ``stage`` the largest stage that such a line names.
    """
    stars = delimiter.removesuffix("\n")
    line = F.when(F.col("value").endswith(stars), F.expr(f"left(value, char_length(value) - {len(stars)})")).otherwise(F.col("value"))
    out = lines.select(F.col("pos.path").alias("path"), F.col("pos.block").alias("block"), F.col("pos.seq").alias("seq"), F.col("value").endswith(stars).alias("ends"), line.alias("line"))
    drop = ~F.col("ends") & F.col("line").rlike(STAMP) & ~X.contains_any(F.col("line"), KEEP)
    stages = F.array_max(X.extract_all(F.col("line"), CLS["generic_stage"], 1).try_cast("array<bigint>"))
    return out.select("path", "block", "seq", "ends", F.char_length("line").cast("long").alias("size"), F.when(~drop, F.col("line")).alias("text"),
                      F.when(drop, _stamp(F.col("line"))).alias("stamp"), F.when(drop & F.col("line").contains("stage "), stages).alias("stage"))


def condensed_records(lines: DataFrame, delimiter: str = RECORD_DELIMITER) -> DataFrame:
    """``(value, pos, n_chars)``: the condensed records of ``lines(value, pos)``, each with the position of its first line and its whole length.

    A record ends with a line that ends with the separator, or with its file.
    The last line of a file counts as ended by a line feed. A record's kept
    lines must fit into a row; the lines of a split may be any number.
    """
    marked = log_lines(lines, delimiter)
    here = Window.partitionBy("path", "block").orderBy("seq")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    counted = marked.withColumn("inner", F.coalesce(F.sum(F.col("ends").cast("long")).over(before), F.lit(0).cast("long"))) \
        .withColumn("gap", F.col("seq") - F.coalesce(F.max(F.when(F.col("text").isNotNull(), F.col("seq"))).over(before), F.min("seq").over(before) - 1, F.col("seq") - 1))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = marked.groupBy("path", "block").agg(F.sum(F.col("ends").cast("long")).alias("ends")) \
        .select("path", "block", F.coalesce(F.sum("ends").over(earlier), F.lit(0).cast("long")).alias("outer"))
    placed = counted.join(splits, ["path", "block"]).withColumn("record", F.col("outer") + F.col("inner"))
    text = F.coalesce("text", F.when(F.col("gap") <= STAMPS, F.col("stamp")))
    end = F.when(F.col("ends"), F.lit("")).otherwise(F.lit("\n"))
    grouped = placed.groupBy("path", "record").agg(
        F.collect_list(F.when(text.isNotNull(), F.struct("block", "seq", F.concat(text, end).alias("t")))).alias("parts"), F.max("stage").alias("stage"),
        F.sum(F.col("size") + F.when(F.col("ends"), 0).otherwise(1)).alias("n_chars"), F.min(F.struct("block", "seq")).alias("first"))
    joined = F.array_join(F.transform(F.sort_array("parts"), lambda p: p["t"]), "")
    return grouped.select(F.concat(F.when(F.col("stage").isNotNull(), F.concat(F.lit("stage "), F.col("stage").cast("string"), F.lit("\n"))).otherwise(F.lit("")), joined).alias("value"),
                          F.struct("path", F.col("first.block").alias("block"), F.col("first.seq").alias("seq")).alias("pos"), "n_chars")


def read_long_records(spark: SparkSession, path: str | list[str], delimiter: str = RECORD_DELIMITER) -> DataFrame:
    """``(value, pos, n_chars)`` of the container logs at ``path``, of any size."""
    return condensed_records(read_log_lines(spark, path), delimiter)
