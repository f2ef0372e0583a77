"""Benchmark decontamination: exact windows of benchmark items inside documents.

A prefix-filtered set join. A window of an item occurs in a document only if
all its words do, so the necessary prefix of a window, its words ordered from
rare to frequent over all documents, is the rarest word alone. Document words
are joined with these prefix words; position and length bounds discard
candidates that do not fit into the document, the window's end words discard
most others, and the rest is confirmed word by word, all inside one stage.
Only hits leave it.

Built-in functions only. The windows are broadcast while their text is below
BROADCAST_BYTES; a larger benchmark is joined by a shuffle of the words with
their neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yarnscope.llm.native import ascii_lower
from yarnscope.session import materialize

WINDOW = 10
#: Size of all distinct windows up to which they are sent to every executor.
BROADCAST_BYTES = 16 << 20


def item_words(text: Column) -> Column:
    """Runs of digits, a-z and characters beyond ASCII after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """``window`` (array of words) and ``item_id`` of every window of ``items(item_id, text)``."""
    words = items.where("text is not null").select("item_id", item_words(F.col("text").cast("string")).alias("words"), F.lit(size).alias("k")) \
        .where("size(words) > 0")
    return words.select("item_id", F.explode(F.expr("transform(sequence(1, greatest(1, size(words) - k + 1)), i -> slice(words, i, k))")).alias("window")) \
        .distinct()


def find_windows(docs: DataFrame, items: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every occurrence: ``doc_id, hash, start, length, item_id`` (start counts words from 0).

    ``hash`` is that of the text; with doc_id it finds the row again.
    """
    windows = item_windows(items, size)
    windows = materialize(windows.withColumn("wid", F.xxhash64("window")), "windows")
    # the hash names a window; its words are compared, so equal hashes of different windows do no harm
    distinct = windows.select("wid", "window").distinct()
    small = distinct.agg(F.sum(F.octet_length(F.concat_ws(" ", "window")) + 100)).first()[0] or 0
    send = F.broadcast if small <= broadcast_bytes else (lambda df: df)

    words = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("hash"), item_words(F.col("text")).alias("words"))
    vocabulary = distinct.select(F.explode("window").alias("word")).distinct()
    counts = words.select(F.explode("words").alias("word")).join(send(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    counts = materialize(counts, "rarity")
    # rarest word of every window, with its place
    tokens = distinct.select("wid", "window", F.posexplode("window").alias("at", "word")).join(counts, "word", "left")
    prefix = tokens.groupBy("wid", "window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("p")) \
        .where("p.n > 0").select("wid", "window", F.col("p.word").alias("rare"), F.col("p.at").alias("at"))
    prefix = materialize(prefix, "prefix")

    if small <= broadcast_bytes:
        there = words.select("doc_id", "hash", "words", F.size("words").alias("n"), F.posexplode("words").alias("pos", "rare")) \
            .withColumn("base", F.lit(0))
    else:  # only the neighbourhood of a word travels
        there = words.select("doc_id", "hash", "words", F.size("words").alias("n"), F.posexplode("words").alias("pos", "rare")) \
            .withColumn("base", F.greatest(F.lit(0), F.col("pos") - (size - 1))) \
            .withColumn("words", F.expr(f"slice(words, base + 1, {2 * size - 1})"))
    found = there.join(send(prefix), "rare") \
        .withColumn("start", F.col("pos") - F.col("at")).withColumn("length", F.size("window")) \
        .where("start >= 0 and start + length <= n") \
        .where("get(words, start - base) = get(window, 0) and get(words, start - base + length - 1) = get(window, length - 1)") \
        .where("slice(words, greatest(1, start - base + 1), length) = window") \
        .select("doc_id", "hash", "start", "length", "wid", "window")
    return found.join(send(windows), ["wid", "window"]).select("doc_id", "hash", "start", "length", "item_id")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, hash, n_words, n_hit, item_ids, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window of ``size``
    consecutive words of an item (or of a whole shorter item); ``item_ids`` are
    the items with such windows, as sorted strings.

    Null texts have no words (``hash`` is that of an empty text); items
    without words have no window; a null item_id is left out of ``item_ids``.
    Repeated rows get equal results, repeated items count once. Empty tables
    give no rows, or no hits. Further columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    hits = materialize(find_windows(docs, items.select("item_id", "text"), size, broadcast_bytes), "hits")
    key = ["doc_id", "hash"]
    before = Window.partitionBy(*key).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    ranges = hits.select(*key, "start", (F.col("start") + F.col("length")).alias("stop")).distinct() \
        .withColumn("reach", F.coalesce(F.max("stop").over(before), F.lit(0)))
    covered = ranges.groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reach"))).alias("n_hit"))
    named = hits.groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    per_doc = covered.join(named, covered["doc_id"].eqNullSafe(named["doc_id"]) & (covered["hash"] == named["hash"])) \
        .select(covered["doc_id"].alias("hit_id"), covered["hash"].alias("hit_hash"), "n_hit", "item_ids")
    base = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    return base.join(per_doc, base["doc_id"].eqNullSafe(per_doc["hit_id"]) & (base["hash"] == per_doc["hit_hash"]), "left") \
        .select("doc_id", "hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
