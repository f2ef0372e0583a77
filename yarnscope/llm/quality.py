"""Quality rules: counts of words, symbols and repeats, and distribution divergence.

The verdict compares two histograms of a document with those of its
language over the whole corpus: character classes, and the language's most
frequent words. The measure is the Jensen-Shannon distance (root of the
divergence to base 2, 0 to 1). Histograms of few words are noisy, so each
distance has a least length.

Built-in functions only. Texts are read twice (frequent words, then counts);
what leaves a text is a row of counts, so no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yarnscope.llm.native import space_words, without
from yarnscope.session import materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Frequent words of a language that make its word histogram.
TOP_WORDS = 24
#: Parts that the words of the corpus are ranked in before the best of each are ranked together.
PARTS = 64
#: Documents and words that a language needs for a reference of its own; rarer ones are held against the whole corpus too.
MIN_DOCUMENTS, MIN_WORDS = 10, 5000
#: Distances above which a document is rejected, and the words it needs for that.
CHAR_DISTANCE, CHAR_MIN_WORDS = 0.33, 50
WORD_DISTANCE, WORD_MIN_WORDS = 0.42, 80
#: Distinct repeated windows up to which a plain list is searched; more are matched by sorting.
FEW = 64

_CLASSES = ("c_space", "c_symbol", "c_upper", "c_digit", "c_mark", "c_wide", "c_other")


def base_counts(docs: DataFrame) -> DataFrame:
    """Adds ``words`` and the base metrics to rows with a ``text`` that is not null."""
    length = F.char_length("text")
    out = docs.withColumn("words", space_words(F.col("text"))) \
        .withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")) \
        .withColumn("word_chars", F.char_length(without(F.col("text"), SPACES)).cast("long")) \
        .withColumn("n_symbols", (length - F.char_length(without(F.col("text"), SYMBOLS))).cast("long")) \
        .withColumn("n_words", F.size("words").cast("long"))
    out = out.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    # hashes of the 3-word windows; those that occur again, as the equal neighbours of a sorted copy
    out = out.withColumn("windows", F.when(F.col("n_words") < 3, F.array().cast("array<long>")).otherwise(F.expr(
        "transform(sequence(0, size(words) - 3), i -> xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)))")))
    out = out.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows"))
                         .otherwise(F.array().cast("array<long>")))
    out = out.withColumn("again", F.expr("array_distinct(filter(ordered, (x, i) -> i > 0 and x = ordered[i - 1]))"))
    few = "filter(sequence(0, size(windows) - 1), i -> array_contains(again, windows[i]))"
    paired = "sort_array(transform(sequence(0, size(windows) - 1), i -> struct(windows[i] as h, i as p)))"
    many = f"""transform(array({paired}), s -> transform(filter(transform(sequence(0, size(s) - 1), k -> struct(
        (k > 0 and s[k].h = s[greatest(k - 1, 0)].h) or (k < size(s) - 1 and s[k].h = s[least(k + 1, size(s) - 1)].h) as hit,
        s[k].p as p)), z -> z.hit), z -> z.p))[0]"""
    out = out.withColumn("places", F.expr(
        f"case when size(again) = 0 then cast(array() as array<int>) when size(again) <= {FEW} then {few} else {many} end"))
    return out.withColumn("n_repeat_words", F.expr(
        "cast(size(array_distinct(concat(places, transform(places, p -> p + 1), transform(places, p -> p + 2)))) as long)")) \
        .drop("windows", "ordered", "again", "places")


def class_counts(docs: DataFrame) -> DataFrame:
    """Adds the character classes of ``text``; needs word_chars and n_symbols."""
    length = F.char_length("text")
    less = lambda pattern: length - F.char_length(F.regexp_replace("text", pattern, ""))
    out = docs.withColumn("c_space", length - F.col("word_chars")).withColumn("c_symbol", F.col("n_symbols")) \
        .withColumn("c_upper", less("[A-Z]+")).withColumn("c_digit", less("[0-9]+")) \
        .withColumn("c_mark", less("[.,;:!?()\"'-]+")).withColumn("c_wide", F.octet_length("text") - length)
    known = sum((F.col(c) for c in _CLASSES[1:-1]), F.col("c_space"))
    out = out.withColumn("c_other", F.greatest(F.lit(0), length - known))
    return out.withColumn("classes", F.array(*[F.col(c).cast("long") for c in _CLASSES])).drop(*_CLASSES)


def js_distance(p: Column, q: Column) -> Column:
    """Root of the Jensen-Shannon divergence (base 2) of two histograms given as counts; null if one is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    share = lambda a: F.transform(F.array(F.struct(a.alias("a"), total(a).alias("t"))), lambda z: F.transform(z["a"], lambda x: x / z["t"]))[0]
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(share(p), share(q), lambda x, y: (half(x, (x + y) / 2) + half(y, (x + y) / 2)) / 2)
    return F.when((total(p) > 0) & (total(q) > 0), F.sqrt(F.greatest(F.lit(0.0), total(terms))))


def references(texts: DataFrame) -> DataFrame:
    """``ref, top, longest, ref_frequent``: the most frequent words of each language, sorted, the bytes of the longest one, and their counts with that of all other words.

    Languages of fewer than MIN_DOCUMENTS documents or MIN_WORDS words have no
    row; the row with null ``ref`` is the whole corpus. Counts are exact.
    """
    counted = texts.select("lang", F.explode(space_words(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    counted = materialize(counted, "word-counts")
    spoken = texts.where("lang is not null").groupBy("lang").agg(F.count("*").alias("docs")).where(F.col("docs") >= MIN_DOCUMENTS)
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("words"))
    own = sizes.where(F.col("words") >= MIN_WORDS).join(spoken.select("lang"), "lang")
    frequent = counted.join(own, "lang").withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("k") <= TOP_WORDS)
    # the whole corpus: the best of each part of the words, then the best of these
    whole = counted.groupBy("word").agg(F.sum("n").alias("n")).withColumn("k", F.row_number().over(
        Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(PARTS))).orderBy(F.desc("n"), "word"))).where(F.col("k") <= TOP_WORDS) \
        .orderBy(F.desc("n"), "word").limit(TOP_WORDS).select(F.lit(None).cast("string").alias("lang"), F.lit(None).cast("long").alias("words"), "word", "n")
    total = sizes.select(F.sum("words")).scalar()
    both = frequent.select("lang", "words", "word", "n").unionByName(whole).withColumn("words", F.coalesce("words", total))
    lists = both.groupBy(F.col("lang").alias("ref")).agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"), (F.max("words") - F.sum("n")).alias("other"))
    return lists.select("ref", F.col("w.word").alias("top"), F.array_max(F.transform("w.word", F.octet_length)).alias("longest"), F.concat("w.n", F.array("other")).alias("ref_frequent"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, char_distance, word_distance, kept``; ``row`` is the pair of
    doc_id and a hash of the text, by which callers find the rows again.

    Null texts count as empty: no words, base_failed. A distance is null for a
    document without words or whose language has no words. Documents without
    lang, or of a language with fewer than MIN_DOCUMENTS documents or
    MIN_WORDS words, are held against the whole corpus, all documents counted.
    Repeated rows are judged alike; further columns are ignored.
    """
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    lists = materialize(references(texts), "references")
    common, common_longest = (lists.where("ref is null").select(c).scalar() for c in ("top", "longest"))
    none = F.array().cast("array<string>")
    # a document counts the words of its own reference only; the join is left to Catalyst, which knows the lists' bytes
    out = texts.join(lists.where("ref is not null").select("ref", "top", "longest"), F.col("lang") == F.col("ref"), "left") \
        .select("doc_id", "text", "ref", F.coalesce("top", common, none).alias("top"), F.coalesce("longest", common_longest, F.lit(0)).alias("longest"))
    out = class_counts(base_counts(out))
    out = out.withColumn("hits", F.expr("filter(words, w -> octet_length(w) <= longest and array_contains(top, w))")) \
        .withColumn("frequent", F.expr("transform(top, w -> cast(size(hits) - size(array_remove(hits, w)) as long))")) \
        .withColumn("frequent", F.concat("frequent", F.array(F.col("n_words") - F.aggregate("frequent", F.lit(0).cast("long"), lambda s, x: s + x))))
    metrics = materialize(out.select("doc_id", F.xxhash64("text").alias("hash"), "ref", "n_words", "word_chars", "n_symbols",
                                     "n_dup_lines", "n_repeat_words", "classes", "frequent"), "metrics")
    return judge(metrics, lists)


def judge(metrics: DataFrame, lists: DataFrame) -> DataFrame:
    """Distances and verdicts from the counts of every document and the word counts of the references."""
    sums = F.array(*[F.sum(F.get("classes", F.lit(i))) for i in range(len(_CLASSES))]).alias("ref_classes")
    classes = metrics.where("ref is not null").groupBy("ref").agg(sums).unionByName(metrics.agg(sums).withColumn("ref", F.lit(None).cast("string")))
    refs = classes.join(lists.select(F.col("ref").alias("of"), "ref_frequent"), F.col("ref").eqNullSafe(F.col("of")), "left").drop("of")
    refs = materialize(refs, "classes").withColumnRenamed("ref", "of")
    out = metrics.join(refs, F.col("ref").eqNullSafe(F.col("of")), "left") \
        .withColumn("char_distance", js_distance(F.col("classes"), F.col("ref_classes"))) \
        .withColumn("word_distance", js_distance(F.col("frequent"), F.col("ref_frequent")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.col("n_words") >= CHAR_MIN_WORDS) & (F.col("char_distance") > CHAR_DISTANCE)) | \
        ((F.col("n_words") >= WORD_MIN_WORDS) & (F.col("word_distance") > WORD_DISTANCE))
    return out.select("doc_id", "hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                      "char_distance", "word_distance", (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"))
