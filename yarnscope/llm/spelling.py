"""Spelling variants: words one edit apart, by asymmetric chunks.

Of two words one edit apart the shorter (of equal ones, either) is cut into
two disjoint chunks, its halves. The edit falls into one of them, so the other
one stands in the other word too, as a gram shifted by one place at most. The
half with the edit is cut in two once more by the same rule, so that what must
agree is that half's kept chunk as well; a word brings four such signatures as
the one that is cut and, for each length it may be compared with, four as the
one whose grams are looked up. Words with an equal signature are verified.

What agrees is three quarters of a word, so a group holds the words that
differ inside one quarter only and stays small, however common its letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yarnscope.llm.native import ascii_lower
from yarnscope.session import materialize

#: Least code points and least occurrences of a word.
MIN_LENGTH, MIN_COUNT = 5, 3
#: Of runs whose checksum this divides, one code point is deleted.
TYPO_EVERY = 97

_RUN = "[A-Za-zÀ-ÿ]+"


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words of ``docs(doc_id, text)``.

    A run of letters loses the code point ``h % length`` where TYPO_EVERY
    divides h, the crc32 of ``<doc_id>:<run>``; a null doc_id is empty there.
    """
    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), ascii_lower(F.col("text").cast("string")).alias("text"))
    runs = texts.select("id", F.explode(F.regexp_extract_all("text", F.lit(_RUN), F.lit(0))).alias("run")) \
        .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("h") % TYPO_EVERY == 0, rest).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _cuts(length: Column) -> list[Column]:
    """Bounds of the halves of the halves of a word."""
    half = F.floor(length / 2)
    return [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]


def _kept(word: Column, length: Column, quarter: int) -> Column:
    """What must agree if the edit lies in this quarter of a word of ``length``: the text before and behind it."""
    cuts = _cuts(length)
    behind = length - cuts[quarter + 1]
    return F.concat(F.substring(word, F.lit(1), cuts[quarter].cast("int")), F.lit(" "),
                    F.substring(word, (F.char_length(word) - behind + 1).cast("int"), behind.cast("int")))


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``a, n_a, b, n_b``: every two of the distinct ``words(word, n)`` one edit apart, once; ``b`` is the longer, or greater."""
    word, size = F.col("word"), F.char_length("word")

    def signatures(longer: int) -> DataFrame:
        length = size - longer
        rows = F.explode(F.array(*[F.struct(F.xxhash64(length.cast("int"), F.lit(q), _kept(word, length, q)).alias("key"), F.lit(q).alias("quarter")) for q in range(4)]))
        return words.where(length >= min_length).select("word", "n", rows.alias("s")).select("s.key", "s.quarter", "word", "n")

    cut = signatures(0).select("key", "quarter", F.col("word").alias("a"), F.col("n").alias("n_a"))
    grams = signatures(0).unionByName(signatures(1)).select(F.col("key"), F.col("quarter").alias("q"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    a, b = F.col("a"), F.col("b")
    met = cut.join(grams.hint("merge"), "key").where((F.char_length(a) < F.char_length(b)) | (a < b)) \
        .where((F.col("quarter") == F.col("q")) & (F.levenshtein(a, b, 1) == 1))
    # a letter inserted into a run of equal ones may lie in several quarters: the first one counts
    earlier = F.lit(False)
    for q in range(3):
        earlier = earlier | ((F.col("quarter") > q) & (_kept(a, F.char_length(a), q) == _kept(b, F.char_length(a), q)))
    return met.where(~earlier).select("a", "n_a", "b", "n_b")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for the rows of ``forms(word, form)``, whose chains have no circle: the last form reached.

    Every round follows the pointers of the pointers, so rounds grow with the
    logarithm of the longest chain.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        follow = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(links.join(follow, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        links = step.select("word", "root")
        if step.where("moved").limit(1).count() == 0:
            return links


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs(doc_id, text)``.

    The form of a word is its near word of largest count (of equal ones the
    least in code-point order) if that is at least twice the word's, else
    null; the root is reached by following forms, the word itself without one.

    Null and empty texts have no words; repeated rows count as often as they
    occur; an empty table gives no rows; further columns are ignored. Texts of
    any length are read whole.
    """
    words = materialize(vocabulary(docs, min_length, min_count), "words")
    pairs = near_pairs(words, min_length)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form")).alias("near")),
                                          F.struct(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("less"), F.col("a").alias("form")).alias("near")))).alias("p")).select("p.*")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    best = -F.col("near.less")
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                    F.when(best >= 2 * F.col("n"), F.col("near.form")).alias("form"),
                                                    F.when(best >= 2 * F.col("n"), best).alias("form_n"))
    known = materialize(known, "variants")
    found = roots(known.where("form is not null"))
    return known.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
