"""URL filters: longest host and path rule, else a classifier of segmented names.

Concatenated names in hosts and paths are split into words by a unigram
Viterbi search (most probable segmentation under word frequencies of the
pages; unknown strings pay for every letter). A multinomial naive Bayes over
the words of host and path, fitted on the urls that the rules decide, judges
the others.

Both tables are counts over all pages and stay Spark tables: the distinct
letter runs of the urls look up their parts in the word counts, are split once
each, and their weights are joined to the urls. Keys that hold more than a
thousandth of all rows (at most a thousand) are joined by broadcast, the rest by a
shuffle, so a hot host or word lands in no single task.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yarnscope.llm.native import ascii_lower
from yarnscope.session import materialize

#: Rules as (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Letters of the longest word that a name is split into, a parameter of the model; longer words are never a part.
LONGEST_WORD = 24
#: A key is hot with more than one in this many of all rows, so at most this many are.
HOT_SHARE = 1000
#: Rows of a batch.
BATCH = 20_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``rows`` joined with ``table``, which has a row for a key at most; hot keys of ``rows`` by a broadcast of at most HOT_SHARE rows."""
    sizes = materialize(rows.groupBy(*keys).agg(F.count("*").alias("n__")), "sizes")
    total = sizes.agg(F.sum("n__")).first()[0] or 0
    hot = sizes.where(F.col("n__") * HOT_SHARE > total).select(*keys)  # fewer than HOT_SHARE rows, as each has so many
    some = F.broadcast(materialize(hot, "hot"))
    return rows.join(some, keys, "left_semi").join(F.broadcast(table.join(some, keys, "left_semi")), keys, how) \
        .unionByName(rows.join(some, keys, "left_anti").join(table, keys, how))


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n`` over the pages' text: lower-case runs of letters of any script, of at most LONGEST_WORD."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), "<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}\p{M}]+")).alias("word")).where(F.length("word").between(1, LONGEST_WORD))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split of a string of letters into words, by their counts among ``total`` words."""
    every, ten = math.log(max(1, total)), math.log(10)
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for begin in range(max(0, end - LONGEST_WORD), end):
            n = counts.get(name[begin:end])
            # an unknown string: rarer than any word, and ten times rarer for every letter
            cost = every - math.log(n) if n else math.log(total + 1) + (end - begin) * ten
            options.append((best[begin] + cost, begin))
        cost, begin = min(options)
        best.append(cost)
        back.append(begin)
    words, end = [], len(name)
    while end:
        words.append(name[back[end]:end])
        end = back[end]
    words.reverse()
    return words


def split_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``name, split`` for every row of ``names(name)``, distinct strings of letters."""
    key = [F.xxhash64("name").alias("a__"), F.xxhash64("name", F.lit(1)).alias("b__")]
    names = materialize(names.select("name", *key), "names")
    found_schema = pa.schema([("a__", pa.int64()), ("b__", pa.int64()), ("word", pa.string())])

    def parts(batches):
        for batch in batches:
            rows = []
            for a, b, name in zip(*(batch.column(c).to_pylist() for c in ("a__", "b__", "name")), strict=True):
                for begin in range(len(name)):
                    rows += [(a, b, name[begin:end]) for end in range(begin + 1, min(len(name), begin + LONGEST_WORD) + 1)]
                    if len(rows) >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), found_schema, strict=True)], schema=found_schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), found_schema, strict=True)], schema=found_schema)

    parts_of = materialize(names.mapInArrow(parts, "a__ long, b__ long, word string").distinct(), "parts")
    found = join_hot(parts_of, counts, ["word"], "inner").groupBy("a__", "b__") \
        .agg(F.collect_list(F.struct("word", "n")).alias("found"))  # at most LONGEST_WORD for a letter of the name
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def split(batches):
        for batch in batches:
            out = [split_name(name, {x["word"]: x["n"] for x in found or ()}, total)
                   for name, found in zip(batch.column("name").to_pylist(), batch.column("found").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.list_(pa.string()))], names=["name", "split"])

    return names.join(found, ["a__", "b__"], "left").select("name", "found").mapInArrow(split, "name string, split array<string>")


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: ``page_id, host, path, rule, verdict, words, block_score``.

    ``words`` are the url's words (``h:`` of the host, ``p:`` of the path, a
    number is ``#``), ``block_score`` the log odds of ``block`` (of the
    classifier, also where a rule decides). Null urls and urls without
    ``://`` have empty host and path and no words; without words, or if no rule
    decides any url, the prior or ``allow`` is the verdict. Html, which may be
    null, only gives word frequencies. Repeated rows are judged alike; further
    columns are ignored. Very long urls are split whole; their words must fit
    into a row.
    """
    host, path = url_parts(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = materialize(parts.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("rule", rule).withColumn("ruled", verdict), "urls")

    # letter runs and numbers of every distinct url, in order
    def runs(kind: str, text):
        return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}]+|\p{Nd}+"), F.lit(0)), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("run")))

    number = F.col("run").rlike(r"^\p{Nd}")
    pieces = urls.select("host", "path", "n", "ruled", F.posexplode(F.concat(runs("h:", F.col("host")), runs("p:", F.col("path")))).alias("at", "x")) \
        .select("host", "path", "n", "ruled", "at", F.col("x.kind").alias("kind"), F.col("x.run").alias("run"))
    pieces = materialize(pieces.withColumn("run", F.when(number, F.lit("#")).otherwise(F.col("run"))), "pieces")
    # what the rules say of every run, before words are counted
    sums = [F.sum(F.when(F.col("ruled") == v, F.col("n")).otherwise(0)).alias(v) for v in ("block", "allow")]
    seen = materialize(pieces.groupBy("kind", "run").agg(*sums), "runs")
    counts = materialize(word_counts(pages), "counts")
    split = split_names(seen.where("run <> '#'").select(F.col("run").alias("name")).distinct(), counts)
    words = seen.join(split.withColumnRenamed("name", "run"), "run", "left") \
        .select("kind", "run", "block", "allow", F.posexplode(F.coalesce("split", F.array("run"))).alias("at", "word"))
    words = materialize(words.withColumn("token", F.concat("kind", "word")), "words")
    tokens = materialize(words.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")).where("block + allow > 0"), "tokens")

    of_class = urls.agg(*[F.coalesce(F.sum(F.when(F.col("ruled") == v, F.col("n"))), F.lit(0)).alias(v) for v in ("block", "allow")]).first()
    of_token = tokens.agg(F.count("*").alias("size"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in ("block", "allow")]).first()
    prior = math.log((of_class["block"] + 1) / (of_class["allow"] + 1))
    size = of_token["size"] + 1
    odds = F.log((F.col("block") + 1) / F.lit(float(of_token["block"] + size))) - F.log((F.col("allow") + 1) / F.lit(float(of_token["allow"] + size)))
    weights = tokens.select("token", odds.alias("odds"))
    # every run once with its words and their weight, then every url
    scored = join_hot(words.select("kind", "run", "at", "token"), weights, ["token"]).groupBy("kind", "run") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "token", F.coalesce("odds", F.lit(0.0)).alias("odds")))).alias("tokens"))
    scored = materialize(scored.select("kind", "run", F.col("tokens.token").alias("tokens"),
                                       F.aggregate("tokens", F.lit(0.0), lambda s, x: s + x["odds"]).alias("odds")), "scored")
    judged = join_hot(pieces.select("host", "path", "at", "kind", "run"), scored, ["kind", "run"]).groupBy("host", "path") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "tokens", "odds"))).alias("runs"))
    judged = judged.select("host", "path", F.flatten("runs.tokens").alias("words"), F.aggregate("runs", F.lit(0.0), lambda s, x: s + x["odds"]).alias("odds"))
    score = F.lit(prior) + F.coalesce("odds", F.lit(0.0))
    judged = materialize(urls.join(judged, ["host", "path"], "left")
                         .select("host", "path", "rule", "ruled", F.coalesce("words", F.array().cast("array<string>")).alias("words"), score.alias("block_score")), "judged")
    return join_hot(parts, judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("block_score") > 0, "block").otherwise("allow")).alias("verdict"), "words", "block_score")
