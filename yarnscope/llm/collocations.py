"""Phrase collocations: counts of one to three words as sorted streams, merged in lockstep.

The layout of external stream estimation. Every task turns its texts into
sorted runs of distinct phrases with their counts, one stream for each order.
Runs are dealt out by phrase, so that a frequent phrase arrives once from each
run, and merged by sorting; counts below the least one leave here. What stays
is kept in two orders: sorted from the first word on (prefix order) and from
the last word on (suffix order). Sort-merge joins walk two streams at a time:
pairs with their left and right word, triples with the pair that they begin
with and the one that they end with. The same walks give each pair its most
frequent extension to either side. No join builds a hash table.

Memory: a run holds RUN_BYTES of text, a group of the merge about BUCKET_BYTES
of it, whatever the size of the corpus. A text is never cut; a longer one is a
run of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yarnscope.llm.arrays import RangeHash, ascii_lower, mix64, text_slices, words_of
from yarnscope.session import materialize

#: Bytes of text that a task turns into one run, and of text whose phrases of one order one group merges.
RUN_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Least number of occurrences of a candidate; share (percent) of it that a longer candidate must reach to replace it.
LEAST, SHARE = 10, 50
#: Collocations reported for each language.
TOP = 2000
#: Parts that a language's candidates are ranked in before their best are ranked together.
PARTS = 64

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BLANKS = b" \t"
_BLOCKS = pa.schema([("bucket", pa.int64()), ("k", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("bytes", pa.int64()),
                     ("sizes", pa.binary()), ("phrases", pa.binary()), ("counts", pa.binary())])
_COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values).tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes, size: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), kind) if size else np.zeros(0, kind)


def _view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_binary array without gaps, and its offsets in them."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, their counts and the place of every key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    return ordered[starts], np.diff(np.append(starts, len(keys))), place


def phrase_runs(data: np.ndarray, offsets: np.ndarray):
    """``(k, phrases, counts, places)`` for k = 1, 2, 3: the distinct phrases of the texts in word order.

    ``places`` are 64-bit numbers made of the words alone, by which phrases are dealt out.
    """
    data = ascii_lower(data)
    inside = np.ones(256, bool)
    inside[list(_BREAKS + _BLANKS)] = False
    start, end, row = words_of(data, offsets, inside)
    if len(start) == 0:
        return
    broken = np.zeros(256, np.int8)
    broken[list(_BREAKS)] = 1
    piece = np.cumsum(broken[data], dtype=np.int64 if len(data) >> 31 else np.int32)[start]
    joined = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    coded = _binary(data[inside[data]], end - start).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    words = coded.dictionary.take(order)
    rank = np.empty(len(words), np.int64)
    rank[order.to_numpy()] = np.arange(len(words))
    word = rank[coded.indices.to_numpy()]
    raw, bounds = _view(words)
    place = RangeHash(raw).of(bounds[:-1], bounds[1:])
    yield 1, words, np.bincount(word, minlength=len(words)), place
    at = np.flatnonzero(joined)
    if len(at) == 0:
        return
    pairs, counts, pair = _distinct((word[at] << 32) | word[at + 1])
    both = pc.binary_join_element_wise(words.take(pa.array(pairs >> 32)), words.take(pa.array(pairs & 0xFFFFFFFF)), pa.scalar(b" ", pa.large_binary()))
    both_place = mix64(place[pairs >> 32] * _MULT + place[pairs & 0xFFFFFFFF])
    yield 2, both, counts, both_place
    # pairs that the next word of the piece follows: place of the pair, then that word
    third = np.zeros(len(word), bool)
    third[at] = True
    third = third[at + 1]
    if third.any():
        triples, counts, _ = _distinct((pair[third] << 32) | word[at[third] + 2])
        yield 3, pc.binary_join_element_wise(both.take(pa.array(triples >> 32)), words.take(pa.array(triples & 0xFFFFFFFF)), pa.scalar(b" ", pa.large_binary())), counts, \
            mix64(both_place[triples >> 32] * _MULT + place[triples & 0xFFFFFFFF])


def _runs(buckets: int):
    def blocks(lang: str, texts: list):
        for _, _, data, offsets in text_slices(pa.concat_arrays(texts), 1 << 62):
            for k, phrases, counts, places in phrase_runs(data, offsets):
                bucket = (places % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")  # inside a bucket phrases stay sorted
                phrases, counts, bucket = phrases.take(pa.array(order)), counts[order].astype(np.int64), bucket[order]
                raw, bounds = _view(phrases)
                cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
                rows = [[] for _ in _BLOCKS]
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    part = raw[bounds[a]:bounds[b]]
                    for values, value in zip(rows, (int(bucket[a]) * 4 + k, k, lang, b - a, len(part), _pack(np.diff(bounds[a:b + 1])), _pack(part), _pack(counts[a:b]))):
                        values.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, _BLOCKS)], schema=_BLOCKS)

    def run(batches):
        held, size = {}, {}
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column("text").filter(pc.equal(langs, lang)).cast(pa.large_string())
                for first, last, data, offsets in text_slices(texts, RUN_BYTES):
                    if size.get(lang, 0) + len(data) > RUN_BYTES and held.get(lang):
                        yield from blocks(lang, held.pop(lang))
                        size[lang] = 0
                    held.setdefault(lang, []).append(texts.slice(first, last - first))
                    size[lang] = size.get(lang, 0) + len(data)
            if sum(size.values()) > 4 * RUN_BYTES:  # many languages: the longest run leaves first
                lang = max(size, key=size.get)
                yield from blocks(lang, held.pop(lang))
                del size[lang]
        for lang in list(held):
            yield from blocks(lang, held.pop(lang))
    return run


def _merge(least: int):
    def run(table: pa.Table) -> pa.Table:
        k = table.column("k")[0].as_py()
        out = []
        for lang in sorted(pc.unique(table.column("lang")).to_pylist()):
            rows = table.filter(pc.equal(table.column("lang"), lang)).to_pylist()
            phrases = pa.concat_arrays([_binary(_unpack(r["phrases"], r["bytes"], np.uint8), _unpack(r["sizes"], 8 * r["n"], np.int64)) for r in rows])
            counts = np.concatenate([_unpack(r["counts"], 8 * r["n"], np.int64) for r in rows])
            total = int(counts.sum())
            order = pc.sort_indices(phrases)
            phrases, counts = phrases.take(order), counts[order.to_numpy()]
            first = np.flatnonzero(np.append(True, pc.not_equal(phrases[1:], phrases[:-1]).to_numpy(zero_copy_only=False)))
            f = np.add.reduceat(counts, first)
            keep = f >= least
            out.append(pa.table([pa.array([lang] * int(keep.sum()), pa.string()), pa.array([k] * int(keep.sum()), pa.int32()),
                                 phrases.take(pa.array(first[keep])).cast(pa.large_string()).cast(pa.string()), pa.array(f[keep], pa.int64())], schema=_COUNTED))
            if k == 1:
                out.append(pa.table([[lang], pa.array([0], pa.int32()), pa.array([None], pa.string()), [total]], schema=_COUNTED))
        return pa.concat_tables(out)
    return run


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, k, phrase, f``: phrases of k = 1 to 3 words with at least ``least`` occurrences; rows of k = 0 sum to all words of ``lang``."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    runs = texts.mapInArrow(_runs(size // BUCKET_BYTES + 1), "bucket long, k int, lang string, n long, bytes long, sizes binary, phrases binary, counts binary")
    return runs.groupBy("bucket").applyInArrow(_merge(least), "lang string, k int, phrase string, f long")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two and three words of ``docs(text, lang)``.

    A-Z are lower-cased; pieces end at ``[.,;:!?]`` and line ends, words at
    blanks and tabs. Candidates occur ``least`` times; one whose words lie
    inside a longer candidate with at least ``share`` percent of its count is
    dropped. Numbers are exact (decimal products), equal scores go by count,
    then by phrase in byte order.

    Null and empty texts have no words; a null lang is ``und``. Repeated rows
    count as often as they occur, an empty table gives no rows, further columns
    are ignored.
    """
    streams = materialize(phrase_counts(docs, least), "streams").withColumn("w", F.split("phrase", " "))

    def order(k: int, *names: str) -> DataFrame:
        return streams.where(F.col("k") == k).select("lang", *[F.col("w")[i].alias(c) for i, c in enumerate(names)], F.col("f").alias(f"f_{''.join(names)}")).hint("merge")

    sizes = streams.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    pairs = order(2, "x", "y").join(order(1, "x"), ["lang", "x"]).join(order(1, "y"), ["lang", "y"])
    pairs = materialize(pairs, "pairs")
    triples = order(3, "x", "y", "z")
    # prefix order: the pair that a triple begins with, and that pair's most frequent triple
    begun = triples.join(pairs.hint("merge").select("lang", "x", "y", "f_xy", "f_x"), ["lang", "x", "y"])
    longer = triples.groupBy("lang", "x", "y").agg(F.max("f_xyz").alias("right"))
    # suffix order: the pair that it ends with
    ended = begun.join(pairs.hint("merge").select("lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("f_xy").alias("f_yz"), F.col("f_y").alias("f_z")), ["lang", "y", "z"])
    after = triples.groupBy("lang", F.col("y").alias("x"), F.col("z").alias("y")).agg(F.max("f_xyz").alias("left"))
    score = lambda l, r: F.expr(f"cast((1000000BD * cast(a as decimal(19,0)) * a) div (cast({l} as decimal(19,0)) * {r}) as long)")  # noqa: E731,E741
    two = pairs.hint("merge").join(longer.hint("merge"), ["lang", "x", "y"], "left").join(after.hint("merge"), ["lang", "x", "y"], "left") \
        .where(100 * F.greatest(F.coalesce("right", F.lit(0)), F.coalesce("left", F.lit(0))) < share * F.col("f_xy")) \
        .select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), F.col("f_xy").alias("a"), F.col("f_x").alias("l"), F.col("f_y").alias("r")).withColumn("score", score("l", "r"))
    three = ended.select("lang", F.concat_ws(" ", "x", "y", "z").alias("phrase"), F.col("f_xyz").alias("a"), "f_x", "f_yz", "f_xy", "f_z") \
        .withColumn("s1", score("f_x", "f_yz")).withColumn("s2", score("f_xy", "f_z"))
    first = F.col("s1") <= F.col("s2")
    three = three.select("lang", "phrase", "a", F.when(first, F.col("f_x")).otherwise(F.col("f_xy")).alias("l"),
                         F.when(first, F.col("f_yz")).otherwise(F.col("f_z")).alias("r"), F.least("s1", "s2").alias("score"))
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(sizes), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
