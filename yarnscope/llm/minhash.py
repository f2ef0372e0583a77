"""Near-duplicate groups by circulant MinHash, exact Jaccard confirmation.

Signature: a permutation ``sigma`` places every shingle of a document on a
circle of ``CIRCLE`` places; one more permutation ``pi``, shifted by
``0, 1, .., K-1`` places, gives all K coordinates, so a shingle needs one
contiguous slice of ``pi`` and no second hash. ``BANDS x ROWS`` coordinates
make band keys. A pair at similarity 0.8 shares no band with probability
(1 - 0.8**5)**40 = 1e-7.

Work is on classes of equal shingle sets, so copies cost one row each and are
never paired. Inside a bucket every class is confirmed on full sets against
one leader, the class that shares most buckets (a star, not all pairs). What a
star leaves open, members that its leader does not link, is settled exactly
on the differences to the leader: with D the symmetric difference of a member
and the leader, two members reach the similarity only if their D share so many
shingles, so a prefix-filtered join of the rare part of the D finds the few
candidates. No bucket is capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yarnscope.llm.arrays import RangeHash, ascii_lower, byte_table, mix64, text_slices, words_of
from yarnscope.llm.graph import components
from yarnscope.session import materialize

BANDS, ROWS = 40, 5
CIRCLE = 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text of a slice.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased. A
    text of fewer than ``width`` words, but not none, is one shingle.
    """
    data = ascii_lower(data)
    start, end, row = words_of(data, offsets, byte_table(_SPACE))
    n_rows = len(offsets) - 1
    if len(start) == 0:
        return [np.zeros(0, np.uint64)] * n_rows
    word = RangeHash(data).of(start, end)
    bound = np.searchsorted(row, np.arange(n_rows + 1))
    chain = word.copy()
    for k in range(1, width):
        chain[:-k or None] = mix64(chain[:-k or None] * np.uint64(0x100000001B3) + word[k:])
    out = []
    for r in range(n_rows):
        first, last = bound[r], bound[r + 1]
        if last - first >= width:
            out.append(np.unique(chain[first:last - width + 1]))
        elif last > first:
            whole = word[first:first + 1]
            for k in range(first + 1, last):
                whole = mix64(whole * np.uint64(0x100000001B3) + word[k:k + 1])
            out.append(mix64(whole + np.uint64(last - first)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Circulant:
    """Band keys of shingle sets from the two permutations."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows, k = bands, rows, bands * rows
        self.sigma = rng.permutation(CIRCLE).astype(np.int32)
        pi = rng.permutation(CIRCLE).astype(np.int32)
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:k]]), k)
        self.weights = rng.integers(1, 1 << 62, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        place = self.sigma[(shingles >> np.uint64(44)).astype(np.int64)]
        least = None
        for at in range(0, len(place), 2048):
            part = self.windows[place[at:at + 2048]].min(axis=0)
            least = part if least is None else np.minimum(least, part)
        return least

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        weighted = (self.signature(shingles).astype(np.uint64) + np.uint64(1)) * self.weights
        band = weighted.reshape(self.bands, self.rows).sum(axis=1, dtype=np.uint64)
        return mix64(band + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("keys", pa.list_(pa.int64())), ("hash", pa.int64())])


def _sign(width: int):
    def run(batches):
        hashing = Circulant()
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("hash")
            for first, last, data, offsets in text_slices(batch.column("text")):
                digests, counts, keys = [], [], []
                for s in shingle_sets(data, offsets, width):
                    counts.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    keys.append(hashing.keys(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64())),
                     hashes.slice(first, last - first)], schema=_SIGNED)
    return run


def _sets(width: int):
    schema = pa.schema([("digest", pa.binary()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                sets = [s for s in shingle_sets(data, offsets, width) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)
    return run


_STAR_DDL = "a long, b long, linked boolean, n long, gone long, added long, diff array<long>"
_STAR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_()), ("n", pa.int64()), ("gone", pa.int64()),
                   ("added", pa.int64()), ("diff", pa.list_(pa.int64()))])


def _confirm(percent: int):
    """Compares b with its leader a: sizes of a, of a less b, of b less a, and both differences together."""
    def run(batches):
        last, left = None, None
        for batch in batches:
            out = []
            for x, y, s, t in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("set_a"), batch.column("set_b"), strict=True):
                if x != last:
                    last, left = x, np.frombuffer(s.as_buffer(), np.uint64)
                right = np.frombuffer(t.as_buffer(), np.uint64)
                diff = np.setxor1d(left, right, assume_unique=True)
                both = (len(left) + len(right) - len(diff)) // 2
                out.append((x, y, 100 * both >= percent * (len(left) + len(right) - both), len(left), len(left) - both, len(right) - both, diff.view(np.int64)))
                if len(out) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _STAR, strict=True)], schema=_STAR)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _STAR, strict=True)], schema=_STAR)
    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * |intersection| >= percent * |union|`` of
    their sets of ``width``-word shingles. ``component_id`` is the smallest
    doc_id reachable; ``kept`` says that the row is that document.

    Null or empty texts, and texts without words, have no shingles and are
    linked with nothing. Repeated rows are equal sets: one class. Rows without
    doc_id take part; a component without any doc_id has a null
    component_id. Rows that share a doc_id but not the text are documents of
    their own. Further columns of ``docs`` are ignored.
    """
    signed, groups = _groups(docs, width, percent)
    found = groups.join(groups.groupBy("label").agg(F.min("least").alias("component")), "label").select("digest", "component")
    return signed.select("doc_id", "digest", "n_shingles").join(found, "digest", "left") \
        .select("doc_id", "n_shingles",
                F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_rows(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, hash`` of one row of each group, and of every row without words; ``hash`` is that of the text, null as empty.

    The row is that with the least doc_id, one with an id before one without;
    ties, and groups without ids, go by the digest of the shingle set and the hash.
    """
    signed, groups = _groups(docs, width, percent)
    least = F.min(F.struct("first.none", "first.doc_id", "digest", "first.hash")).alias("m")
    return groups.groupBy("label").agg(least).select("m.doc_id", "m.hash") \
        .unionByName(signed.where("digest is null").select("doc_id", "hash"))


def _groups(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and ``digest, least, first, label`` of every class: its least doc_id, its first row, its component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = materialize(docs.mapInArrow(_sign(width), "doc_id long, digest binary, n_shingles long, keys array<long>, hash long"), "signed")
    # a class: rows of equal sets; its node is its least doc_id, or a hash far below any id if it has
    # none, or if rows of that doc_id are in other classes too
    classes = signed.where("digest is not null").groupBy("digest", "n_shingles").agg(
        F.min("doc_id").alias("least"), F.first("keys").alias("keys"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("first"))
    classes = materialize(classes, "classes")
    unclear = classes.where("least is not null").groupBy("least").agg(F.count("*").alias("classes")).where("classes > 1")
    hashed = F.lit(-(1 << 62)) - F.xxhash64("digest").bitwiseAND(F.lit((1 << 61) - 1))
    classes = classes.join(materialize(unclear, "unclear"), "least", "left") \
        .withColumn("node", F.when(F.col("least").isNotNull() & F.col("classes").isNull(), F.col("least")).otherwise(hashed)).drop("classes")
    nodes = classes.select("node", "least", "digest", "first", F.col("n_shingles").alias("size"))

    spread = classes.select(F.explode("keys").alias("key"), "node")
    shared = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(spread.join(shared, "key"), "buckets")
    # the leader of a bucket: the member whose buckets hold most members in all
    weights = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    leaders = buckets.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"))).alias("m")) \
        .select("key", (-F.col("m.minus")).alias("a"))
    pairs = materialize(buckets.join(leaders, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct(), "pairs")
    star = materialize(_star(docs, nodes, pairs, width, percent), "star")
    links = star.where("linked").select("a", "b")
    labels = components(links)
    more = materialize(_rest(star, labels, percent), "links")
    if more.limit(1).count():
        # join the components that the further links connect
        name = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}"))
        between = more.join(name("a"), "a", "left").join(name("b"), "b", "left") \
            .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        joined = components(between).select(F.col("node").alias("label"), F.col("label").alias("to"))
        loose = joined.join(labels.select(F.col("node").alias("label")), "label", "left_anti").select(F.col("label").alias("node"), F.col("to").alias("label"))
        labels = labels.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label")).unionByName(loose)

    return signed, nodes.join(labels, "node", "left").select("digest", "least", "first", F.coalesce("label", "node").alias("label"))


def _star(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Every pair of leader a and member b, compared on full shingle sets."""
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    asked = asked.join(nodes, "node").select("node", "least", "digest")
    # texts by doc_id; classes without one are found among the rows without one
    ids = asked.select(F.col("least").alias("id")).distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["id"]), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(width), "digest binary, shingles binary").join(asked.select("node", "digest"), "digest") \
        .dropDuplicates(["node"]).select("node", "shingles")
    sets = materialize(sets, "sets")
    # the set of b travels with its pair, that of a is sent once
    return pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b") \
        .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a") \
        .select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), _STAR_DDL)


def _rest(star: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links between members of one leader a that are not in one component yet.

    Let n, gone and added be the sizes of a, a less x and x less a, and o the
    shingles that the differences of x and y share. Then x and y reach the
    similarity if ``(100 + percent) * o >= S(x) + S(y) - H`` with
    ``S = 100 * gone + percent * added`` and ``H = (100 - percent) * n``, and
    ``S(x) <= H`` says that a and x do. Shingles rank from the rarest (in the
    leader's group). If the first that x and y share has rank r of d in x,
    then ``o <= d - r + 1``, so ``S(y)`` is at most
    ``(100 + percent) * (d - r + 1) + H - S(x)``, the bound of x at r, and the
    other way round. In two components the larger S is beyond H, and the
    smaller at least ``percent / 100`` of its excess, since o is at most the
    size of either difference. Ranks whose bound admits no such partner go:
    what stays of a difference are its prefixes as the smaller and the larger.
    """
    p, name = percent, labels.withColumnRenamed("node", "b").withColumnRenamed("label", "of_b")
    lead = labels.select(F.col("node").alias("a"), F.col("label").alias("of_a"))
    all_ = star.join(name, "b", "left").join(lead, "a", "left") \
        .withColumn("of_b", F.coalesce("of_b", "b")).withColumn("open", F.col("of_b") != F.coalesce("of_a", "a")).drop("of_a")
    groups = materialize(all_.where("open").select("a").distinct(), "open")
    # a member with no difference is the leader's equal, which is no other class
    score, high = 100 * F.col("gone") + p * F.col("added"), (100 - p) * F.col("n")
    members = materialize(all_.join(groups, "a", "left_semi").select("a", "b", "of_b", "n", score.alias("score"), "diff"), "members")
    tokens = members.select("a", "b", "of_b", "score", high.alias("high"), F.size("diff").alias("size"), F.explode("diff").alias("token"))
    frequency = tokens.groupBy("a", "token").agg(F.count("*").alias("df"))
    ranked = tokens.join(frequency, ["a", "token"]).withColumn("rank", F.row_number().over(Window.partitionBy("a", "b").orderBy("df", "token"))) \
        .withColumn("bound", (100 + p) * (F.col("size") - F.col("rank") + 1) + F.col("high") - F.col("score")) \
        .select("a", "b", "of_b", "token", "score", "bound", (F.col("bound") >= F.greatest("score", F.col("high") + 1)).alias("smaller"),
                ((F.col("score") > F.col("high")) & (100 * F.col("bound") >= p * (F.col("score") - F.col("high")))).alias("larger")).where("smaller or larger")
    ranked = materialize(ranked, "prefixes")
    # shingles of one component alone make no pair
    mixed = ranked.groupBy("a", "token").agg(F.min("of_b").alias("low"), F.max("of_b").alias("top")).where("low < top").select("a", "token")
    mixed = materialize(ranked.join(mixed, ["a", "token"]), "mixed")
    smaller = mixed.where("smaller").select("a", "token", F.col("b").alias("x"), F.col("of_b").alias("of_x"), F.col("score").alias("s_x"), F.col("bound").alias("t_x"))
    larger = mixed.where("larger").select("a", "token", F.col("b").alias("y"), F.col("of_b").alias("of_y"), F.col("score").alias("s_y"), F.col("bound").alias("t_y"))
    # components meet first, at each shingle, so that members of one component are not paired with each other
    meet = smaller.groupBy("a", "token", "of_x").agg(F.min("s_x").alias("least_x"), F.max("t_x").alias("to_x")) \
        .join(larger.groupBy("a", "token", "of_y").agg(F.min("s_y").alias("least_y"), F.max("s_y").alias("most_y"), F.max("t_y").alias("to_y")), ["a", "token"]) \
        .where("of_x <> of_y and least_x <= most_y and least_x <= to_y and least_y <= to_x") \
        .select("a", "token", "of_x", "of_y", "least_y", "most_y", "to_y")
    found = smaller.join(materialize(meet, "meet"), ["a", "token", "of_x"]).where("s_x <= most_y and s_x <= to_y and least_y <= t_x") \
        .select("a", "token", "of_y", "x", "s_x", "t_x") \
        .join(larger, ["a", "token", "of_y"]).where("s_x <= t_y and s_y <= t_x and (s_x < s_y or s_x = s_y and x < y)").select("a", "x", "y").distinct()
    side = lambda c: members.select("a", F.col("b").alias(c), F.col("n").alias(f"n_{c}"), F.col("score").alias(f"s_{c}"), F.col("diff").alias(f"d_{c}"))
    both = found.join(side("x"), ["a", "x"]).join(side("y"), ["a", "y"])
    return both.where(f"{100 + p} * size(array_intersect(d_x, d_y)) >= s_x + s_y - {100 - p} * n_x") \
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
