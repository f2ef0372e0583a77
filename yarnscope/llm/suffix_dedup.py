"""Removal of repeated byte strings with suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
somewhere else in the corpus. The steps, all keyed and shuffled by Spark:

1. Sharding. In every text each window of LENGTH bytes names one anchor: the
   least hashed GRAM-byte string inside it. Equal windows name equal anchors,
   so all windows that can match meet under one anchor. A run of windows with
   the same anchor is a region, about one per 90 bytes.
2. Regions whose anchor occurs once can hold no repeat. Regions that occur
   twice with the same content are removed whole; no text moves for them.
3. What is left, one copy of each distinct region that shares its anchor with
   another one, is cut out of its text and dealt by anchor to shards of about
   SHARD_BYTES. Each shard builds its suffix array (Larsson-Sadakane: ranks of
   doubled prefixes, only groups not yet sorted are refined) and the common
   prefixes of neighbours (Kasai); windows with a neighbour at LENGTH or more
   are repeats.
4. An anchor with more than HOT distinct regions is dealt to several shards;
   these are merged by binary search of each shard's sorted windows (as
   128-bit digests) in those of the others.

The size of a task is bounded by SHARD_BYTES or HOT regions, whatever the
frequency of a passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yarnscope.llm.arrays import RangeHash, text_slices
from yarnscope.session import materialize

LENGTH = 200
GRAM = 24
SHARD_BYTES = 2 << 20
HOT = 4096

_RAW = pa.schema([("doc_id", pa.int64()), ("check", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                  ("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int64())])
_RAW_DDL = "doc_id long, check long, start long, size long, anchor long, content long, n long"


# ---------------------------------------------------------------- regions


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Regions of a slice: ``row, start, size, anchor, content`` (starts within the slice)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashing = RangeHash(data)
    at = np.arange(n - gram + 1, dtype=np.int64)
    grams = hashing.of(at, at + gram)
    # least (hash, place) of every window, by doubling
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    span, want = 1, length - gram + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < want:
        shift = want - span
        least = np.minimum(least[:-shift], least[shift:])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = row[:len(place)] == row[length - 1:length - 1 + len(place)]  # the window lies in one text
    start = np.flatnonzero(whole)
    place = place[start]
    if len(start) == 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin, end, place = start[first], start[last] + length, place[first]
    content = hashing.of(begin, end) + (place - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return row[begin], begin, end - begin, grams[place], content


def _regions(length: int, gram: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False) if not batch.column("doc_id").null_count else None
            checks = batch.column("check").to_numpy(zero_copy_only=False)
            for first, _, data, offsets in text_slices(batch.column("text"), 1 << 20):
                row, begin, size, anchor, content = window_anchors(data, offsets, length, gram)
                if len(row) == 0:
                    continue
                # equal regions inside the slice: one row with its count, and the removed spans of all of them
                order = np.lexsort((content, anchor))
                a, c = anchor[order], content[order]
                new = np.ones(len(order), bool)
                new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                group = np.cumsum(new) - 1
                count = np.bincount(group)
                pick = order[new]
                again = np.sort(order[count[group] > 1])
                s_row, s_from, s_size = _runs(row[again], begin[again], begin[again] + size[again])
                k, m = len(pick), len(s_row)
                rows = np.concatenate([row[pick], s_row])
                out_ids = pa.array(ids[first + rows]) if ids is not None else batch.column("doc_id").take(pa.array(first + rows))
                empty = np.zeros(m, np.int64)
                drop = np.concatenate([np.zeros(k, bool), np.ones(m, bool)])
                starts = np.concatenate([begin[pick], s_from]) - offsets[rows]
                yield pa.RecordBatch.from_arrays([
                    out_ids.cast(pa.int64()), pa.array(checks[first + rows], pa.int64()), pa.array(starts),
                    pa.array(np.concatenate([size[pick], s_size])),
                    pa.array(np.concatenate([anchor[pick].view(np.int64), empty]), mask=drop),
                    pa.array(np.concatenate([content[pick].view(np.int64), empty]), mask=drop),
                    pa.array(np.concatenate([count, empty]), mask=drop)], schema=_RAW)
    return run


def _runs(row: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Merge touching ranges, given in order of row and begin: ``row, begin, size``."""
    if len(row) == 0:
        return row, begin, begin
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (begin[1:] > np.maximum.accumulate(end)[:-1])
    first = np.flatnonzero(new)
    stop = np.maximum.reduceat(end, first)
    return row[first], begin[first], stop - begin[first]


# ---------------------------------------------------------------- suffix array of one shard


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Larsson-Sadakane refinement: the suffix array, and eight packed bytes from every place."""
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed |= padded[k:k + n] << np.uint64(56 - 8 * k)
    # zero padding ties with real zero bytes; the missing length decides, as a shorter suffix comes first
    short = np.minimum(n - np.arange(n), 8)
    order = np.lexsort((short, packed)) if n and (data == 0).any() else np.argsort(packed, kind="stable")
    key, tail = packed[order], short[order]
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (tail[1:] != tail[:-1])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    starts = np.flatnonzero(new)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    sizes = np.diff(np.append(starts, n))
    starts, sizes = starts[sizes > 1], sizes[sizes > 1]
    h = 8
    while len(starts):  # only members of groups that are not sorted yet
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        slots = np.repeat(starts - base, sizes) + np.arange(sizes.sum())
        place = order[slots]
        ahead = rank[np.minimum(place + h, n)]
        group = np.repeat(starts, sizes)
        by = np.argsort(group * np.int64(n + 1) + ahead + 1, kind="stable")
        place, ahead = place[by], ahead[by]
        order[slots] = place
        new = np.ones(len(by), bool)
        new[1:] = (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(by)))
        starts = slots[heads]
        rank[place] = np.repeat(starts, sizes)
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        h *= 2
    return order, packed


def common_prefixes(order: np.ndarray, packed: np.ndarray, cap: int, lanes: int = 64) -> np.ndarray:
    """Kasai: common prefix (at most ``cap``) of every place with its predecessor in ``order``.

    The text is cut into stretches of ``lanes`` places and all stretches advance
    together: a place starts from the prefix of the place before it, less one.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    found = np.zeros(n, np.int64)
    heads = np.arange(0, n, lanes)
    known = np.zeros(len(heads), np.int64)
    for t in range(lanes):
        place = heads + t
        live = place < n
        place, known = place[live], known[live]
        heads = heads[live]
        other = before[place]
        have = np.where(other >= 0, np.maximum(known - 1, 0), 0)
        work = np.flatnonzero((other >= 0) & (have < cap))
        while len(work):
            p, q = place[work] + have[work], other[work] + have[work]
            room = np.minimum(n - np.maximum(p, q), cap - have[work])
            inside = room > 0
            work, p, q, room = work[inside], p[inside], q[inside], room[inside]
            if len(work) == 0:
                break
            x = packed[p] ^ packed[q]
            same = sum(((x < np.uint64(1) << np.uint64(8 * k)).astype(np.int64) for k in range(8)), np.zeros(len(x), np.int64))
            grown = np.minimum(same, room)
            have[work] += grown
            work = work[(grown == 8) & (have[work] < cap)]
        found[place] = have
        known = have
    return found


def repeated_windows(texts: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the first ``windows[k]`` places of every text k: place in the joined texts, text, and the group of equal windows."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    order, packed = suffix_array(data)
    prefix = common_prefixes(order, packed, length)
    group = np.empty(len(data), np.int64)
    group[order] = np.cumsum(prefix[order] < length)
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    return place, text, group[base[text] + place]


_FOUND = pa.schema([("doc_id", pa.int64()), ("check", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                    ("low", pa.int64()), ("high", pa.int64())])
_FOUND_DDL = "doc_id long, check long, start long, size long, low long, high long"


def _search(length: int):
    """One shard: removed spans of its regions; for a split anchor also a digest of each of its distinct windows that are not known as repeats."""
    def run(table: pa.Table) -> pa.Table:
        texts = [x.as_buffer().to_pybytes() for x in table.column("bytes").combine_chunks()]
        split = table.column("split")[0].as_py()
        single = table.column("single").to_numpy()
        begin = table.column("start").to_numpy()
        windows = np.array([len(t) for t in texts], np.int64) - length + 1
        place, text, group = repeated_windows(texts, windows, length)
        count = np.bincount(group)
        hit = count[group] > 1
        ask = np.flatnonzero(hit & single[text])
        s_text, s_from, s_size = _runs(text[ask], place[ask], place[ask] + length)
        cols = [s_text, begin[s_text] + s_from, s_size]
        low = high = np.zeros(0, np.int64)
        if split:
            _, one = np.unique(group, return_index=True)  # the shard's distinct windows, in suffix order
            digests = np.frombuffer(b"".join(hashlib.blake2b(texts[t][p:p + length], digest_size=16).digest()
                                             for t, p in zip(text[one], place[one], strict=True)), np.int64).reshape(-1, 2)
            low, high = digests[:, 0], digests[:, 1]
            # size 0 marks a window that needs no answer: known as a repeat, or of a region that is removed whole
            sizes = np.where(hit[one] | ~single[text[one]], 0, length)
            cols = [np.concatenate(x) for x in zip(cols, (text[one], begin[text[one]] + place[one], sizes), strict=True)]
        drop = np.concatenate([np.ones(len(s_text), bool), np.zeros(len(low), bool)])
        pad = np.zeros(len(s_text), np.int64)
        take = pa.array(cols[0])
        return pa.Table.from_arrays([
            table.column("doc_id").take(take), table.column("check").take(take), pa.array(cols[1]), pa.array(cols[2]),
            pa.array(np.concatenate([pad, low]), mask=drop), pa.array(np.concatenate([pad, high]), mask=drop)], schema=_FOUND)
    return run


def _merge(table: pa.Table) -> pa.Table:
    """Windows of split anchors from all shards, for one range of digests: those found in another shard."""
    low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
    pairs = np.empty(len(low), dtype=[("low", np.int64), ("high", np.int64)])
    pairs["low"], pairs["high"] = low, high
    ordered = np.sort(pairs, order=("low", "high"))
    # binary search by the first half, then by the second among equals
    left = np.searchsorted(ordered["low"], low, "left")
    right = np.searchsorted(ordered["low"], low, "right")
    twice = right - left > 1
    keep = np.zeros(len(low), bool)
    for k in np.flatnonzero(twice):
        part = ordered["high"][left[k]:right[k]]
        keep[k] = np.searchsorted(part, high[k], "right") - np.searchsorted(part, high[k], "left") > 1
    keep &= table.column("size").to_numpy() > 0
    return table.filter(pa.array(keep)).select(["doc_id", "check", "start", "size"])


# ---------------------------------------------------------------- text in, text out


def _cut(batches):
    """Bytes of the asked regions of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("check", pa.int64()), ("start", pa.int64()), ("single", pa.bool_()),
                        ("shard", pa.int64()), ("split", pa.bool_()), ("bytes", pa.binary())])
    for batch in batches:
        ids, checks, asked = batch.column("doc_id"), batch.column("check"), batch.column("asked")
        for first, last, data, offsets in text_slices(batch.column("text"), 1 << 20):
            owner, rows = [], []
            for r in range(first, last):
                for x in asked[r].as_py():
                    at = offsets[r - first] + x["start"]
                    owner.append(r)
                    rows.append((x["start"], x["single"], x["shard"], x["split"], data[at:at + x["size"]].tobytes()))
            take = pa.array(owner, pa.int64())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), checks.take(take), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[2:], strict=True))], schema=schema)


def _remove(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for batch in batches:
        ids, spans = batch.column("doc_id"), batch.column("spans")
        for first, last, data, offsets in text_slices(batch.column("text"), 1 << 20):
            out = []
            for r in range(first, last):
                text = data[offsets[r - first]:offsets[r - first + 1]]
                ranges = spans[r].values
                if ranges is None or len(ranges) == 0:
                    out.append((len(text), 0, 0, text.tobytes()))
                    continue
                begin = ranges.field("start").to_numpy()
                step = np.zeros(len(text) + 1, np.int64)
                np.add.at(step, begin, 1)
                np.add.at(step, begin + ranges.field("size").to_numpy(), -1)
                gone = np.cumsum(step[:-1]) > 0
                runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                out.append((len(text), int(gone.sum()), runs, text[~gone].tobytes()))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True))], schema=schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept``.

    ``kept`` holds the bytes that remain, in order. Texts are judged as UTF-8
    bytes on the input, matches never cross texts, overlapping matches count.

    A null text is empty; texts shorter than ``length`` lose nothing. Repeated
    rows repeat each other, so both lose what is long enough. A null doc_id is
    an id like any other. Further columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("check", F.xxhash64("text"))
    raw = materialize(docs.select("doc_id", "check", "text").mapInArrow(_regions(length, gram), _RAW_DDL), "regions")
    regions = raw.where("anchor is not null")
    spans = [raw.where("anchor is null").select("doc_id", "check", "start", "size")]

    shared = regions.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    regions = materialize(regions.join(shared, "anchor"), "shared")
    contents = regions.groupBy("anchor", "content").agg(
        F.sum("n").alias("total"), F.min(F.struct("doc_id", "check", "start", "size")).alias("one"))
    contents = materialize(contents, "contents")
    # found twice with the same content: removed whole
    spans.append(regions.where("n = 1").join(contents.where("total > 1").select("anchor", "content"), ["anchor", "content"])
                 .select("doc_id", "check", "start", "size"))

    # one copy of each content whose anchor has others
    many = contents.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    asked = materialize(contents.join(many, "anchor").select("anchor", "content", "one.*", F.expr("total = 1").alias("single"), "kinds"), "asked")
    total = asked.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    split = F.col("kinds") > hot
    salt = F.pmod(F.xxhash64("content"), F.ceil(F.col("kinds") / hot))
    asked = asked.withColumn("split", split).withColumn(
        "shard", F.when(split, shards + F.pmod(F.xxhash64("anchor", salt), F.lit(1 << 60))).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards))))
    lists = asked.groupBy("doc_id", "check").agg(F.collect_list(F.struct("start", "size", "single", "shard", "split")).alias("asked"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["check"] == b["check"])
    cut = docs.join(lists, same(docs, lists)).select(docs["doc_id"], docs["check"], "text", "asked") \
        .mapInArrow(_cut, "doc_id long, check long, start long, single boolean, shard long, split boolean, bytes binary")
    found = materialize(cut.groupBy("shard").applyInArrow(_search(length), _FOUND_DDL), "found")
    spans.append(found.where("low is null").select("doc_id", "check", "start", "size"))
    digests = found.where("low is not null")
    parts = max(1, digests.count() // 200_000)
    spans.append(digests.groupBy(F.pmod(F.col("low"), F.lit(parts))).applyInArrow(_merge, "doc_id long, check long, start long, size long"))

    gone = spans[0]
    for more in spans[1:]:
        gone = gone.unionByName(more)
    # rows that share id and text share their spans: each is kept once
    gone = gone.groupBy("doc_id", "check").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    return docs.join(gone, same(docs, gone), "left").select(docs["doc_id"], "text", "spans") \
        .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
