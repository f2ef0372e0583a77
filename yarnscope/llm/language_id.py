"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities of the pieces of a fixed public vocabulary.
A word's probability in a language is the sum over all its segmentations into
pieces, by the forward algorithm; a text's is the product over its words.
The piece probabilities are fitted by expectation-maximisation on a bounded
sample of labelled texts (SAMPLE distinct texts a language, chosen by their
hash, whose words are learned in parts of at most LEARNED_BYTES bytes); every
text is scored whole, every word over all its segmentations.

Words are runs of ASCII letters (A-Z lower-cased) and bytes beyond ASCII,
preceded by a blank. Spark deals out the texts; numpy scores the distinct
words of a slice of texts at once. The forward sums of a word reach back as far
as the longest piece, so a word of any length needs no more memory.
"""

from __future__ import annotations

import base64
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yarnscope.llm.arrays import RangeHash, ascii_lower, text_slices, words_of
from yarnscope.session import materialize

#: Distinct labelled texts of a language that are learned from.
SAMPLE = 1500
#: Longest part of a word that is learned from at once, in bytes (scoring cuts no word).
LEARNED_BYTES = 1024
ROUNDS = 4
#: Bytes of words whose lattice is held at once while learning, and numbers of forward sums while scoring.
LATTICE_BYTES, STATE = 1 << 20, 2_000_000
#: Forward sums are scaled to TOP every RESCALE bytes of a word.
TOP, RESCALE = 1e250, 16
#: Distinct words whose scores a task remembers from one slice to the next.
REMEMBERED = 200_000

_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = True
_LETTERS[128:] = True


def load_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 piece, rank) that can lie in a word: letters, lower case, and all single bytes."""
    with open(path, "rb") as f:
        ranked = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    keep = [p for p in ranked if p == p.lower() and _spoken(p)]
    return sorted(set(keep) | {bytes([b]) for b in range(256)})


def _spoken(piece: bytes) -> bool:
    body = piece[1:] if piece[:1] == b" " else piece
    return len(body) > 0 and all(_LETTERS[b] for b in body)


class Lattice:
    """Finds the pieces that are substrings of words."""

    def __init__(self, pieces: list[bytes]):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        bounds = np.cumsum([0, *map(len, pieces)])
        self.keys = RangeHash(data).of(bounds[:-1], bounds[1:])
        self.n = len(pieces)
        self.sizes = np.unique([len(p) for p in pieces])
        # two tables: a piece is in the first unless its slot is taken there
        self.bits = np.uint64(44)
        self.tables = []
        rest = np.arange(self.n)
        while len(rest):
            slot = self._slot(self.keys[rest], len(self.tables))
            table = np.full(1 << 20, self.n, np.int32)
            table[slot[::-1]] = rest[::-1]
            self.tables.append(table)
            rest = rest[table[slot] != rest]
        self.keys = np.append(self.keys, np.uint64(0))

    def _slot(self, keys: np.ndarray, k: int) -> np.ndarray:
        return ((keys * np.uint64(2 * k + 0x9E3779B97F4A7C15)) >> self.bits).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of every substring hash, or ``n`` if it is none."""
        out = np.full(len(keys), self.n, np.int32)
        for k, table in enumerate(self.tables):
            piece = table[self._slot(keys, k)]
            hit = (piece < self.n) & (self.keys[piece] == keys)
            out[hit] = piece[hit]
        return out

    def forward(self, words: list[bytes], table: np.ndarray) -> np.ndarray:
        """log probability of every word in every language; ``table`` is pieces + 1 (a zero row) x languages."""
        size = np.array([len(w) for w in words], np.int64)
        order = np.argsort(-size, kind="stable")
        out = np.empty((len(words), table.shape[1]))
        at_once = max(1, STATE // ((int(self.sizes[-1]) + 1) * table.shape[1]))
        for begin in range(0, len(order), at_once):
            index = order[begin:begin + at_once]
            out[index] = self._forward([words[i] for i in index], size[index], table)
        return out

    def _forward(self, words: list[bytes], size: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The same for words in falling order of their sizes, byte by byte of all words.

        ``ring`` keeps the forward sums of the last bytes, as many as the longest piece has.
        """
        hashing = RangeHash(np.frombuffer(b"".join(words), np.uint8))
        start = np.cumsum(size) - size
        slots = int(self.sizes[-1]) + 1
        ring = np.zeros((len(words), slots, table.shape[1]))
        ring[:, 0] = TOP
        shift = np.zeros((len(words), table.shape[1]))
        out = np.zeros_like(shift) - np.log(TOP)
        reach = lambda end: int(np.searchsorted(-size, -end, side="right"))  # noqa: E731, words of at least ``end`` bytes
        done = scaled = 0
        while n := reach(done + 1):
            # a few long words: several bytes at once
            block = max(1, min(RESCALE - (done - scaled), 4096 // n, int(size[0]) - done))
            ends = np.arange(done + 1, done + block + 1)
            sizes = self.sizes[:np.searchsorted(self.sizes, done + block, side="right")]
            stop = (start[:n, None] + np.minimum(ends, size[:n, None]))[:, :, None]
            # ends before the start of a word have a sum of 0 in the ring, whatever is found there
            piece = self.find(hashing.of(np.maximum(stop - sizes, start[:n, None, None]), stop).ravel()).reshape(n, block, len(sizes))
            for j, end in enumerate(ends.tolist()):
                m, longer = reach(end), reach(end + 1)
                ring[:m, end % slots] = np.einsum("wkl,wkl->wl", ring[:m, (end - sizes) % slots], table[piece[:m, j]])
                out[longer:m] += np.log(ring[longer:m, end % slots]) + shift[longer:m]
            done += block
            if done - scaled >= RESCALE:
                m, scaled = reach(done + 1), done
                top = ring[:m].max(axis=1)
                ring[:m] *= (TOP / top)[:, None]
                shift[:m] += np.log(top / TOP)
        return out

    def places(self, words: list[bytes]):
        """Where pieces lie in words: node before and after each, position there, piece; and first and last node of the words."""
        size = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(size) - size
        hashing = RangeHash(np.frombuffer(b"".join(words), np.uint8))
        word = np.repeat(np.arange(len(words)), size)
        left = (start + size)[word] - np.arange(len(word))
        found = []
        for k in self.sizes.tolist():
            at = np.flatnonzero(left >= k)
            piece = self.find(hashing.of(at, at + k))
            hit = piece < self.n
            at, piece = at[hit], piece[hit]
            node = at + word[at]
            found.append(np.array([node, node + k, at - start[word[at]], at - start[word[at]] + k, piece, word[at]]))
        first = start + np.arange(len(words))
        return np.concatenate(found, axis=1), first, first + size

    def fit(self, words: list[bytes], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
        """Piece probabilities of one language by expectation-maximisation."""
        p = np.full(self.n + 1, 1.0 / self.n)
        p[self.n] = 0
        chunk = np.cumsum([len(w) for w in words]) // LATTICE_BYTES if words else np.zeros(0, np.int64)
        bounds = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(words)] if words else [0]
        for _ in range(rounds):
            expected = np.zeros(self.n + 1)
            for a, b in itertools.pairwise(bounds):
                expected += self._expected(words[a:b], counts[a:b], p[:self.n])
            p = expected + 0.01  # pieces that were not seen keep a little
            p[self.n] = 0
            p /= p.sum()
        return p

    def _expected(self, words: list[bytes], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces: forward and backward sums, as logarithms."""
        (before, after, begin, end, piece, word), first, last = self.places(words)
        weight = np.log(p)[piece]
        forward, backward = np.zeros(last[-1] + 1), np.zeros(last[-1] + 1)
        backward[last] = np.log(counts)
        _accumulate(forward, before, after, end, weight)
        _accumulate(backward, after, before, -begin, weight)
        share = np.exp(forward[before] + weight + backward[after] - forward[last[word]])
        return np.bincount(piece, share, self.n + 1)


def _accumulate(total: np.ndarray, source: np.ndarray, target: np.ndarray, step: np.ndarray, weight: np.ndarray) -> None:
    """Log sums over the edges into every target, in the order of ``step``; sources are of earlier steps."""
    if not len(step):
        return
    order = np.lexsort((target, step))
    source, target, step, weight = source[order], target[order], step[order], weight[order]
    heads = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
    cuts = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
    head_cuts = np.searchsorted(heads, cuts)
    for a, b, c, d in zip(cuts, [*cuts[1:], len(step)], head_cuts, [*head_cuts[1:], len(heads)], strict=True):
        value, head = total[source[a:b]] + weight[a:b], heads[c:d] - a
        top = np.maximum.reduceat(value, head)
        value = np.exp(value - np.repeat(top, np.diff(np.append(head, b - a))))
        total[target[heads[c:d]]] = top + np.log(np.add.reduceat(value, head))


def slice_words(data: np.ndarray, offsets: np.ndarray):
    """Words of a slice of texts: lower-cased bytes, hash, row, start and end."""
    data = ascii_lower(data)
    start, end, row = words_of(data, offsets, _LETTERS)
    keys = RangeHash(data).of(start, end) if len(start) else np.zeros(0, np.uint64)
    return data, keys, row, start, end


def _count_words(batches):
    """Word counts of every language in a batch."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for begin, last, text, offsets in text_slices(batch.column("text")):
            data, keys, row, start, end = slice_words(text, offsets)
            names = sorted(set(langs[begin:last]))
            of_row = np.array([names.index(x) for x in langs[begin:last]])
            raw = data.tobytes()
            for k, name in enumerate(names):
                mine = np.flatnonzero(of_row[row] == k)
                _, at, n = np.unique(keys[mine], return_index=True, return_counts=True)
                at = mine[at]
                words, times = [], []
                for s, e, count in zip(start[at].tolist(), end[at].tolist(), n.tolist(), strict=True):
                    word = b" " + raw[s:e]
                    parts = [word[k:k + LEARNED_BYTES] for k in range(0, len(word), LEARNED_BYTES)]
                    words += parts
                    times += [count] * len(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array(times, pa.int64())], schema=schema)


def learn(labelled: DataFrame, pieces: list[bytes], sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities from ``labelled(doc_id, text, lang)``.

    At most ``sample`` distinct texts of a language are learned from; a text
    that is repeated counts once. All languages are learned, so the driver gets
    languages x pieces numbers (0.3 MB a language).
    """
    spark = labelled.sparkSession
    labelled = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("hash"))
    spoken = labelled.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))
    # a draw that leaves about four times the sample, then the least of a language
    draw = F.pmod(F.xxhash64("hash", F.lit(17)), F.lit(1 << 40))
    drawn = labelled.select("lang", "hash", draw.alias("draw")).join(spoken, "lang").where(F.col("draw").cast("double") * F.col("n") < 4.0 * sample * (1 << 40))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    chosen = drawn.select("lang", "hash", "draw").distinct().withColumn("rank", rank).where(F.col("rank") <= sample)
    chosen = materialize(chosen.select("lang", "hash"), "sample")
    texts = labelled.join(chosen, ["lang", "hash"], "left_semi").dropDuplicates(["lang", "hash"]).select("lang", "text")
    counts = texts.mapInArrow(_count_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    shared = spark.sparkContext.broadcast(pieces)

    def fit(table: pa.Table) -> pa.Table:
        words = table.column("word").to_pylist()
        order = sorted(range(len(words)), key=words.__getitem__)
        n = table.column("n").to_numpy().astype(float)[order]
        p = Lattice(shared.value).fit([words[i] for i in order], n)
        return pa.table({"lang": table.column("lang").slice(0, 1), "p": pa.array([p.tobytes()], pa.binary())})

    # ordered here: a sort in Spark would fit twice, once to sample its ranges
    rows = sorted(counts.groupBy("lang").applyInArrow(fit, "lang string, p binary").collect(), key=lambda r: r["lang"])
    return [r["lang"] for r in rows], np.array([np.frombuffer(r["p"], float) for r in rows]).reshape(len(rows), len(pieces) + 1)


def identify(docs: DataFrame, langs: list[str], table: np.ndarray, pieces: list[bytes]) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs(doc_id, text)``.

    ``score`` is the posterior of the predicted language among the learned
    ones; equal scores go to the first name. A null or empty text, a text without letters,
    and every text if no language was learned: ``und``, score 0. Repeated
    rows are scored alike; further columns are ignored. Words and texts of any
    length are scored whole (a word of 1 MB takes about a minute).
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, np.ascontiguousarray(table.T) if len(langs) else None, pieces))
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        names, probability, parts = shared.value
        lattice = Lattice(parts) if names else None
        known_keys, known = np.zeros(0, np.uint64), np.zeros((0, len(names)))
        for batch in batches:
            ids = batch.column("doc_id")
            for begin, last, text, offsets in text_slices(batch.column("text")):
                n_rows = last - begin
                pred, score = ["und"] * n_rows, [0.0] * n_rows
                data, keys, row, start, end = slice_words(text, offsets)
                if len(keys) and names:
                    distinct, at, back = np.unique(keys, return_index=True, return_inverse=True)
                    scores = np.empty((len(distinct), len(names)))
                    place = np.minimum(np.searchsorted(known_keys, distinct), max(len(known_keys) - 1, 0))
                    have = known_keys[place] == distinct if len(known_keys) else np.zeros(len(distinct), bool)
                    scores[have] = known[place[have]]
                    new = np.flatnonzero(~have)
                    if len(new):
                        raw, at = data.tobytes(), at[new]
                        words = [b" " + raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                        scores[new] = lattice.forward(words, probability)
                        if len(known_keys) < REMEMBERED:
                            both = np.concatenate([known_keys, distinct[new]])
                            order = np.argsort(both)
                            known_keys, known = both[order], np.concatenate([known, scores[new]])[order]
                    bound = np.searchsorted(row, np.arange(n_rows + 1))
                    filled = np.flatnonzero(bound[1:] > bound[:-1])
                    total = np.add.reduceat(scores[back], bound[:-1][filled], axis=0)
                    best = total.argmax(axis=1)
                    posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                    for r, b, s in zip(filled.tolist(), best.tolist(), posterior.tolist(), strict=True):
                        body = data[offsets[r]:offsets[r + 1]]
                        # bytes beyond ASCII are letters only if their characters are
                        if ((body >= 97) & (body <= 122)).any() or any(c.isalpha() for c in body.tobytes().decode("utf-8", "replace")):
                            pred[r], score[r] = names[b], s
                yield pa.RecordBatch.from_arrays([ids.slice(begin, n_rows).cast(pa.int64()), pa.array(pred, pa.string()), pa.array(score, pa.float64())], schema=schema)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
