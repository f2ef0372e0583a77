import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from yarnscope.llm import language_id as li

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES = [bytes([b]) for b in range(256)] + [b" t", b"th", b"he", b" the", b"the", b"\xc3\xa9"]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    pieces = sorted(set(PIECES))
    table = rng.random((len(pieces) + 1, 2))
    table[-1] = 0
    lattice = li.Lattice(pieces)
    of = {p: i for i, p in enumerate(pieces)}
    for word in (b" the", b"thethe", b"x", b" \xc3\xa9h"):
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
            parts = [word[a:b] for a, b in itertools.pairwise(at)]
            if all(p in of for p in parts):
                total += np.prod([table[of[p]] for p in parts], axis=0)
        assert np.exp(lattice.forward([word], table)[0]) == pytest.approx(total)


def _log_forward(word, of, table):
    """The forward algorithm in logarithms, one word and language at a time."""
    out = np.full((len(word) + 1, table.shape[1]), -np.inf)
    out[0] = 0
    for end in range(1, len(word) + 1):
        for begin in range(end):
            if word[begin:end] in of:
                out[end] = np.logaddexp(out[end], out[begin] + np.log(table[of[word[begin:end]]]))
    return out[-1]


def test_long_words_and_long_pieces_are_not_cut():
    rng = np.random.default_rng(2)
    long = "日本語の文章です".encode()
    pieces = sorted({*PIECES, long, long[:9], b"abcdefghijklmnopq"})
    of = {p: i for i, p in enumerate(pieces)}
    table = rng.random((len(pieces) + 1, 3)) ** 40 * 1e-3 + 1e-9
    table[-1] = 0
    words = [b" " + long * 9, b" " + b"abcdefghijklmnopq" * 12 + b"a", b" the", b" x", b" " + bytes(rng.integers(128, 256, 700).tolist())]
    words += [b" " + bytes(rng.integers(97, 123, int(n)).tolist()) for n in rng.integers(1, 90, 60)]
    got = li.Lattice(pieces).forward(words, table)
    assert np.allclose(got, [_log_forward(w, of, table) for w in words], rtol=1e-9)
    # a piece of 24 bytes, and segmentations across every 32nd byte, count
    other = table.copy()
    other[of[long]] *= 1e6
    assert (li.Lattice(pieces).forward(words[:1], other) > got[0] + 1).all()


def test_expected_counts_are_those_of_all_segmentations():
    rng = np.random.default_rng(3)
    pieces = sorted(set(PIECES))
    of = {p: i for i, p in enumerate(pieces)}
    lattice, p = li.Lattice(pieces), rng.random(len(pieces))
    words, counts = [b" thethe", b"x", b" \xc3\xa9h"], np.array([3.0, 2, 5])
    expected = np.zeros(len(pieces) + 1)
    for word, n in zip(words, counts, strict=True):
        ways = []
        for cuts in itertools.product([0, 1], repeat=len(word) - 1):
            at = [0, *[k + 1 for k, c in enumerate(cuts) if c], len(word)]
            parts = [of.get(word[a:b]) for a, b in itertools.pairwise(at)]
            if None not in parts:
                ways.append((parts, np.prod(p[parts])))
        for parts, weight in ways:
            np.add.at(expected, parts, n * weight / sum(w for _, w in ways))
    assert lattice._expected(words, counts, p) == pytest.approx(expected)


def test_fit_in_chunks_is_the_same(monkeypatch):
    lattice = li.Lattice(sorted(set(PIECES)))
    words, n = [b" the", b" thee", b" he", b" x" * 40, b" \xc3\xa9"], np.array([50.0, 3, 10, 1, 2])
    whole = lattice.fit(words, n)
    monkeypatch.setattr(li, "LATTICE_BYTES", 5)
    assert lattice.fit(words, n) == pytest.approx(whole)
    assert lattice.fit([], np.zeros(0))[:-1].std() == 0


def test_every_language_is_learned_and_repeated_texts_count_once(frame):
    rows = [(k, f"word{chr(97 + k % 26)} {chr(97 + k // 26)} text", f"l{k:03d}") for k in range(210)]
    # rows without an id, copies, and ids that two rows share
    rows += [(None, "the and of", "en")] * 500 + [(None, "la de que", "es"), (7, "la de el", "es")]
    langs, table = li.learn(frame(rows), sorted(set(PIECES)), sample=5)
    assert langs == sorted({r[2] for r in rows}) and table.shape == (212, len(set(PIECES)) + 1)
    once, table_once = li.learn(frame([*rows[:210], *rows[-3:]]), sorted(set(PIECES)), sample=5)
    assert once == langs and np.allclose(table, table_once)


def test_fit_raises_the_likelihood():
    lattice = li.Lattice(sorted(set(PIECES)))
    words, n = [b" the", b" thee", b" he"], np.array([50.0, 3, 10])
    value = lambda p: (lattice.forward(words, p[:, None])[:, 0] * n).sum()
    assert value(lattice.fit(words, n, 1)) < value(lattice.fit(words, n, 4))


def test_held_out_accuracy_and_edges(spark, frame):
    pieces = li.load_pieces(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    langs, table = li.learn(docs.where(~held), pieces, sample=150)
    out = li.identify(docs.where(held), langs, table, pieces).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)
    text = "the and of that with is"
    rows = [(1, None), (2, ""), (3, "12 ++ \n"), (4, text), (4, text), (None, text), (5, "– … ·"), (6, "x" * 100_000), (7, "日本語")]
    got = li.identify(frame(rows), langs, table, pieces).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1, 2, 3, 5)] == ["und"] * 4 and by[1].score == 0
    assert by[4].lang_pred == by[None].lang_pred == "en" and by[7].lang_pred in langs and by[6].lang_pred in langs


def test_nothing_to_learn_from(frame):
    langs, table = li.learn(frame([(1, "text", None), (2, None, "en")]), sorted(set(PIECES)))
    assert langs == []
    assert [tuple(r) for r in li.identify(frame([(1, "a word")]), langs, table, sorted(set(PIECES))).collect()] == [(1, "und", 0.0)]
    assert li.identify(frame([]), langs, table, sorted(set(PIECES))).count() == 0
