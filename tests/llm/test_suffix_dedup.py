import random

import numpy as np
import pytest

from yarnscope.llm import suffix_dedup as sd


@pytest.mark.parametrize("alphabet", [b"ab", b"a", b"ab\x00", bytes(range(256))])
def test_suffix_array_and_prefixes(alphabet):
    rng = random.Random(3)
    for n in (1, 2, 7, 40, 260, 700):
        text = bytes(rng.choice(alphabet) for _ in range(n))
        for data in (text, text + text[:n // 2], text * 3):
            order, packed = sd.suffix_array(np.frombuffer(data, np.uint8))
            assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
            got = sd.common_prefixes(order, packed, 30, lanes=16)
            for a, b in zip(order, order[1:], strict=False):
                k = 0
                while k < 30 and max(a, b) + k < len(data) and data[a + k] == data[b + k]:
                    k += 1
                assert got[b] == k


def brute(rows, length):
    seen = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        for s in range(len(b) - length + 1):
            seen[b[s:s + length]] = seen.get(b[s:s + length], 0) + 1
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def texts(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    shared = [make(rng.randrange(18, 60)) for _ in range(6)]
    rows = []
    for d in range(70):
        parts = [make(rng.randrange(0, 50)) for _ in range(3)] + [rng.choice(shared) for _ in range(rng.randrange(0, 3))]
        rng.shuffle(parts)
        rows.append((d, "".join(parts)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"hot": 2, "shard_bytes": 400}])
def test_matches_brute_force(frame, limits):
    rows = texts(5)
    assert result(sd.remove_repeats(frame(rows), length=20, gram=6, **limits)) == brute(rows, 20)


def test_edge_cases(frame):
    one = "the same words again and again, and once more"
    rows = [(1, None), (2, ""), (3, "short"), (4, one), (4, one), (None, one), (5, "a" * 300), (6, "x" + one[5:40]), (7, "é" * 40 + "ü" * 3), (7, "other text")]
    assert result(sd.remove_repeats(frame(rows), length=20, gram=6)) == brute(rows, 20)


def test_long_text(frame):
    body = "".join(chr(97 + i * i % 23) + chr(97 + i % 7) for i in range(300_000))
    out = result(sd.remove_repeats(frame([(1, body), (2, "nothing like it " * 3)])))
    assert [r[0] for r in out] == [1, 2] and out[0][1] == 600_000 and out[0][2] > 590_000


def test_empty_table(frame):
    assert result(sd.remove_repeats(frame([]))) == []


def test_texts_whose_short_hashes_collide(spark, frame):
    """Rows without id whose texts have one 32-bit hash stay apart."""
    from pyspark.sql import functions as F
    seen = spark.range(300_000).select(F.concat(F.lit("unlike "), F.col("id").cast("string")).alias("t")).select("t", F.hash("t").alias("h"))
    twin = seen.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").first()
    body = "the shared words of both texts, long enough"
    rows = [(None, twin.a), (None, twin.b), (None, twin.a + body * 3), (None, twin.b + " other " + body), (None, twin.a)]
    assert result(sd.remove_repeats(frame(rows), length=20, gram=6)) == brute(rows, 20)
