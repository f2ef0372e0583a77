import numpy as np
import pytest

from yarnscope.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def pieces(df):
    return sorted(df.collect(), key=lambda r: (r.sequence_id, r.offset))


def check(rows, got, window=2048):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = sorted((d, t.encode(x or "", add_special_tokens=False).ids + [1]) for d, x in rows)
    by, fill = {}, {}
    for r in got:
        assert r.offset == fill.get(r.sequence_id, 0) and r.length > 0
        fill[r.sequence_id] = r.offset + r.length
        assert len(r.ids) == 4 * r.length
        by.setdefault(r.doc_id, []).append(r)
    assert all(f == window or f & (f - 1) == 0 for f in fill.values()), "no padding"
    back = []
    for d, rs in by.items():
        rs.sort(key=lambda r: r.start)
        assert all(r.doc_tokens == sum(x.length for x in rs) for r in rs)
        back.append((d, np.frombuffer(b"".join(bytes(r.ids) for r in rs), "<u4").tolist()))
    assert sorted(back) == ids


def pack(df, **kw):
    return packing.pack(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, **kw)


def test_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(rows, pieces(pack(docs)))
    check(rows, pieces(pack(docs.repartition(3), max_open=5)))


def test_edge_cases(frame):
    rows = [(1, None), (2, ""), (3, "a\u00a0 \n\n  b 12 <|endoftext|> 'll é😀"), (4, "long words " * 20_000), (5, " " * 3000)]
    check(rows, pieces(pack(frame(rows))))
    twice = pieces(pack(frame([(6, "same text"), (6, "same text"), (None, "x")])))
    assert {d: sum(r.length for r in twice if r.doc_id == d) for d in (6, None)} == {6: 6, None: 2}
    assert pieces(pack(frame([]))) == []


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000 \t"])
def test_megabytes_of_white_space(blank):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        encode = packing.encoder(f.read(), public_tokenizers.PATTERN)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    run = blank * (2_000_000 // len(blank))
    for text in (run, "a" + run + "word's " + run + "<|endoftext|>" + run + "\u2028\x1c", run + "5" + " " * 20_000 + "é"):
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_least_sum_of_squares():
    rng = np.random.default_rng(3)
    p = packing.Packer(window=16)
    for doc in range(300):
        size = int(rng.integers(1, 16))
        before = p.level.copy()
        p.add(doc, np.zeros(size, np.uint32))
        options = []
        for fill in range(16 - size + 1):
            if fill and not before[fill]:
                continue
            after = before.copy()
            after[fill] -= fill > 0
            after[fill + size] += fill + size < 16
            options.append(int((after[1:16] ** 2).sum()))
        assert int((p.level[1:16] ** 2).sum()) == min(options)
        assert p.n_open == p.level.sum() == sum(map(len, p.open))
