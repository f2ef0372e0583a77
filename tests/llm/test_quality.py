import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from yarnscope.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {p for k in range(len(w) - 2) if tri[w[k], w[k + 1], w[k + 2]] > 1 for p in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def check(frame, rows):
    out = quality.quality_rules(frame(rows)).collect()
    key = lambda x: (str(x[0]), x[1:])
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out), key=key)
    assert got == sorted(((r[0], *base(r[1])) for r in rows), key=key)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    return {r.doc_id: r for r in out}


def test_counts_match_brute_force(frame):
    rng = random.Random(2)
    vocabulary = ["the", "of", "a#", "B|", "é<", "x\x0by", "10"]
    rows = [(d, "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", "\n", "\t", "\n\n", "\r"]) for _ in range(rng.randrange(0, 200)))) for d in range(40)]
    # more than FEW repeated windows: matched by sorting
    twice = " ".join(f"w{i}" for i in range(300))
    check(frame, [*rows, (100, twice + " and " + twice), (101, "a b c a b c"), (102, "a b"), (103, "a a a a")])


def test_edge_cases(frame):
    text = "it is the same text as before and then some more " * 3
    rows = [(1, None), (2, ""), (3, " \n "), (4, text), (4, text), (None, text, None), (5, "word " * 40_000), (6, "ein wort", None), (7, "x y z", "zz")]
    got = check(frame, rows)
    assert got[1].base_failed and not got[1].kept


def test_divergence_rejects_odd_text_and_keeps_plain(frame):
    rng = random.Random(8)
    vocabulary = ["the", "of", "and", "to", "in"] * 3 + [f"word{k}" for k in range(200)]
    plain = [(d, " ".join(rng.choice(vocabulary) for _ in range(150)) + ".") for d in range(60)]
    odd = [(900, " ".join("#$%" + rng.choice(vocabulary) + "***" for _ in range(150)))]
    got = check(frame, plain + odd)
    assert all(got[d].kept for d, _ in plain) and not got[900].kept and not got[900].base_failed


def test_junk_of_no_or_a_rare_language_is_held_against_the_whole_corpus(frame):
    rng = random.Random(9)
    vocabulary = ["the", "of", "and", "to", "in"] * 30 + [f"word{k}" for k in range(200)]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(150))
    plain = [(d, text()) for d in range(100)]
    junk = lambda: " ".join(f"junk{rng.randrange(20)}" for _ in range(150))
    rows = plain + [(200 + k, junk(), None) for k in range(25)] + [(300, junk(), "rare"), (301, text(), "odd"), (302, text(), None)]
    got = {r.doc_id: r for r in quality.quality_rules(frame(rows)).collect()}
    assert all(got[d].kept for d, _ in plain) and got[301].kept and got[302].kept
    for d in (*range(200, 225), 300):
        assert not got[d].base_failed and not got[d].kept and got[d].word_distance > quality.WORD_DISTANCE


def test_js_distance(spark):
    p, q = [5, 0, 3, 2], [1, 4, 0, 5]
    got = spark.createDataFrame([(p, q)], "p array<long>, q array<long>").select(quality.js_distance(F.col("p"), F.col("q"))).first()[0]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    kl = lambda u: sum(x * math.log2(2 * x / (y + z)) for x, y, z in zip(u, a, b, strict=True) if x)
    assert got == pytest.approx(math.sqrt((kl(a) + kl(b)) / 2))


def test_empty_table(frame):
    assert quality.quality_rules(frame([])).count() == 0
