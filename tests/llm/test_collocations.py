import random
import re
from collections import Counter, defaultdict

import pytest

from yarnscope.llm import collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=10, share=50, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cands = {p: c for p, c in count.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in cands.items():
            if any(100 * c >= share * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in cands.items()):
                continue
            s, _, left, right = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "São", "paulo", "x\x01y", "日本", "a", "naïve", "t u"]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "!"]
    out = []
    for i in range(n):
        body = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(80)))
        out.append((body + (" New York City" * rng.randrange(3)), rng.choice(["en", "en", "de", None])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(frame, seed):
    rows = texts(seed)
    got = result(collocations.collocations(frame([(i, t, lang) for i, (t, lang) in enumerate(rows)])))
    assert got == brute(rows) and len(got) > 20


def test_small_runs_buckets_and_ranks(frame, monkeypatch):
    rows = texts(3)
    monkeypatch.setattr(collocations, "RUN_BYTES", 300)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", 500)
    got = result(collocations.collocations(frame([(i, t, lang) for i, (t, lang) in enumerate(rows)]), least=3, share=80, top=5))
    assert got == brute(rows, 3, 80, 5)


def test_nulls_empty_repeats_and_long_text(frame):
    rows = [(None, "en"), ("", None), ("a b c " * 50_000, "en"), ("a b. c", None)] + [("x y", None)] * 12
    got = result(collocations.collocations(frame([(None, t, lang) for t, lang in rows])))
    assert got == brute(rows)
    assert ("und", 1, "x y", 12, 12, 12, 27, 1_000_000) in got
    assert result(collocations.collocations(frame([(1, None), (2, "")]))) == []


def test_empty_table(frame):
    assert result(collocations.collocations(frame([(1, "a b")]).limit(0))) == []


def test_products_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_017, 3_000_000_000_019, 3_000_000_000_021
    row = spark.sql(f"select {a}L a, {left}L l, {right}L r").selectExpr("cast((1000000BD * cast(a as decimal(19,0)) * a) div (cast(l as decimal(19,0)) * r) as long) s").first()
    assert row.s == 1000000 * a * a // (left * right)
