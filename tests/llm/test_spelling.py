import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from yarnscope.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute(rows, least=3):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    close = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


def texts(seed, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice(["an", "er", "th", "e", "s", "ö", "ß", "aa"]) for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    words += [w + w[-1] for w in words] + [w[:i] + rng.choice("aes") + w[i + 1:] for w in words for i in range(len(w))]
    return [(i if i % 9 else None, " ".join(rng.choice(words).title() + rng.choice(["", "", ",", "1", "-"]) for _ in range(rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(frame, seed):
    rows = texts(seed)
    want = brute(rows)
    assert result(spelling.variants(frame(rows))) == want
    assert sum(w[4] > 0 for w in want) > 50


def test_every_pair_once(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(300)} | {"aaaaa" + "a" * i for i in range(9)}
    pairs = spelling.near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()
    got = Counter(frozenset((r.a, r.b)) for r in pairs)
    assert got == Counter(frozenset((a, b)) for a in words for b in words if a < b and near(a, b))


def test_chains_of_forms(frame):
    names = ["colour", "coloura", "colourab", "colourabc", "colourabcd", "colourabcde"]
    rows = [(None, " ".join(f"{w} " * (3 << (2 * i)) for i, w in enumerate(names)))]
    got = result(spelling.variants(frame(rows)))
    assert got == brute(rows)
    assert {r[2] for r in got if r[0].startswith("colour")} == {names[-1]}


def test_deleted_letters(frame):
    run = next(w for w in (f"abcde{'f' * i}" for i in range(5000)) if zlib.crc32(f"7:{w}".encode()) % 97 == 0)
    rows = [(7, f"{run} {run.upper()} {run}"), (8, "")]
    assert result(spelling.variants(frame(rows))) == brute(rows)
    assert result(spelling.variants(frame(rows)))[0][0] != run


def test_nulls_empty_repeats_and_long_text(frame):
    rows = [(None, None), (1, ""), (2, "hello hello"), (2, "hello hello"), (None, "hallo hallo hallo"), (5, "z" * 200_000 + " " + "hello " * 100_000)]
    assert result(spelling.variants(frame(rows))) == brute(rows)
    assert result(spelling.variants(frame(rows).limit(0))) == []


def test_a_common_beginning_makes_few_candidates(spark):
    """A third of the words share a half: candidates stay near the number of words."""
    words = spark.range(20_000).select(F.concat(F.when(F.col("id") % 3 == 0, F.lit("prefix")).otherwise(F.lit("")), F.translate(F.sha2(F.col("id").cast("string"), 256).substr(1, 8), "0123456789", "ghijklmnop")).alias("word"), F.lit(3).alias("n"))
    pairs = spelling.near_pairs(words)
    assert pairs.count() < 100
