import random
import re

import pytest

from yarnscope.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(rows, items, size=10):
    wins = [(i, w[s:s + size]) for i, w in ((i, words(t)) for i, t in items) if w for s in range(max(1, len(w) - size + 1))]
    out = []
    for d, t in rows:
        w, hit, ids = words(t), set(), set()
        for i, win in wins:
            for s in range(len(w) - len(win) + 1):
                if w[s:s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    if i is not None:
                        ids.add(str(i))
        out.append((d, len(w), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect()), key=repr)


def cases():
    rng = random.Random(4)
    make = lambda n: [rng.choice(["the", "of", "a", f"w{rng.randrange(50)}", "É1"]) for _ in range(n)]
    items = [(i, " ".join(make(rng.randrange(1, 25)))) for i in range(14)] + [(99, "THE"), (98, None), (97, " .. "), (None, "a W7 of"), (5, "the of"), (12, "the the the")]
    rows = []
    for d in range(50):
        parts = make(rng.randrange(0, 40))
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = words(rng.choice(items)[1])
        rows.append((d, " - ".join(parts)))
    return rows, items


@pytest.mark.parametrize("bound", [dc.BROADCAST_BYTES, -1])
def test_matches_brute_force(spark, frame, bound):
    rows, items = cases()
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, window string")
    assert result(dc.contamination(frame(rows), table, broadcast_bytes=bound)) == brute(rows, items)


def test_edge_cases(spark, frame):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (1, "one two three four five six seven eight nine ten eleven")]
    long = "filler " * 50_000 + "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, "..."), (4, items[0][1]), (4, items[0][1]), (None, "X " + items[0][1]), (5, long)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert result(dc.contamination(frame(rows), table)) == brute(rows, items)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(dc.contamination(frame([]), none)) == []
    assert result(dc.contamination(frame([(1, "a b")]), none)) == [(1, 2, 0, [], False)]
