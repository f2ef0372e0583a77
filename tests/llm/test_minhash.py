import random
import re

import pytest

from yarnscope.llm import minhash
from yarnscope.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows, width, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        c = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def families(seed, n=12, size=9):
    """Groups of edited copies, of which some reach others only through a third."""
    rng = random.Random(seed)
    rows, doc = [], 100
    for _ in range(n):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 90))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 7))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(60)}"
            rows.append((doc, " ".join(text)))
            doc += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 5)])
def test_components_match_brute_force(frame, seed, width):
    rows = families(seed)
    assert result(minhash.near_duplicates(frame(rows), width, 80)) == brute(rows, width)


def test_edge_cases(frame):
    long = " ".join(f"v{i % 977}x{i % 13}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (4, "one TWO"), (5, "one two"), (None, "one two"), (None, "lone words here"),
            (None, "lone words here"), (6, "single"), (7, "SINGLE"), (9, long), (8, long + " end"), (10, "É a"), (11, "é a"), (20, "red green blue"), (20, "one two three four"), (21, "one two three four"), (19, "red green blue")]
    assert result(minhash.near_duplicates(frame(rows), 2, 80)) == brute(rows, 2)


def test_empty_table(frame):
    assert result(minhash.near_duplicates(frame([]).where("doc_id > 0"), 5, 80)) == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def stars(seed, n_leaders, size, merged):
    """Rows of leaders 0, 1000, .. and edited copies, their labels, and the links between components of one leader."""
    rng = random.Random(seed)
    rows, labels, links = [], {}, set()
    for a in range(0, 1000 * n_leaders, 1000):
        leader, sets = set(range(rng.randrange(8, 60))), {}
        edited = lambda x, share: (x - set(rng.sample(sorted(x), rng.randrange(len(x) // share + 1)))) \
            | {1000 + rng.randrange(30) for _ in range(rng.randrange(len(x) // share + 1))}  # noqa: B023, E731
        versions = [edited(leader, 4) for _ in range(5)]
        for b in range(a + 1, a + 1 + size):
            sets[b] = edited(rng.choice(versions), 6)
        labels[a] = a
        for b, x in sets.items():
            linked = 100 * len(leader & x) >= 80 * len(leader | x)
            rows.append((a, b, linked, len(leader), len(leader - x), len(x - leader), sorted(leader ^ x)))
            if linked or rng.random() < merged:
                labels[b] = a if linked else rng.choice([a, a + 1, a + 2])
        links |= {(x, y) for x in sets for y in sets if x < y and labels.get(x, x) != labels.get(y, y)
                  and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])}
    return rows, sorted(labels.items()), links


STAR = "a long, b long, linked boolean, n long, gone long, added long, diff array<long>"


@pytest.mark.parametrize(("seed", "merged"), [(1, 0.0), (2, 0.3)])
def test_settlement_finds_all_links_of_open_members(spark, seed, merged):
    rows, labels, links = stars(seed, 40, 14, merged)
    got = minhash._rest(spark.createDataFrame(rows, STAR), spark.createDataFrame(labels, "node long, label long"), 80)
    assert len(links) > 50
    assert {(r.a, r.b) for r in got.collect()} == links


def made_by_joins(spark, monkeypatch, size):
    """Rows that all joins of the settlement make, for one leader and open members that share edits at random."""
    rng, made, rows = random.Random(3), 0, []
    for b in range(1, size + 1):
        gone = rng.randrange(23, 40)
        own = rng.randrange(gone + 1)
        diff = rng.sample(range(200), gone) + [10_000 * b + i for i in range(own)] + rng.sample(range(1000, 1200), gone - own)
        rows.append((0, b, False, 200, gone, gone, diff))

    def walk(plan):
        below = plan.children()
        own = plan.metrics().get("numOutputRows").get().value() if "Join" in plan.nodeName() else 0
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    def collect(df, name):
        nonlocal made
        out = spark.createDataFrame(df.collect(), df.schema)
        made += walk(df._jdf.queryExecution().executedPlan())
        return out

    monkeypatch.setattr(minhash, "materialize", collect)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans drop joins, and their counts, if nothing comes out
    try:
        collect(minhash._rest(spark.createDataFrame(rows, STAR), spark.createDataFrame([(0, 0)], "node long, label long"), 80), "links")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    return made


def test_settlement_makes_fewer_rows_than_pairs(spark, monkeypatch):
    few, many = made_by_joins(spark, monkeypatch, 40), made_by_joins(spark, monkeypatch, 200)
    # pairs grow 25 times
    assert 0 < many < 15 * few
    assert many < 200_000
