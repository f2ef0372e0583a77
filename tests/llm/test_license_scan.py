import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from yarnscope.llm import license_scan

LOWER = {c: c + 32 for c in range(65, 91)}
RULES = license_scan.rules()
PATTERNS = [(r, re.compile(r.pattern)) for r in RULES]


def brute(rows):
    out = []
    for doc, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(i, label) for phrase, label in license_scan.BASE for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        chain = "".join(f"<{w}>" for w in words)
        found = [(chain[:m.start()].count("<"), -chain[:m.end()].count("<"), r.priority, r.rank, r.label, r.weight)
                 for r, p in PATTERNS for m in p.finditer(chain)]
        stay = [d for d in found if not any(e < d and e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] for e in found)]
        base = {label for _, label in places}
        out.append((doc, len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
                    ",".join(sorted(base)), ",".join(sorted(base | {d[4] for d in stay})),
                    max([d[5] for d in stay] + [license_scan.VERSIONED if places else 0.0])))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()), key=repr)


SAMPLES = [
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: (MIT OR GPL-2.0-or-later)",
    "under the terms of the GNU Lesser General Public License version 2.1 or (at your option) any later version",
    "https://creativecommons.org/licenses/by-sa/4.0/", "http://www.apache.org/licenses/LICENSE-2.0", "a BSD 3-Clause License, and the new BSD",
    "All rights reserved. MIT", "cc by nc cc by nc sa 4 0 cc by nc", "GPLv3 or later", "mit license", "the Mozilla Public Licence", "éapache license",
    "dedicated to the public domain", "no terms at all here", "under the mit license under the mit license", "Under the\nMIT\tLicense, version 2",
]


def test_equals_brute_force(frame):
    rng = random.Random(5)
    rows = list(enumerate(SAMPLES))
    rows += [(100 + i, rng.choice([" ", ". ", "\n"]).join(rng.choice(SAMPLES + ["lorem", "ipsum dolor", "licensed", "version 2", "or later"]) for _ in range(rng.randrange(1, 9)))) for i in range(80)]
    got = result(license_scan.scan(frame(rows)))
    assert got == brute(rows)
    labels = {r[0]: r[6] for r in got}
    assert labels[0] == "mit" and labels[3] == "gpl-3" and labels[6] == "cc-by-sa-4.0" and labels[14] == "" and labels[16] == ""
    assert labels[5] == "lgpl-2.1-or-later" and "gpl-2-or-later" in labels[4].split(",")


def test_nulls_empty_repeats_and_long_text(frame):
    rows = [(None, None), (1, ""), (1, ""), (2, "...!"), (None, "cc by nc"), (3, "word " * 300_000 + "under the mit license " * 3000)]
    got = result(license_scan.scan(frame(rows)))
    assert got == sorted([(None, 0, 0, None, None, "", "", 0.0), (1, 0, 0, None, None, "", "", 0.0), (1, 0, 0, None, None, "", "", 0.0),
                          (2, 0, 0, None, None, "", "", 0.0), (None, 3, 1, 0, 0, "cc-by-nc", "cc-by-nc", 0.7),
                          (3, 312_000, 3000, 300_000, 311_996, "mit", "mit", 0.7)], key=repr)
    assert result(license_scan.scan(frame(rows).limit(0))) == []


def test_rules_are_many_and_distinct():
    assert len(RULES) > 300
    assert [r.rank for r in RULES] == list(range(len(RULES)))
    assert all(any(g in k or g == "licen" for g in license_scan.GATES) for r in RULES for k in r.keywords)


@pytest.mark.parametrize("rule", RULES[::7], ids=lambda r: f"{r.rank}-{r.label}")
def test_keywords_and_gates_hold_for_every_match(rule):
    @settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck), database=None)
    @given(st.from_regex(rule.pattern, fullmatch=True))
    def check(chain):
        assert any(k in chain for k in rule.keywords)
        assert any(g in chain for g in license_scan.GATES)
    check()
