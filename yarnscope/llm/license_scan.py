"""License scan: ordered signature rules, gated by keywords, resolved by priority and containment.

A text becomes the chain of its words, ``<under><the><mit><license>``, and a
rule a regular expression over such chains, written as plain words. Texts
without any of GATES are done; in the others a rule runs only where its own
keyword occurs. Detections of one text are swept from left to right: one that
lies inside another of the same or a better priority is suppressed, so the
versioned name wins over the bare one and a grant over the name in it.

Built-in functions only; no text leaves its row and nothing is shuffled.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yarnscope.llm.native import ascii_lower

#: Phrases that are always reported, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: A text without any of these has no detection; every keyword of a rule contains one.
GATES = ("licen", "gpl", "fdl", "<cc", "commons", "domain", "rights", "bsd", "wtfpl", "cecill", "openrail", "mozilla")
#: Weights of the kinds of evidence; the score of a text is the greatest one that stays.
GRANT, ADDRESS, VERSIONED, BARE = 1.0, 0.9, 0.7, 0.5


class Rule(NamedTuple):
    rank: int
    priority: int
    label: str
    weight: float
    keywords: list[str]
    pattern: str


class License(NamedTuple):
    """Label, priority of its name alone (2 with a version, 3 without), literals of which every match holds one (``a|b``), words of the name, words of the identifier."""
    label: str
    priority: int
    keywords: str
    name: str
    short: str = ""


_L = "(?:license|licence)"

# ---- fixed values: names and identifiers of public licenses ---------------------
_SINGLE = (
    License("mit", 3, "mit", f"mit {_L}", "mit"),
    License("mit", 3, "expat", f"expat {_L}"),
    License("mit-0", 3, "mit", f"mit no attribution {_L}", "mit 0"),
    License("x11", 3, "x11", f"x11 {_L}", "x11"),
    License("apache-1", 2, "apache", f"apache (?:software )?{_L} (?:version )?(?:1|v1) (?:0|1)?", "apache 1 (?:0|1)"),
    License("apache-2", 2, "apache", f"apache (?:software )?{_L} (?:version |v )?(?:2|v2) 0?", "apache 2 0"),
    License("apache", 3, "apache", f"apache (?:software )?{_L}"),
    License("bsd-0", 2, "bsd", f"(?:0bsd|bsd (?:zero|0) clause|zero clause bsd) {_L}?", "0bsd"),
    License("bsd-2", 2, "bsd", f"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd) {_L}?", "bsd 2 clause"),
    License("bsd-3", 2, "bsd", f"(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd) {_L}?", "bsd 3 clause"),
    License("bsd-4", 2, "bsd", f"(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd) {_L}?", "bsd 4 clause"),
    License("bsd", 3, "bsd", f"bsd (?:style )?{_L}"),
    License("isc", 3, "isc", f"isc {_L}", "isc"),
    License("mpl-1", 2, "mozilla", f"mozilla public {_L} (?:version )?(?:1|v1) (?:0|1)?", "mpl 1 (?:0|1)"),
    License("mpl-2", 2, "mozilla", f"mozilla public {_L} (?:version |v )?(?:2|v2) 0?", "mpl 2 0"),
    License("mpl", 3, "mozilla", f"mozilla public {_L}"),
    License("epl-1", 2, "eclipse", f"eclipse public {_L} (?:version |v )?(?:1|v1) 0?", "epl 1 0"),
    License("epl-2", 2, "eclipse", f"eclipse public {_L} (?:version |v )?(?:2|v2) 0?", "epl 2 0"),
    License("epl", 3, "eclipse", f"eclipse public {_L}"),
    License("edl-1", 2, "eclipse", f"eclipse distribution {_L} (?:version |v )?(?:1|v1) 0?"),
    License("eupl-1.1", 2, "european", f"european union public {_L} (?:version |v )?(?:1|v1) 1", "eupl 1 1"),
    License("eupl-1.2", 2, "european", f"european union public {_L} (?:version |v )?(?:1|v1) 2", "eupl 1 2"),
    License("eupl", 3, "european", f"european union public {_L}"),
    License("cddl-1", 2, "common", f"common development and distribution {_L} (?:version |v )?(?:1|v1) (?:0|1)?", "cddl 1 (?:0|1)"),
    License("cddl", 3, "common", f"common development and distribution {_L}"),
    License("cpl-1", 2, "common", f"common public {_L} (?:version |v )?(?:1|v1) 0?", "cpl 1 0"),
    License("artistic-1", 2, "artistic", f"artistic {_L} (?:version )?(?:1|v1) 0?", "artistic 1 0"),
    License("artistic-2", 2, "artistic", f"artistic {_L} (?:version )?(?:2|v2) 0?", "artistic 2 0"),
    License("artistic", 3, "artistic", f"artistic {_L}"),
    License("zlib", 3, "zlib", f"zlib (?:libpng )?{_L}", "zlib"),
    License("libpng", 3, "libpng", f"libpng {_L}", "libpng"),
    License("boost-1", 2, "boost", f"boost software {_L} (?:version |v )?(?:1|v1) 0?", "bsl 1 0"),
    License("boost", 3, "boost", f"boost software {_L}"),
    License("unlicense", 3, "unlicense", "the unlicense", "unlicense"),
    License("wtfpl", 3, "wtfpl", f"wtfpl (?:version )?2? {_L}?", "wtfpl"),
    License("ofl-1.1", 2, "sil", f"sil open font {_L} (?:version |v )?(?:1|v1) 1", "ofl 1 1"),
    License("ofl", 3, "sil", f"sil open font {_L}"),
    License("osl-3", 2, "open", f"open software {_L} (?:version |v )?(?:3|v3) 0?", "osl 3 0"),
    License("afl-3", 2, "academic", f"academic free {_L} (?:version |v )?(?:3|v3) 0?", "afl 3 0"),
    License("ms-pl", 3, "microsoft", f"microsoft public {_L}", "ms pl"),
    License("ms-rl", 3, "microsoft", f"microsoft reciprocal {_L}", "ms rl"),
    License("apsl", 3, "apple", f"apple public source {_L}", "apsl 2 0"),
    License("psf", 3, "python", f"python software foundation {_L}", "(?:psf|python) 2 0"),
    License("php", 3, "php", f"php {_L}", "php 3 (?:0|01)"),
    License("ruby", 3, "ruby", f"ruby {_L}", "ruby"),
    License("postgresql", 3, "postgresql", f"postgresql {_L}", "postgresql"),
    License("openssl", 3, "openssl", f"openssl {_L}", "openssl"),
    License("ncsa", 3, "ncsa", f"ncsa open source {_L}", "ncsa"),
    License("unicode", 3, "unicode", f"unicode {_L}", "unicode (?:3 0|dfs 2016)"),
    License("w3c", 3, "w3c", f"w3c (?:software )?(?:and document )?{_L}", "w3c"),
    License("vim", 3, "vim", f"vim {_L}", "vim"),
    License("ibm-pl", 3, "ibm", f"ibm public {_L}", "ipl 1 0"),
    License("qpl", 3, "public", f"q public {_L}", "qpl 1 0"),
    License("sleepycat", 3, "sleepycat", f"sleepycat {_L}", "sleepycat"),
    License("zope-2", 3, "zope", f"zope public {_L}", "zpl 2 (?:0|1)"),
    License("odbl", 3, "open", f"open (?:data commons open )?database {_L}", "odbl 1 0"),
    License("odc-by", 3, "open", f"open data commons attribution {_L}", "odc by 1 0"),
    License("pddl", 3, "domain", f"public domain dedication and {_L}", "pddl 1 0"),
    License("ogl-uk", 3, "government", f"open government {_L}", "ogl uk (?:1|2|3) 0"),
    License("etalab", 3, "ouverte", "licence ouverte (?:open licence)?", "etalab 2 0"),
    License("cecill", 3, "cecill", f"cecill (?:b|c)? (?:free software )?{_L}?", "cecill (?:b|c|2 0|2 1)"),
    License("mulan-2", 3, "mulan", f"mulan permissive software {_L}", "mulanpsl 2 0"),
    License("elastic-2", 3, "elastic", f"elastic {_L} (?:version )?(?:2|v2)? 0?", "elastic 2 0"),
    License("sspl", 3, "server", f"server side public {_L}", "sspl 1 0"),
    License("busl", 3, "business", f"business source {_L}", "busl 1 1"),
    License("polyform", 3, "polyform", f"polyform (?:noncommercial|small business|strict|shield|perimeter) {_L}", "polyform (?:noncommercial|strict) 1 0 0"),
    License("openrail", 3, "openrail", f"(?:creativeml )?openrail (?:m|s)? {_L}?"),
    License("cc0", 2, "cc0", "(?:cc0|creative commons zero|creative commons cc0) (?:1 0)? (?:universal)?", "cc0 1 0"),
    License("public-domain", 3, "domain", "(?:released|placed|dedicated|is|are) (?:in|into|to|within)? the public domain"),
    License("all-rights-reserved", 3, "rights", "all rights reserved"),
    License("proprietary", 3, "proprietary", f"proprietary (?:software )?{_L}"),
    License("commercial", 3, "commercial", f"commercial {_L}"),
)
# label, identifier, words before "general public license" or the whole name, versions
_GNU = (("gpl", "gpl", "general public", ("1", "2", "3")), ("lgpl", "lgpl", "(?:lesser|library) general public", ("2", "2.1", "3")),
        ("agpl", "agpl", "affero general public", ("1", "3")), ("fdl", "fdl", "free documentation", ("1.1", "1.2", "1.3")))
_CC_PARTS = {"by": "(?:by|attribution)", "nc": "(?:nc|noncommercial|non commercial)", "sa": "(?:sa|sharealike|share alike)",
             "nd": "(?:nd|noderivatives|no derivatives|noderivs)"}
_CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
_CC_VERSIONS = ("", "1.0", "2.0", "2.5", "3.0", "4.0")
# ------------------------------------------------------------------------------


def _gnu():
    for label, short, name, versions in _GNU:
        keywords = f"{name.split()[0]}|{short}" if label == "fdl" else f"general|{short}"
        bare = f"(?:gnu {name} {_L}|{name} {_L}|(?:gnu )?{short})"
        yield License(label, 3, keywords, bare)
        for version in versions:
            major, _, minor = version.partition(".")
            after = minor or "0?"
            number = f"(?:{bare} (?:version |v )?(?:{major}|v{major}) {after}|{short}v{major} {after})"
            ids = f"{short} {major} {minor or 0}"
            yield License(f"{label}-{version}", 2, keywords, number, f"{ids} (?:only)?")
            yield License(f"{label}-{version}-or-later", 2, keywords, f"{number} (?:or|and) (?:later|any later version|at your option any later version)", f"{ids} or later")


def _creative_commons():
    for kind in _CC_KINDS:
        words = " ".join(_CC_PARTS[p] for p in kind.split("-"))
        for version in _CC_VERSIONS:
            number = version.replace(".", " ")
            label = f"cc-{kind}" + (f"-{version}" if version else "")
            name = f"(?:cc|creative commons|creative commons cc) {words} {_L}? {number} (?:international|unported|generic)?"
            yield License(label, 2 if version else 3, "<cc|commons", name, f"cc {kind.replace('-', ' ')} {number}" if version else "")


def chained(words: str) -> str:
    """A pattern of plain words as one over the chain: ``mit license?`` becomes ``<mit>(?:<license>)?``."""
    out = re.sub(r"\{[^}]*\}|[a-z0-9]+", lambda m: m[0] if m[0][0] == "{" else f"(?:<{m[0]}>)", words).replace("W", "(?:<[^<>]+>)")
    return out.replace(" ", "")


def rules() -> list[Rule]:
    """All rules in order: grants, identifiers, addresses, then names."""
    grant = "(?:licensed|released|distributed|available|provided|published|offered|covered|governed|redistributed) W{0,3}?(?:under|by|with) (?:the )?(?:terms (?:and conditions )?of (?:the )?|conditions of (?:the )?)?"
    out = []

    def add(priority: int, label: str, weight: float, keywords: str, words: str) -> None:
        out.append(Rule(len(out), priority, label, weight, keywords.split("|"), chained(words)))

    known = [*_SINGLE, *_gnu(), *_creative_commons()]
    for x in known:
        if x.label not in ("all-rights-reserved", "public-domain"):
            add(1, x.label, GRANT, x.keywords, f"{grant}(?:{x.name})")
    for x in known:
        if x.short:
            add(1, x.label, GRANT, "spdx", f"spdx license identifier W{{0,4}}?{x.short}")
            add(1, x.label, ADDRESS, "opensource", f"opensource org (?:licenses|license) {x.short}")
            add(1, x.label, ADDRESS, "spdx", f"spdx org licenses {x.short}")
        if x.label.startswith("cc-") and x.short:
            add(1, x.label, ADDRESS, "creativecommons", "creativecommons org licenses " + x.short.removeprefix("cc "))
        if x.label.startswith(tuple(g[0] for g in _GNU)) and x.short:
            add(1, x.label, ADDRESS, "gnu", "(?:www )?gnu org licenses (?:old licenses )?" + x.short)
    add(1, "apache-2", ADDRESS, "apache", "apache org licenses license 2 0")
    add(1, "mpl-2", ADDRESS, "mozilla", "mozilla org mpl 2 0")
    add(1, "cc0", ADDRESS, "creativecommons", "creativecommons org publicdomain zero 1 0")
    for x in known:
        add(x.priority, x.label, VERSIONED if x.priority == 2 else BARE, x.keywords, x.name)
    return out


def chain(text: Column) -> Column:
    """Words of ``text``, each in angle brackets."""
    joined = F.concat(F.lit("<"), F.regexp_replace(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "><"), F.lit(">"))
    return F.replace(joined, F.lit("<>"), F.lit(""))


def _words(part: Column) -> Column:
    return (F.char_length(part) - F.char_length(F.replace(part, F.lit("<"), F.lit("")))).cast("long")


def _literal(signatures: list[Rule]) -> str:
    """The rules as an array of structs that the optimizer folds into one literal."""
    quoted = lambda words: ", ".join(f"'{w}'" for w in words)
    return "array(" + ", ".join(f"struct({r.rank} as rank, {r.priority} as priority, '{r.label}' as label, {r.weight}D as weight, "
                                f"array({quoted(r.keywords)}) as keywords, '{r.pattern}' as pattern)" for r in signatures) + ")"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score``: places of the BASE phrases (all of them, smallest and largest
    start, null without any), their labels, these with the labels of all
    detections that stay, and the greatest weight among them (0 without any).

    Null and empty texts have no words and no labels. Long texts are read
    whole; every step is linear in them but for a sort of the detections.
    Repeated rows are judged alike, an empty table gives no rows, further
    columns are ignored.
    """
    signatures = rules()
    keys = sorted({k for r in signatures for k in r.keywords})
    out = docs.select("doc_id", chain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("chain")).withColumn("n_words", _words(F.col("chain")))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.col("chain").contains(g)
    out = out.withColumn("gated", gate)
    # base phrases: none overlaps itself, so cutting at them finds every place
    phrases = [("".join(f"<{w}>" for w in phrase.split()), len(phrase.split()), label) for phrase, label in BASE]
    found = [F.col("gated") & F.col("chain").contains(p) for p, _, _ in phrases]
    places = [F.when(f, ((F.char_length("chain") - F.char_length(F.replace("chain", F.lit(p), F.lit("")))) / len(p)).cast("long")).otherwise(0)
              for f, (p, _, _) in zip(found, phrases)]
    first = [F.when(f, _words(F.substring_index("chain", p, 1))) for f, (p, _, _) in zip(found, phrases)]
    last = [F.when(f, F.col("n_words") - _words(F.substring_index("chain", p, -1)) - n) for f, (p, n, _) in zip(found, phrases)]
    out = out.withColumns({
        "n_base": sum(places[1:], places[0]).cast("long"), "first_word": F.least(*first), "last_word": F.greatest(*last),
        "base": F.array_sort(F.array_compact(F.array(*[F.when(f, F.lit(label)) for f, (_, _, label) in zip(found, phrases)])))})
    # the inner arrays of one element bind a value that the lambdas would compute anew for every rule
    on = f"""transform(array(filter(array({", ".join(f"'{k}'" for k in keys)}), k -> contains(chain, k))), present ->
        filter({_literal(signatures)}, r -> arrays_overlap(r.keywords, present) and regexp_like(chain, r.pattern)))[0]"""
    out = out.withColumn("on", F.when(F.col("gated"), F.expr(on)))
    # words with marks where a match begins (after the word before it) and ends
    spans = """flatten(transform(on, r -> transform(array(split(regexp_replace(chain, concat('(', r.pattern, ')'), '\\u0001$1\\u0002'), '<')), p ->
        zip_with(filter(sequence(0, size(p) - 1), j -> contains(p[j], '\\u0001')), filter(sequence(0, size(p) - 1), j -> contains(p[j], '\\u0002')),
                 (s, e) -> struct(s as s, -e as e, r.priority as priority, r.rank as rank, r.label as label, r.weight as weight)))[0]))"""
    out = out.withColumn("spans", F.when(F.size("on") > 0, F.sort_array(F.expr(spans))))
    # from left to right, longer first: m1 to m3 are the furthest ends by priority
    swept = """aggregate(spans, named_struct('m1', -1, 'm2', -1, 'm3', -1, 'labels', base, 'weight', cast(0 as double)), (z, d) ->
        if(greatest(z.m1, if(d.priority >= 2, z.m2, -1), if(d.priority >= 3, z.m3, -1)) >= -d.e, z, named_struct(
            'm1', if(d.priority = 1, -d.e, z.m1), 'm2', if(d.priority = 2, -d.e, z.m2), 'm3', if(d.priority = 3, -d.e, z.m3),
            'labels', array_union(z.labels, array(d.label)), 'weight', greatest(z.weight, d.weight))))"""
    out = out.withColumn("swept", F.expr(swept))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                      F.array_join(F.array_sort(F.coalesce("swept.labels", "base")), ",").alias("labels"),
                      F.greatest(F.coalesce("swept.weight", F.lit(0.0)), F.when(F.col("n_base") > 0, VERSIONED).otherwise(0.0)).alias("score"))
