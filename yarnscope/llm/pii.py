"""Personal data: keyed surrogates of the same type, format, script and gender.

Detected are e-mail addresses, phone numbers (international and national,
grouped), payment card numbers, IPv4 and IPv6 addresses, IBANs with valid check
digits, US social security numbers (ddd-dd-dddd), secrets (long hexadecimal ones, access keys, or after a word such as ``token``) and
names of persons (a known given name or a title, then capitalised words).

A surrogate is a keyed permutation of the characters of the normalised
entity, class by class (digits, lower and upper case letters of a script), or
of the given names of one gender and script. The key comes from the session, and
a permutation is one keyed cycle, so no value stays and a known pair reveals no other. It never gives two
entities of one format the same surrogate and always gives one entity the same, in every document and
every spelling, without a table; card numbers keep their check digit valid or
invalid. Collision check: the distinct entities of the corpus are gathered,
and a surrogate that is itself an entity there is permuted again until it is
none, which keeps the mapping one to one. Those few entities are the only ones that travel.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yarnscope.session import materialize

#: Session setting that holds the key of the surrogates.
KEY_SETTING = "spark.yarnscope.pii.key"
#: Key of tests and of runs over synthetic tables; never of real data.
TEST_KEY = b"surrogates"
#: Greatest set of values that is shuffled as a list, and shuffled lists a process keeps.
LISTED, LISTS_KEPT = 1024, 200
#: Entities with a permuted surrogate up to which they are sent to every executor; more are joined.
BROADCAST_ENTITIES = 100_000

#: Given names by (gender, script).
NAMES = {
    ("f", "latin"): """Alice Amelia Anna Beatrice Camille Carla Carmen Caroline Charlotte Claire Clara Diana Elena Elisabeth Emily Emma
        Erika Eva Fiona Hannah Helen Ingrid Isabel Jane Julia Karin Laura Lena Lisa Lucia Maria Marie Martha Mary Monika Nina
        Olivia Patricia Petra Rosa Sabine Sarah Sofia Sophie Susanne Teresa Ursula""".split(),
    ("m", "latin"): """Albert Alexander Andreas Anton Antonio Bernard Carlos Charles Christian Daniel David Diego Edward Emil Eric Felix
        Francisco Frank George Hans Henri Henry Jack James Javier Jean John Jonas Jorge Joseph Juan Karl Klaus Louis Lukas Luis
        Marc Martin Matthias Michael Miguel Oliver Pablo Paul Pedro Peter Philippe Pierre Robert Stefan Thomas Walter William""".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("m", "cyrillic"): "Александр Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Павел Сергей".split(),
}
#: Titles and the gender they tell.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
          "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Dr": ""}

_GENDER = {n: g for g, names in NAMES.items() for n in names}
#: Words that a text must hold to be searched for names.
_CUES = frozenset(_GENDER) | frozenset(TITLES)
_TOKEN = re.compile(r"\w+")

#: Letters that are permuted among themselves; others stay.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïñòóôõöùúûüýÿ",
             "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŸ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
             "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
_PLACE = {c: (k, i) for k, a in enumerate(ALPHABETS) for i, c in enumerate(a)}

_EMAIL = re.compile(r"[\w.+-]*\w@[\w-]+(?:\.[\w-]+)*\.\w{2,}")
_IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
_HEX = re.compile(r"(?<!\w)(?=[0-9a-f]*\d|[0-9A-F]*\d)(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?!\w)")
_SECRET = re.compile(r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|pwd|(?:api|access|secret|private)[_-]?key)\s*[=:]\s*(?:([\"'])(?P<quoted>[^\"'\s]{6,})\1|(?P<bare>(?=[^\s\"',;]*\d)[^\s\"',;]{6,}[^\W_]))")
#: Access keys that start with a known prefix, which stays.
_KEY = re.compile(r"(?<!\w)(?:(?:AKIA|ASIA)[0-9A-Z]{16}|(?:sk|pk|ghp|gho|ghs|xoxb|xoxp|glpat)[-_][A-Za-z0-9_-]{16,}|AIza[0-9A-Za-z_-]{35})(?!\w)")
_CARD = re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{4}([ -])\d{6}\2\d{5})(?!\w|\.\d)")
_PHONE = re.compile(r"(?<![\w.+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w.])\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\w)"
                    # an area code in brackets, then digits in one group or in groups of any size
                    r"|(?<![\w.])\((?:0\d{1,4}\)[ .-]?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\d{3}\)[ ]?\d{7})(?![\w(]|[.-]\d)")
#: National numbers: 3-3-4 digits, also after 1; a leading 0 or 00 before groups with one separator; an area code with 0, then the rest.
_NATIONAL = re.compile(r"(?<![\w+])(?<!\d[./-])(?:(?:1(?P<one>[ .-]))?[2-9]\d\d(?P<s>(?(one)(?P=one)|[ .-]))\d{3}(?P=s)\d{4}"
                       r"|0(?:[1-9]\d{0,3}|0[1-9]\d{0,2})(?P<t>[ .-])\d{1,8}(?:(?P=t)\d{2,8}){1,4}"
                       r"|0[1-9]\d{0,4}(?:[ ]?/[ ]?|[ -])\d{2,8}(?:[ -]\d{2,5}){0,3})(?!\w|[./-]\d)")
_DATE = re.compile(r"\d\d([ .-])\d\d\1(?:19|20)\d\d(?!\d)")
_LEAD = re.compile(r"(?:\+|00)[1-9]\d{0,2}(?=[ .(-])|\+\d|0|1(?=[ .-])")
_SSN = re.compile(r"(?<![\w.])(?<!\d-)(?!000|666)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?!\w|-\d|\.\d)")
_IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:|:(?=:))(?:[0-9A-Fa-f]{0,4}:){1,7}(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9A-Fa-f]{1,4})?(?!\w|:\w|\.\d)")
#: Lengths of IBANs by country.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
                23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
                28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = re.compile(r"(?<!\w)(?:" + "|".join(rf"(?:{'|'.join(c.split())})\d\d(?:[ -]?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()) + r")(?!\w)")
_NAME = re.compile(r"(?<!\w)(?:(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\.?[ ](?P<rest>[^\W\d_]\w+(?:[ -][^\W\d_a-z]\w+){0,2})"
                   r"|(?P<given>" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r")(?P<last>(?:[ -][^\W\d_a-z]\w+){1,2}))(?!\w)")
#: What any other entity than a name holds.
_MARK = re.compile(r"[0-9@\"']|:[0-9A-Fa-f:]|AKIA|ASIA|AIza|(?:sk|pk|gh[pos]|xox[bp]|glpat)[-_]")


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` plus it valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_digits(country: str, body: str) -> str:
    """The check digits of an IBAN."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _is_phone(text: str, m: re.Match) -> bool:
    """Whether a national number is none of the look-alikes: dates, tables of numbers, thousands in groups, postal codes."""
    body = m.group(0)
    groups = re.findall(r"\d+", body)
    sizes, total = [len(g) for g in groups], sum(len(g) for g in groups)
    beside = bool(re.search(r"\d[ ]\Z", text[max(0, m.start() - 2):m.start()])) or bool(re.match(r"[ ]\d", text[m.end():m.end() + 2]))
    if not body.startswith("0"):
        return not (m["s"] == " " and beside)
    if _DATE.match(body) or body.startswith("00") and total < 11 or not body.startswith("00") and not 9 <= total <= 12:
        return False
    if sizes == [5, 4] and "-" in body or set(sizes) == {3} and beside:
        return False
    return set(sizes) != {2} or total == 10 and not beside


def _ip6_of(body: str) -> str | None:
    """The normal form of an IPv6 address; None for times, slices, scopes of names and other text with colons."""
    groups = [g for g in body.split(":") if g]
    if len(groups) < 3 and not any(len(g) >= 4 for g in groups) or len(groups) < 3 and not any(c.isdigit() for c in body):
        return None
    try:
        return str(ipaddress.IPv6Address(body))
    except ValueError:
        return None


class Surrogates:
    """Keyed permutations of entities, by kind."""

    def __init__(self, key: bytes):
        self.key = key
        self.lists: dict[tuple[str, int], dict[int, int]] = {}

    def _round(self, kind: str, size: int, k: int, half: int, bound: int) -> int:
        msg = f"{kind}/{size}/{k}/{half}".encode()
        wide = max(16, bound.bit_length() // 8 + 9)
        out, block = b"", 0
        while len(out) < wide:
            out += hmac.new(self.key, msg + b"/%d" % block, hashlib.sha256).digest()
            block += 1
        return int.from_bytes(out[:wide]) % bound

    def permute(self, kind: str, value: int, size: int) -> int:
        """The value after ``value`` in a keyed cycle through 0 .. size-1: every value moves, and one pair tells nothing of another.

        The cycle is a keyed order of the values: a list for small sets; beyond
        that Feistel rounds, walked until inside the set, from a place to its
        value and back.
        """
        if size < 2:
            return value
        if size <= LISTED:
            if (kind, size) not in self.lists:
                if len(self.lists) >= LISTS_KEPT:
                    self.lists.clear()
                order = sorted(range(size), key=lambda v: (self._round(kind, size, 0, v, 1 << 128), v))
                self.lists[kind, size] = {v: order[(k + 1) % size] for k, v in enumerate(order)}
            return self.lists[kind, size][value]
        side = math.isqrt(size - 1) + 1
        place = value
        while True:  # back from the value to its place
            left, right = divmod(place, side)
            for k in range(7, -1, -1):
                left, right = (right - self._round(kind, size, k, left, side)) % side, left
            place = left * side + right
            if place < size:
                break
        value = (place + 1) % size
        while True:
            left, right = divmod(value, side)
            for k in range(8):
                left, right = right, (left + self._round(kind, size, k, right, side)) % side
            value = left * side + right
            if value < size:
                return value

    def text(self, kind: str, body: str) -> str:
        """Permutes the characters of ``body`` that belong to an alphabet; others stay in their places."""
        places = [_PLACE.get(c) for c in body]
        size, value = 1, 0
        for p in places:
            if p:
                n = len(ALPHABETS[p[0]])
                size, value = size * n, value * n + p[1]
        shape = "".join("-" if p is None else str(p[0]) for p in places)
        value = self.permute(f"{kind}:{shape}", value, size)
        out = []
        for c, p in zip(reversed(body), reversed(places), strict=True):
            if p:
                value, i = divmod(value, len(ALPHABETS[p[0]]))
                c = ALPHABETS[p[0]][i]
            out.append(c)
        return "".join(reversed(out))

    def hexadecimal(self, body: str) -> str:
        size = 16 ** len(body)
        out = format(self.permute(f"hex{len(body)}", int(body, 16), size), f"0{len(body)}x")
        return out.upper() if body.isupper() else out

    def once(self, kind: str, norm: str) -> str:
        """Surrogate of a normalised entity, in normalised form; a permutation of the entities of its kind and shape."""
        if kind == "ip":
            value = 0
            for part in norm.split("."):
                value = value * 256 + int(part)
            value = self.permute("ip", value, 1 << 32)
            return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
        if kind == "ip6":
            return str(ipaddress.IPv6Address(self.permute("ip6", int(ipaddress.IPv6Address(norm)), 1 << 128)))
        if kind == "ssn":
            out = self.text("ssn", norm)
            while not _SSN.fullmatch(out):  # walked until it is a number that is given out
                out = self.text("ssn", out)
            return out
        if kind == "iban":
            body = self.text("iban" + norm[:2], norm[4:])
            return norm[:2] + iban_digits(norm[:2], body) + body
        if kind == "card":
            # the check digit keeps its distance from the valid one
            off = (int(norm[-1]) - luhn_digit(norm[:-1])) % 10
            body = self.text("card", norm[:-1])
            return body + str((luhn_digit(body) + off) % 10)
        if kind == "hex":
            return self.hexadecimal(norm)
        if kind == "key":
            return norm[:4] + self.text("key" + norm[:4], norm[4:])
        if kind == "email":
            local, _, host = norm.rpartition("@")
            name, _, top = host.rpartition(".")
            mixed = self.text("email", f"{local}@{name}")
            return f"{mixed}.{top}"
        if kind == "phone":
            lead, _, digits = norm.partition(" ")
            return f"{lead} {self.text('phone' + lead, digits)}"
        if kind.startswith("given:"):
            names = NAMES[tuple(kind[6:].split("/"))]
            return names[self.permute(kind, names.index(norm), len(names))]
        return self.text(kind, norm)


class _Addresses:
    """What ``_EMAIL`` finds, looked for from the ``@`` backwards: a long run without one costs nothing."""

    @staticmethod
    def finditer(text: str):
        end, at = 0, text.find("@")
        while at >= 0:
            first = at
            while first > end and (text[first - 1].isalnum() or text[first - 1] in "_.+-"):
                first -= 1
            m = _EMAIL.match(text, first) if first < at else None
            if m:
                yield m
                end = m.end()
            at = text.find("@", max(end, at + 1))


def find_entities(text: str):
    """Non-overlapping entities in order: ``(start, end, [(kind, normalised, start, end), ..])``."""
    found = []
    if _MARK.search(text):
        for kind, pattern in (("secret", _SECRET), ("key", _KEY), ("email", _Addresses), ("hex", _HEX), ("ip", _IP), ("phone", _PHONE), ("phone", _NATIONAL), ("card", _CARD),
                              ("ssn", _SSN), ("ip6", _IP6), ("iban", _IBAN)):
            for m in pattern.finditer(text):
                a, b = m.span() if kind != "secret" else m.span("quoted" if m["quoted"] else "bare")
                body = text[a:b]
                if kind == "secret" and re.fullmatch(r"[0-9a-f]{16,}|[0-9A-F]{16,}", body):
                    kind_, norm = "hex", body
                elif kind == "card":
                    kind_, norm = kind, re.sub(r"[ -]", "", body)
                elif kind == "phone":
                    if pattern is _NATIONAL and not _is_phone(text, m):
                        continue
                    # 00 and 1 are said as in the international form
                    lead = _lead(body)
                    said = "+" + lead[2:] if lead.startswith("00") else "+1" if lead == "1" else lead
                    kind_, norm = kind, f"{said} {re.sub(r'[^0-9]', '', body[len(lead):])}"
                elif kind == "ip6":
                    kind_, norm = kind, _ip6_of(body)
                    if norm is None:
                        continue
                elif kind == "iban":
                    kind_, norm = kind, re.sub(r"[ -]", "", body)
                    if iban_digits(norm[:2], norm[4:]) != norm[2:4]:
                        continue
                else:
                    kind_, norm = kind, body
                found.append((a, b, [(kind_, norm, a, b)]))
    # the boundaries of _NAME: whatever stands around a cue, it is a token
    if not _CUES.isdisjoint(_TOKEN.findall(text)):
        for m in _NAME.finditer(text):
            a, b = m.span("rest") if m["title"] else m.span()
            parts = []
            for w in re.finditer(r"\w+", text[a:b]):
                kind = "name"
                if w.group(0) in _GENDER:
                    kind = "given:" + "/".join(_GENDER[w.group(0)])
                elif not parts and not w.group(0)[0].isupper():
                    break  # a title before a common word
                parts.append((kind, w.group(0), a + w.start(), a + w.end()))
            if parts:
                found.append((parts[0][2], parts[-1][3], parts))
    found.sort(key=lambda x: (x[0], -x[1]))
    end = -1
    for f in found:
        if f[0] >= end:
            end = f[1]
            yield f


def _lead(body: str) -> str:
    """What a phone number begins with and keeps: +, 00 or 1 with the country, or 0."""
    m = _LEAD.match(body)
    return m.group(0) if m else ""


def render(kind: str, body: str, surrogate: str) -> str:
    """The surrogate in the spelling of ``body``: separators of cards, phones and IBANs stay in place."""
    if kind not in ("card", "phone", "iban"):
        return surrogate
    digits = surrogate
    if kind == "phone":
        lead, digits = _lead(body), surrogate.partition(" ")[2]
        return lead + _fill(body[len(lead):], digits)
    return _fill(body, digits)


def _fill(body: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in body)


def _entities(key: bytes):
    schema = pa.schema([("kind", pa.string()), ("entity", pa.string()), ("next", pa.string())])

    def run(batches):
        make = Surrogates(key)
        for batch in batches:
            rows = set()
            for text in batch.column("text"):
                for _, _, parts in find_entities(text.as_py() or ""):
                    rows.update((kind, norm) for kind, norm, _, _ in parts if not kind.startswith("given:"))
            rows = [(kind, norm, make.once(kind, norm)) for kind, norm in sorted(rows)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in range(3)], schema=schema)
    return run


def _again(key: bytes):
    def run(batches):
        make = Surrogates(key)
        for batch in batches:
            after = [make.once(k, e) for k, e in zip(batch.column("kind").to_pylist(), batch.column("next").to_pylist(), strict=True)]
            yield batch.set_column(batch.schema.get_field_index("next"), "next", pa.array(after, pa.string()))
    return run


def taken_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """``kind, entity, next``: entities whose first surrogate is itself an entity of the corpus, with the next that is none."""
    entities = materialize(docs.where("text is not null").select("text").mapInArrow(_entities(key), "kind string, entity string, next string")
                           .distinct(), "entities")
    names = entities.select("kind", F.col("entity").alias("next"))
    moving = entities.join(names, ["kind", "next"], "left_semi").select("kind", "entity", "next")
    settled = None
    while True:
        moving = materialize(moving.mapInArrow(_again(key), "kind string, entity string, next string"), "moving")
        moving = moving.where("entity <> next")  # all values of a small set are entities: the first surrogate stays
        free = moving.join(names, ["kind", "next"], "left_anti").select("kind", "entity", "next")
        settled = free if settled is None else settled.unionByName(free)
        moving = moving.join(names, ["kind", "next"], "left_semi").select("kind", "entity", "next")
        if moving.limit(1).count() == 0:
            return materialize(settled, "settled")


def session_key(spark: SparkSession, otherwise: bytes | None = None) -> bytes:
    """The key that the session names in KEY_SETTING, else ``otherwise``; without either, an error."""
    key = spark.conf.get(KEY_SETTING, None)
    if key:
        return key.encode()
    if otherwise is None:
        raise ValueError(f"no key for the surrogates: set {KEY_SETTING}, or give one")
    return otherwise


def replace_entities(docs: DataFrame, key: bytes | None = None, broadcast_entities: int = BROADCAST_ENTITIES) -> DataFrame:
    """``docs`` with ``text`` replaced by surrogates, and ``n_replaced``; all other columns as they were.

    Null texts stay null, empty texts empty (n_replaced 0). Texts without
    entities stay as they are. Repeated rows get equal texts. A column of the
    input named n_replaced is overwritten. An empty table stays empty. Very long
    texts are read whole. Without ``key``, the session's is taken (KEY_SETTING).
    """
    key = session_key(docs.sparkSession) if key is None else key
    taken = taken_surrogates(docs.select(F.col("text").cast("string").alias("text")), key)
    n = taken.count()
    rows = docs.drop("n_replaced").withColumn("text", F.col("text").cast("string"))
    known = {}
    if n and n <= broadcast_entities:
        known = {(r["kind"], r["entity"]): r["next"] for r in taken.collect()}
    elif n:
        rows = _with_taken(rows, taken)
    shared = docs.sparkSession.sparkContext.broadcast(known)  # at most broadcast_entities rows
    names = [c for c in rows.columns if c != "taken__"]

    def run(batches):
        make = Surrogates(key)
        for batch in batches:
            own = batch.column("taken__").to_pylist() if "taken__" in batch.schema.names else None
            texts, counts = [], []
            for r, text in enumerate(batch.column("text")):
                text = text.as_py()
                moved = {(x["kind"], x["entity"]): x["next"] for x in (own[r] or ())} if own else shared.value
                out, at, count = [], 0, 0
                for _, _, parts in find_entities(text or ""):
                    count += 1
                    for kind, norm, a, b in parts:
                        surrogate = moved.get((kind, norm)) or make.once(kind, norm)
                        out += [text[at:a], render(kind, text[a:b], surrogate)]
                        at = b
                texts.append(text if not count else "".join(out) + text[at:])
                counts.append(count)
            cols = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], names=[*names, "n_replaced"])

    schema = rows.select(*names).withColumn("n_replaced", F.lit(0).cast("long")).schema
    return rows.mapInArrow(run, schema)


def _with_taken(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Adds to every row the moved surrogates of its own entities, by a shuffle of the entities."""
    schema = pa.schema([("hash", pa.int64()), ("kind", pa.string()), ("entity", pa.string())])

    def run(batches):
        for batch in batches:
            found = set()
            for h, text in zip(batch.column("hash").to_pylist(), batch.column("text"), strict=True):
                for _, _, parts in find_entities(text.as_py() or ""):
                    found.update((h, kind, norm) for kind, norm, _, _ in parts)
            cols = list(zip(*sorted(found), strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    hashed = rows.withColumn("hash__", F.xxhash64("text"))
    used = hashed.select(F.col("hash__").alias("hash"), "text").mapInArrow(run, "hash long, kind string, entity string")
    lists = used.join(taken, ["kind", "entity"]).distinct().groupBy(F.col("hash").alias("hash__")) \
        .agg(F.collect_list(F.struct("kind", "entity", "next")).alias("taken__"))
    return hashed.join(lists, "hash__", "left").drop("hash__")
