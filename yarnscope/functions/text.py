"""Small regex helpers over columns.

``regexp_extract`` returns ``''`` both when nothing matches and when the
group matched empty text, so every "is there a match" decision pairs it with
``rlike``. Integer captures go through ``try_cast`` (ANSI mode would fail the
whole job on an empty capture); the caller picks the sentinel.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extract(c: Column, pattern: str, group: int) -> Column:
    """Group of the first match, NULL when there is no match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def extract_or(c: Column, pattern: str, group: int, default: str = "") -> Column:
    """Group of the first match, ``default`` when there is no match."""
    return F.coalesce(extract(c, pattern, group), F.lit(default))


def extract_all(c: Column, pattern: str, group: int) -> Column:
    """Group of every match, as an array (``''`` for a group that did not take part)."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def int_or(c: Column, default: int) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(default))


def prefix_to_colon(c: Column) -> Column:
    """Text before the first ``:`` (all of it when there is none)."""
    return F.substring_index(c, ":", 1)


def flatten_lines(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def contains_any(c: Column, literals) -> Column:
    """True when ``c`` contains one of ``literals`` (a cheap byte search)."""
    if isinstance(literals, str):
        literals = (literals,)
    g = c.contains(literals[0])
    for s in literals[1:]:
        g = g | c.contains(s)
    return g


#: A line terminator other than a line feed that is not the text's last character.
_TERMINATOR = r"(?s)[\r\x85\u2028\u2029]."


def _last_exception_end(flat: Column) -> Column:
    """Characters up to the end of the last ``Exception`` or ``Error`` that ``: `` follows; 0 if there is none."""
    def end(word: str) -> Column:
        after = F.length(F.substring_index(flat, word + ": ", -1))
        return F.when(after < F.length(flat), F.length(flat) - after - 2).when(F.endswith(flat, F.lit(word + ": ")), F.length(flat) - 2).otherwise(F.lit(0))
    return F.greatest(end("Exception"), end("Error"))


def last_exception_word(flat: Column, lead: str) -> Column:
    """Group 1 of the full match ``.*LEAD.* (.*Exception|.*Error): .*`` of a flattened log, '' without a match.

    ``LEAD`` ends with a blank. The greedy match takes the last blank that has
    ``Exception: `` or ``Error: `` behind it, so the group is the word that
    ends there; found by searches from the end, in linear time. A dot matches
    no line terminator, so a text that holds another one, but at its end, has no match.
    """
    end = _last_exception_end(flat)
    head = F.substr(flat, F.lit(1), end)
    word = F.substring_index(head, " ", -1)
    first = F.locate(lead, flat) + (len(lead) - 1)
    blank = end - F.length(word)
    ok = (end > 0) & flat.contains(lead) & (blank > first) & ~flat.rlike(_TERMINATOR)
    return F.when(ok, word).otherwise(F.lit(""))


def exception_after(flat: Column, lead: str) -> Column:
    """Group 1, up to its first colon, of the full match ``.*LEAD(.*Exception|.*Error): .*``; '' without a match."""
    end = _last_exception_end(flat)
    head = F.substr(flat, F.lit(1), end)
    rest = F.substr(flat, F.length(head) - F.length(F.substring_index(head, lead, -1)) + 1, F.length(flat))
    ok = (end > 0) & head.contains(lead) & ~flat.rlike(_TERMINATOR)
    return F.when(ok, F.substring_index(rest, ":", 1)).otherwise(F.lit(""))


def before_last(c: Column, boundary: str) -> Column:
    """Text before the last place where ``boundary`` matches; '' without one.

    A pattern ``HEAD([\\s\\S]*)?(?=boundary)`` is greedy to the last boundary
    from wherever its head ends, so its first match is that of
    ``HEAD([\\s\\S]*)`` in this text. Going back from the end meets every place
    once; trying every end of the head against every rest, as the whole
    pattern does, is quadratic.
    """
    return F.regexp_extract(c, rf"^([\s\S]*)(?={boundary})", 1)


def until_boundary(pattern: str, boundary: str) -> str:
    """``HEAD([\\s\\S]*)`` of a pattern ``HEAD([\\s\\S]*)?(?=boundary)``."""
    tail = f"?(?={boundary})"
    if not pattern.endswith(tail):
        raise ValueError(f"no trailing boundary: {pattern}")
    return pattern[:-len(tail)]


def line_start(pattern: str) -> str:
    """Anchor a search pattern that starts with ``.*`` to line starts.

    ``.`` matches no line terminator, so any match of ``.*X`` found inside a
    line can be extended back to the start of that line; the first match of
    a search therefore always starts at a line start, and ``(?m)^.*X`` finds
    exactly the same match (same groups) without retrying every position of
    every line. Other patterns are returned unchanged.
    """
    return "(?m)^" + pattern if pattern.startswith(".*") else pattern
