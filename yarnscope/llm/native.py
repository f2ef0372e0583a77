"""Column helpers shared by the operators that use built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else. Texts of ASCII only take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def space_words(text: Column) -> Column:
    """Runs of other characters than ASCII white space, in order."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def without(text: Column, chars: str) -> Column:
    """The text less single characters; one pass for each, no regular expression."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text
