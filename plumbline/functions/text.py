"""Text features as column expressions; every one is linear in the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace characters, as regex class members.
WHITESPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
REPLACEMENT = "�"


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def _matching(text: Column, drop: str) -> Column:
    """How many characters stay when the class ``drop`` is removed."""
    return F.length(F.regexp_replace(text, drop, "")).cast("bigint")


# The same characters spelled out, for translate().
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def spaced(text: Column) -> Column:
    """The text with every whitespace character as a plain space.

    One dictionary pass here leaves the counts below with one-character classes.
    """
    return F.translate(text, WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))


def whitespace_count(spaced_text: Column) -> Column:
    return (F.length(spaced_text) - F.length(F.replace(spaced_text, F.lit(" "), F.lit("")))).cast("bigint")


def word_count(spaced_text: Column) -> Column:
    """Number of maximal runs without whitespace."""
    return F.regexp_count(spaced_text, F.lit("[^ ]+")).cast("bigint")


def sentence_count(text: Column) -> Column:
    """Segments between full stops and line feeds that hold more than whitespace.

    A match starts at the first visible character of a segment and runs to its end.
    """
    return F.regexp_count(text, F.lit(rf"[^{WHITESPACE}.][^.\n]*")).cast("bigint")


def letter_count(text: Column) -> Column:
    return _matching(text, r"[^\p{L}]+")


def number_count(text: Column) -> Column:
    return _matching(text, r"[^\p{N}]+")


def uppercase_count(text: Column) -> Column:
    return _matching(text, r"[^\p{Lu}]+")


def ratio(part: Column, whole: Column, places: int) -> Column:
    """``part / whole`` rounded, 0 when there is no whole."""
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), places)
