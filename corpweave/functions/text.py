"""Text cleaning as native column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; all of them lie below U+3001.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same characters as a regular-expression class body both Java and RE2 understand.
WHITESPACE_CLASS = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANK_OR_JUNK = r"^[\p{Nd}\p{Punct}" + WHITESPACE_CLASS + r"]*$"
BLANK = r"^[" + WHITESPACE_CLASS + r"]*$"
WORD_BREAK = r"[^\p{L}\p{N}]+"

# Accented Latin letters whose canonical decomposition starts with an ASCII letter, derived from Unicode data:
# Latin-1 to Latin Extended-B, and Latin Extended Additional (Vietnamese among them).
_FOLDABLE = {
    chr(c): base
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))
    for base in [unicodedata.normalize("NFD", chr(c))[0]]
    if base.isascii() and base != chr(c)
}


def strip(c: Column) -> Column:
    """Trim every kind of whitespace (``trim`` alone removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def soft_string(c: Column, min_length: int = 0, keep_numeric: bool = False) -> Column:
    """Trimmed text, or null when blank, too short, or nothing but digits and punctuation.

    ``keep_numeric`` is for postal codes, which may be all digits.
    """
    keep = ~c.rlike(BLANK if keep_numeric else BLANK_OR_JUNK)
    if min_length > 1:
        keep = keep & (F.length(strip(c)) >= min_length)
    return F.when(keep, strip(c))


def soft_int(c: Column) -> Column:
    """Non-negative whole number read from text or an integer column; anything else becomes null."""
    text = c.cast("string")
    well_formed = text.rlike(r"^[\s]*[+-]?[0-9]+(_[0-9]+)*(\.0+)?[\s]*$")
    digits = F.regexp_replace(F.regexp_extract(text, r"([+-]?[0-9_]+)", 1), "_", "")
    number = digits.try_cast("bigint")
    return F.when(well_formed & (number >= 0), number)


def soft_int_from_double(c: Column) -> Column:
    """As :func:`soft_int` for a floating column: whole, non-negative values only."""
    return F.when((c >= 0) & (c == F.floor(c)), c.try_cast("bigint"))


def split_keywords(c: Column, separator: str) -> Column:
    """Keyword list from separated text: trimmed, blanks and junk dropped, null gives an empty list."""
    return clean_keywords(F.split(c, "[" + separator + "]"))


def clean_keywords(items: Column) -> Column:
    """The same cleaning for a column that already holds a list."""
    cleaned = F.filter(F.transform(items, lambda item: soft_string(item)), lambda item: item.isNotNull())
    return F.coalesce(cleaned, F.array().cast("array<string>"))


def tokenise(c: Column) -> Column:
    """Lower-case word tokens: runs of letters and digits."""
    return F.filter(F.split(F.lower(c), WORD_BREAK), lambda token: token != "")


def normalise_keyword(c: Column) -> Column:
    """Lower case with Latin accents folded to ASCII, for exact keyword matching."""
    letters = {ch.lower(): base.lower() for ch, base in _FOLDABLE.items() if len(ch.lower()) == 1}
    composed = F.regexp_replace(F.lower(c), r"(?<=[a-z])\p{Mn}+", "")
    folded = F.translate(composed, "".join(letters), "".join(letters.values()))
    for ligature, plain in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("ł", "l"), ("đ", "d")):
        folded = F.replace(folded, F.lit(ligature), F.lit(plain))
    return folded


def joined(items: Column) -> Column:
    """Keyword list as one text for embedding."""
    return F.array_join(items, " | ")


def global_text(*parts: Column) -> Column:
    """All text parts of a record joined by a space, empty parts left out."""
    return F.concat_ws(" ", *[F.when(part != "", part) for part in parts])
