"""Text column functions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that separate words, as Python's str.split
# and str.strip see them, first as a Java pattern and then as plain characters.
# The intersection lets the matcher pass ASCII letters after one range test.
WORD_BREAK = (
    r"[\x00-\x20\x7f-\uffff&&[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a"
    r"\u2028\u2029\u202f\u205f\u3000]]+"
)
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SECTION_PREFIX = "section_"


def words(text: Column) -> Column:
    """Words between runs of Unicode whitespace, without empty ones."""
    return F.array_remove(F.split(text, WORD_BREAK), "")


def token_count(text: Column) -> Column:
    """Number of words; NULL for a NULL text."""
    return F.array_size(words(text))


def word_slice(word_array: Column, start: Column, length: Column) -> Column:
    """``length`` words from the 0-based ``start``, joined by one space."""
    return F.array_join(F.slice(word_array, start + 1, length), " ")


def strip_left(text: Column) -> Column:
    """Remove Unicode whitespace from the start."""
    return F.ltrim(text, F.lit(BLANKS))


def strip_right(text: Column) -> Column:
    """Remove Unicode whitespace from the end.

    Trimming a set of characters from the right walks the whole text, so texts that
    end in another character skip it.
    """
    blank_end = F.position(F.substring(text, -1, 1), F.lit(BLANKS)) > 0
    return F.when(blank_end, F.rtrim(text, F.lit(BLANKS))).otherwise(text)


def section_number(name: Column) -> Column:
    """``section_1A`` -> ``1A``."""
    return F.regexp_replace(name, f"^{SECTION_PREFIX}", "")


def section_name(number: Column) -> Column:
    """``1A`` -> ``section_1A``."""
    return F.concat(F.lit(SECTION_PREFIX), number)
