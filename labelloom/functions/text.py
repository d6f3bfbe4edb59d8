"""Text expressions. All of them are built-ins and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of white space as Python sees it: Unicode spaces and the four
# separators 0x1c-0x1f, which Java's \s leaves out even with (?U).
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# The same set as single characters, taken from Python's own definition.
WHITESPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def clean_text(col: Column | str) -> Column:
    """Strip, and turn every white-space run into one space. Case and
    punctuation are kept."""
    return F.trim(F.regexp_replace(col, WHITESPACE_RUN, " "))


def compare_key(col: Column | str) -> Column:
    """Strip and lower-case; inner white space is left as it is."""
    return F.lower(F.btrim(col, F.lit(WHITESPACE_CHARS)))


def word_count(col: Column | str) -> Column:
    """White-space separated words; 0 for blank text, null for null."""
    cleaned = clean_text(col)
    blank = (cleaned == F.lit("")).cast("int")
    return F.array_size(F.split(cleaned, " ")) - blank


def digest(col: Column | str) -> Column:
    """32-byte SHA-256 of a text. Grouping on it moves 32 bytes per row
    through the shuffle in place of a text of any length; null stays null."""
    return F.unhex(F.sha2(col, 256))
