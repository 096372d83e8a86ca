"""Text expressions: trimming, regular-expression search, split and replace."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters str.strip() and the \s class treat as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as a class: all beyond Latin-1 are the separators of Unicode. Single
# characters and one property match about three times faster than ranges.
WHITESPACE_CLASS = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\p{Z}]"
# Word characters are letters, numbers and underscore of every script.
EMAIL_PATTERN = r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+"
PHONE_PATTERN = r"\p{Nd}{10}"
PHONE_MASK = "XXXXXXXXXX"


def strip(col: Column | str) -> Column:
    """Trim all Unicode white space from both ends; inner runs stay as they are."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(WHITESPACE))


def strip_to_null(col: Column | str) -> Column:
    """Trim, and turn text that is empty afterwards into NULL."""
    return F.nullif(strip(col), F.lit(""))


def is_blank(col: Column | str) -> Column:
    text = F.col(col) if isinstance(col, str) else col
    return text.isNull() | (strip(text) == "")


def find_all(col: Column | str, pattern: str = EMAIL_PATTERN) -> Column:
    """Every match of ``pattern`` in order, as an array."""
    return F.regexp_extract_all(col, F.lit(pattern), F.lit(0))


def find_emails(col: Column | str) -> Column:
    """Every e-mail address in order. Text without an @ is not searched at all."""
    text = F.col(col) if isinstance(col, str) else col
    none = F.when(text.isNotNull(), F.array().cast("array<string>"))
    return F.when(F.contains(text, F.lit("@")), find_all(text)).otherwise(none)


def split_words(col: Column | str) -> Column:
    """Split the trimmed text on runs of white space."""
    return F.split(strip(col), WHITESPACE_CLASS + "+")


def mask(col: Column | str, pattern: str = PHONE_PATTERN, replacement: str = PHONE_MASK) -> Column:
    return F.regexp_replace(col, pattern, replacement)
