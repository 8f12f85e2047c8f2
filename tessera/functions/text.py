"""Column-level text functions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python ``str.isprintable`` treats categories C* and Z* as not printable,
# except the ASCII space.  Passed as a literal (never through SQL text, where
# backslash escapes would be rewritten).
NON_PRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"
# Python ``str.strip()`` whitespace, written out (Java ``\s`` differs).
WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
WORD_SPLIT = r"[ \t\n\r\f]+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(c) -> Column:
    """Length in code points, as BIGINT."""
    return F.length(col(c)).cast("bigint")


def distinct_chars(c) -> Column:
    """Number of distinct code points."""
    return F.size(F.array_distinct(F.split(col(c), ""))).cast("bigint")


def printable_chars(c) -> Column:
    return F.length(F.regexp_replace(col(c), F.lit(NON_PRINTABLE), F.lit(""))).cast("bigint")


def safe_ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.greatest(den, F.lit(1)).cast("double")


def py_strip(c) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` strips spaces only)."""
    pattern = f"^{WS_CLASS}+|{WS_CLASS}+$"
    return F.regexp_replace(col(c), F.lit(pattern), F.lit(""))


def capitalize(c) -> Column:
    """Python ``str.capitalize()``: first upper, rest lower (not ``initcap``)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def words(c) -> Column:
    """Whitespace words, empties removed."""
    parts = F.split(col(c), F.lit(WORD_SPLIT))
    return F.filter(parts, lambda w: w != F.lit(""))


def prefix(c, n: int | None) -> Column:
    """First ``n`` characters, or the whole text when ``n`` is None."""
    return col(c) if n is None else F.substring(col(c), 1, n)


def text_key(c, prefix_chars: int | None) -> Column:
    """SHA-256 hex of the (prefix of the) text: the dedup key."""
    return F.sha2(prefix(c, prefix_chars), 256)
