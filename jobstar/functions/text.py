"""Column expressions for text cleaning (built-ins only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every Unicode White_Space code point, written as an explicit class so that the
# Java engine and RE2 (used by the SQL oracle) agree on what a blank is.
WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def normalize_name(c: Column) -> Column:
    """``lower(trim(x))``: the key used to group companies and titles."""
    return F.lower(F.trim(c))


def collapse_whitespace(c: Column) -> Column:
    """Runs of any whitespace become one blank, then outer blanks are trimmed."""
    return F.trim(F.regexp_replace(c, WHITESPACE_CLASS + "+", " "))


def contains_text(c: Column, needle: str) -> Column:
    """``LIKE '%needle%'`` without wildcard interpretation."""
    return F.instr(c, needle) > 0
