"""Column expressions for Python-compatible string rules.

All of these are Catalyst expressions (regex, higher-order functions), so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes exactly the characters for which
# str.isspace() is true (29 code points, derived here from Python itself).
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
# Python's str.isalnum() over any code point == a letter or a number.
ALNUM_PATTERN = r"[\p{L}\p{N}]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """``str.strip()``: trims the white-space set from both ends (no regex)."""
    return F.btrim(_c(x), F.lit(WHITESPACE))


def whitespace_sql() -> str:
    """The same character set as a DuckDB/ANSI SQL expression."""
    return "(" + "||".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


def norm(x) -> Column:
    """``str.strip().lower()``."""
    return F.lower(py_strip(x))


def blank_to_empty(x) -> Column:
    """NULL text counts as the empty string."""
    return F.coalesce(_c(x), F.lit(""))


def is_valid_option(x) -> Column:
    """An option is valid iff it has a letter or number (circled digits are numbers)."""
    return _c(x).rlike(ALNUM_PATTERN)


def total_length(text="text", question="question", options="options") -> Column:
    """len(text) + len(question) + sum(len(option))."""
    return (F.length(blank_to_empty(text)) + F.length(blank_to_empty(question))
            + F.aggregate(_c(options), F.lit(0).cast("bigint"),
                          lambda acc, x: acc + F.length(x))).cast("bigint")


def label_letter(label="label") -> Column:
    """0 -> 'A', 1 -> 'B', ..."""
    return F.char(F.lit(65) + _c(label))


def letter_label(letter="answer") -> Column:
    """'A' -> 0 for a single upper-case letter, else NULL."""
    c = F.upper(_c(letter))
    return F.when(F.length(c) == 1, F.ascii(c) - 65).cast("bigint")


def options_block(options="options", sep=". ", joiner="\n", fmt=None) -> Column:
    """'A. opt\\nB. opt' (letters by position)."""
    return F.array_join(
        F.transform(_c(options), lambda x, i: F.concat(F.char(i + 65), F.lit(sep), x)), joiner)


def options_inline(options="options") -> Column:
    """'(A) opt (B) opt'."""
    return F.array_join(
        F.transform(_c(options), lambda x, i: F.concat(F.lit("("), F.char(i + 65), F.lit(") "), x)), " ")
