"""Cleaning of dirty text columns.

Source tables mix two conventions for a missing value (NULL and the empty
string), keep numbers together with their unit ("23.4 km", "25mins") and
store id lists as comma separated strings ("1, 5").  These helpers turn such
columns into typed values with built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a number is the first run of digits and dots in the text.
NUMBER_PATTERN = "[0-9.]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_present(col) -> Column:
    """True when the value is neither NULL nor the empty string (never NULL)."""
    c = _c(col)
    return F.coalesce(F.length(c) > 0, F.lit(False))


def number_in_text(col, pattern: str = NUMBER_PATTERN) -> Column:
    """First number inside a string as a double; NULL when none can be read.

    ``regexp_substr`` yields NULL (not '') on no match and ``try_cast`` yields
    NULL for runs such as '1.2.3' that the pattern admits but are no number.
    """
    return F.regexp_substr(_c(col), F.lit(pattern)).try_cast("double")


def id_list(col) -> Column:
    """Comma separated id list → array of distinct, non-empty id strings.

    Spaces are dropped first ("1, 5" → ["1", "5"]).  An id listed twice counts
    once, like a set-membership test.  NULL and '' give an empty array.
    """
    parts = F.split(F.replace(_c(col), F.lit(" "), F.lit("")), ",")
    cleaned = F.array_distinct(F.filter(parts, lambda x: F.length(x) > 0))
    return F.coalesce(cleaned, F.array().cast("array<string>"))


def words(col) -> Column:
    """Whitespace separated words of a text as an array (empty for NULL)."""
    parts = F.split(F.trim(_c(col)), r"\s+")
    return F.coalesce(F.filter(parts, lambda x: F.length(x) > 0), F.array().cast("array<string>"))


def counted_label(count_col, name_col) -> Column:
    """'name' for a count of one, '<n>xname' when the item occurs n > 1 times."""
    n, name = _c(count_col), _c(name_col)
    return F.when(n > 1, F.concat(n.cast("string"), F.lit("x"), name)).otherwise(name)


def optional_part(prefix: str, col) -> Column:
    """``prefix || value`` when the value is not NULL, else ''."""
    return F.coalesce(F.concat(F.lit(prefix), _c(col)), F.lit(""))
