"""Text cleaning and strict number parsing.

Parsing never aborts a job: a value that is present but does not parse
becomes NULL and is reported by :func:`bad_number`, so the caller can route
such rows to a quarantine table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (the source system strips with
# it): every code point for which str.isspace() is true.  Built from that rule
# rather than listed; all of them lie below U+3001.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """str.strip(): remove leading/trailing whitespace (tabs, newlines,
    non-breaking and other Unicode spaces too).  ``trim`` with a character
    set is a plain scan, much cheaper than a Unicode regex."""
    return F.trim(_col(c).cast("string"), F.lit(WHITESPACE))


def empty_to_null(c) -> Column:
    return F.nullif(strip_all(c), F.lit(""))


def missing_to_empty(c) -> Column:
    """Optional text column: NULL -> '' after stripping."""
    return F.coalesce(strip_all(c), F.lit(""))


# Each failing try_cast raises and drops an exception, far dearer than the cast: texts
# that can't be numbers are told apart first.  Casts to bigint and decimal take digits,
# signs, a point, an exponent, and white space around them, nothing else.
_NO_NUMBER = r"[^\p{Nd}+\-.eE\s\p{Cntrl}]"


def long_of(s: Column) -> Column:
    """Integer of a stripped text (see :func:`to_long`)."""
    s = F.nullif(s, F.lit(""))
    plain = s.rlike(r"^[+-]?[0-9]{1,18}(\.[0-9]*)?$") | ~s.rlike(_NO_NUMBER)
    return F.when(plain, F.coalesce(
        # no integer has a point
        F.when(~F.contains(s, F.lit(".")), s.try_cast("bigint")),
        s.try_cast("decimal(38,6)").try_cast("bigint")))


def double_of(s: Column) -> Column:
    """Number of a stripped text."""
    return F.nullif(s, F.lit("")).try_cast("double")


def unparsed(s: Column, parsed: Column) -> Column:
    """True where a stripped text is present but did not parse."""
    return F.coalesce(s != "", F.lit(False)) & parsed.isNull()


def to_long(c) -> Column:
    """Integer text -> bigint. ``'6.0'`` is accepted and truncated like
    ``int(float(x))``; anything else that is non-empty gives NULL."""
    return long_of(strip_all(c))


def to_double(c) -> Column:
    return double_of(strip_all(c))


def to_double_or_zero(c) -> Column:
    return F.coalesce(to_double(c), F.lit(0.0))


def bad_number(raw, parsed) -> Column:
    """True where the raw text is present but did not parse."""
    return unparsed(strip_all(raw), _col(parsed))


def upper_or_null(c) -> Column:
    return F.upper(empty_to_null(c))


# What the silver and reporting decimals hold with room for sums; a larger amount,
# NaN or an infinity is quarantined when it is read.
LARGEST_AMOUNT = 1e13


def out_of_range(c) -> Column:
    """True for a number that is NaN, infinite or of ``LARGEST_AMOUNT`` or more."""
    x = _col(c)
    return F.coalesce(F.isnan(x) | (F.abs(x) >= LARGEST_AMOUNT), F.lit(False))
