"""Date expressions.

All are built-in column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(value) -> Column:
    """A Python datetime as a wall-clock ``timestamp_ntz`` literal.
    ``F.lit(datetime)`` would make a zone-dependent TIMESTAMP (interpreted in
    the Python process's zone, then shown in the session's); going through the
    text form keeps the wall clock whatever the zones are."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def as_date(c) -> Column:
    """timestamp / timestamp_ntz / ISO string -> date."""
    return _col(c).cast("date")


def monday_week_number(c) -> Column:
    """Week of year, Monday as first weekday, 0..53; days before the first
    Monday of the year are week 0 (the C ``%W`` rule)."""
    d = as_date(c)
    return F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")


def week_label(c, sep: str = "-W") -> Column:
    """``YYYY-Www`` label with Monday weeks (``%Y-W%W``); ``sep='-'`` gives ``%Y-%W``."""
    d = as_date(c)
    return F.concat(F.year(d).cast("string"), F.lit(sep),
                    F.lpad(monday_week_number(d).cast("string"), 2, "0"))


def week_start(c) -> Column:
    """Monday on or before the date."""
    return F.date_trunc("week", as_date(c)).cast("date")


def month_name(c) -> Column:
    return F.date_format(as_date(c), "MMMM")


def day_of_week_sunday0(c) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(as_date(c)) - 1).cast("int")


def is_weekend(c) -> Column:
    return day_of_week_sunday0(c).isin(0, 6).cast("int")


def parse_wall_clock(c) -> Column:
    """Text ``YYYY-MM-DD[ T]HH:MM:SS[.fff][Z]`` (or a date) -> timestamp_ntz.

    A cast to timestamp_ntz does not involve the session time zone, and
    ``try_cast`` gives NULL for anything unparseable instead of failing."""
    s = _col(c).cast("string")
    # the pattern costs more than the cast: only where there is a Z
    return F.when(F.contains(s, F.lit("Z")), F.regexp_replace(s, "Z$", "")).otherwise(s).try_cast("timestamp_ntz")


def shift_fixed_hours(c, hours: int = 8) -> Column:
    """Local wall clock + a fixed offset (Pacific -> UTC as +8 h, ignoring
    daylight saving, which is what the source system does).  Bad or empty
    input gives NULL."""
    return parse_wall_clock(c) + F.expr(f"INTERVAL {int(hours)} HOURS")


def shift_zone_to_utc(c, zone: str = "America/Los_Angeles") -> Column:
    """Zone-aware alternative to :func:`shift_fixed_hours` (honours DST)."""
    return F.to_utc_timestamp(parse_wall_clock(c), zone).cast("timestamp_ntz")


def format_wall_clock(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")
