"""Lap and qualifying time text -> milliseconds (F1, F2), as Column expressions.

Accepted text: 'M:SS.mmm' or 'SS.mmm'.  Anything else is NULL (lap times)
or -1 (qualifying times).  Two arithmetic modes:

* exact (default): the seconds text is read as a decimal, so '1:02.026'
  gives 62026;
* parity: seconds read as a binary double and the product truncated, which
  is what a float-based parser yields ('1:02.026' -> 62025).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def _parts(text: Column):
    parts = F.split(text, ":")
    return parts, F.size(parts)


def _seconds_double(p: Column) -> Column:
    d = p.try_cast("double")
    return F.when(~F.isnan(d), d)


def _seconds_exact(p: Column) -> Column:
    return p.try_cast("decimal(28,9)")


def _ms(minutes: Column, seconds: Column, parity: bool) -> Column:
    """NULL where the result is no 64-bit number (overflow, infinite seconds)."""
    if parity:
        return ((minutes.cast("double") * 60 + seconds) * 1000).try_cast("bigint")
    return (minutes.cast("decimal(20,0)") * 60000 + seconds * 1000).try_cast("bigint")


def time_to_ms(col: str | Column, parity: bool = False) -> Column:
    """lap time text -> ms; NULL for null, bad text, or three or more parts."""
    text = F.col(col) if isinstance(col, str) else col
    parts, n = _parts(text)
    secs = _seconds_double if parity else _seconds_exact
    p0, p1 = parts.getItem(0), parts.getItem(1)
    mins = F.when(p0.rlike(_INT_TEXT), F.trim(p0).try_cast("bigint"))
    two = _ms(mins, secs(p1), parity)
    one = _ms(F.lit(0).cast("bigint"), secs(p0), parity)
    return F.when(n == 2, two).when(n == 1, one).cast("bigint")


def qual_time_to_ms(col: str | Column, parity: bool = False) -> Column:
    """qualifying time text -> ms; -1 for null or bad text.

    With a colon and exactly two parts: minutes and seconds; with any other
    number of parts the first part is read as seconds.
    """
    text = F.col(col) if isinstance(col, str) else col
    parts, n = _parts(text)
    secs = _seconds_double if parity else _seconds_exact
    p0, p1 = parts.getItem(0), parts.getItem(1)
    mins = F.when(p0.rlike(_INT_TEXT), F.trim(p0).try_cast("bigint"))
    two = _ms(mins, secs(p1), parity)
    other = _ms(F.lit(0).cast("bigint"), secs(p0), parity)
    v = F.when(n == 2, two).otherwise(other)
    return F.coalesce(v.cast("bigint"), F.lit(-1).cast("bigint"))
