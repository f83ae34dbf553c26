"""Presentation columns: weekday names, hour labels, number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names for Spark's dayofweek numbering (Sunday = 1).
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
WEEKEND_DAYS = (1, 7)


def day_name(dow: Column | str) -> Column:
    """Name of a 1-based (Sunday = 1) weekday number; NULL outside 1..7."""
    d = F.col(dow) if isinstance(dow, str) else dow
    return F.try_element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), d)


def is_weekend(dow: Column | str) -> Column:
    d = F.col(dow) if isinstance(dow, str) else dow
    return d.isin(*WEEKEND_DAYS)


def hour_label(hour: Column | str) -> Column:
    """``HH:00``; NULL for a NULL hour."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return F.when(h.isNotNull(), F.format_string("%02d:00", h))


def millions(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c / F.lit(1_000_000.0)


def fixed(c: Column | str, decimals: int) -> Column:
    """Text of ``c`` with ``decimals`` digits, as Python's ``f"{x:.2f}"``
    writes it: rounded half to even from the exact binary value, no
    separators.  (``format_string("%.2f")`` rounds the shortest decimal text
    half up instead: 2.675 gives 2.68 there and 2.67 in Python.)"""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.format_number(c, decimals), ",", "")
