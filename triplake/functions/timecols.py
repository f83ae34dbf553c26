"""Date/time column helpers (TIMESTAMP_NTZ throughout)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(year: int, month: int = 1, day: int = 1) -> Column:
    """A TIMESTAMP_NTZ literal at midnight; folds to a constant the scan can push down."""
    return F.lit(dt.datetime(year, month, day).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since the epoch (floors sub-second parts, no zone shift on NTZ)."""
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in whole seconds, as the source pipeline measures trips."""
    return epoch_seconds(end) - epoch_seconds(start)


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month as a DATE."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return F.make_date(y, m, F.lit(1))


def month_label(period: Column) -> Column:
    """``yyyy-MM``."""
    return F.date_format(period, "yyyy-MM")


def long_month_label(period: Column) -> Column:
    """``MMMM yyyy`` (e.g. ``April 2020``)."""
    return F.date_format(period, "MMMM yyyy")


def month_key(year: Column | str, month: Column | str) -> Column:
    """Sortable integer ``year * 12 + month - 1``."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return y * 12 + m - 1
