"""Exact, partition-independent sums and means.

Summing doubles makes the result depend on the order in which partial
aggregates are merged, i.e. on the cluster layout.  Measured values (amounts,
distances, parties) are summed as decimals with ``DECIMALS`` fraction digits:
values of up to that many decimals are summed as they are stored, none is
rounded to cents first.  Values that silver makes itself (durations, whole
seconds) and rounded gold figures are summed as integer counts of their
quantum.  Both are divided once at the end, so a mean is the same on any
number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fraction digits of decimal sums.  18 digits in all keep a value in a long.
DECIMALS = 6
DECIMAL_TYPE = f"decimal(18,{DECIMALS})"


def decimal_sum(c: Column | str) -> Column:
    """Aggregate: exact sum of ``c`` as a decimal.  A value that is not finite
    or has more than 12 digits before the point counts as NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.try_cast(DECIMAL_TYPE))


def decimal_count(c: Column | str) -> Column:
    """Aggregate: number of values that ``decimal_sum`` adds up."""
    c = F.col(c) if isinstance(c, str) else c
    return F.count(c.try_cast(DECIMAL_TYPE))


def quanta(c: Column | str, per_unit: int) -> Column:
    """``c`` as an integer number of ``1/per_unit`` quanta (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * F.lit(float(per_unit))).cast("long")


def quanta_sum(c: Column | str, per_unit: int) -> Column:
    return F.sum(quanta(c, per_unit))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as doubles; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def mean_of_quanta(q_sum: Column, n: Column, per_unit: int) -> Column:
    """Mean from a quanta sum and a non-NULL count: ``q_sum / (n * per_unit)``."""
    return ratio(q_sum, n * F.lit(per_unit))


def python_round(c: Column | str, decimals: int) -> Column:
    """``round(x, decimals)`` as Python computes it on a float: half to even
    on the exact binary value (0.15 -> 0.1, 2.675 -> 2.67).  ``bround`` rounds
    the shortest decimal text instead (0.15 -> 0.2).  ``format_number`` rounds
    the exact binary value half to even, so its text without separators,
    read back as a double, is Python's result.  Meant for one-row report
    figures, not per-row hot paths."""
    c = F.col(c) if isinstance(c, str) else c
    # try_cast: a non-finite input formats as a symbol and becomes NULL, not a job failure
    return F.regexp_replace(F.format_number(c, decimals), ",", "").try_cast("double")


def numpy_round(c: Column | str, decimals: int) -> Column:
    """``round(x, decimals)`` on a numpy float (what the report gets for
    figures computed from fetched counts): scale by ``10**decimals``, round
    half to even on the binary value (``rint``), scale back."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(10**decimals))
    return F.rint(c * scale) / scale
