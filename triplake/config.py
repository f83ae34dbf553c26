"""Run configuration: quality-rule thresholds, month bounds and lake layout."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

_MONTH = re.compile(r"^(\d{4})-(\d{1,2})$")


def parse_month(text: str) -> tuple[int, int]:
    """Parse a ``YYYY-MM`` bound; raise ``ValueError`` for anything else."""
    m = _MONTH.match(text.strip()) if isinstance(text, str) else None
    if m is None or not 1 <= int(m.group(2)) <= 12:
        raise ValueError(f"month bound {text!r} is invalid; expected YYYY-MM (e.g. 2025-11)")
    return int(m.group(1)), int(m.group(2))


def next_month(year: int, month: int) -> tuple[int, int]:
    return (year + 1, 1) if month == 12 else (year, month + 1)


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the silver quality rules.

    Defaults are the fixed values of the source pipeline: trips under 12 hours,
    distance in [0, 200) miles, total amount in (0, 1000), party of 1..9 or
    unknown, pickups from 2019 on.  ``last_month`` (``YYYY-MM``) optionally
    bounds pickups from above, inclusive of that whole month.
    """

    max_minutes: float = 720.0
    min_distance: float = 0.0
    max_distance: float = 200.0
    min_amount: float = 0.0
    max_amount: float = 1000.0
    min_passengers: float = 1.0
    max_passengers: float = 9.0
    min_year: int = 2019
    last_month: str | None = None

    def __post_init__(self) -> None:
        if self.last_month is not None:
            parse_month(self.last_month)

    @property
    def upper_bound(self) -> tuple[int, int] | None:
        """First month *excluded* by ``last_month`` (exclusive upper bound)."""
        if self.last_month is None:
            return None
        return next_month(*parse_month(self.last_month))


@dataclass(frozen=True)
class GoldOptions:
    """Gold aggregation options.

    ``drop_null_zone`` drops trips without a pickup zone from ``trips_by_zone``.
    ``duration_scale`` is the number of decimals silver's duration is rounded
    to (at most 5), None for the unrounded duration (whole seconds).
    """

    drop_null_zone: bool = True
    duration_scale: int | None = None


# The tables of the layers that have one.
LAYER_TABLES = {"bronze": "tlc_trips_raw", "silver": "tlc_trips"}


@dataclass(frozen=True)
class Lake:
    """Layer locations under one root URI (local path or object store), and
    the catalog names of their tables.

    Each layer is a schema whose folder is the layer's; ``catalog`` names the
    lake in the catalog (by default a name made from its root)."""

    root: str
    fmt: str = "parquet"
    catalog: str | None = None

    @property
    def _prefix(self) -> str:
        return self.catalog or f"lake_{hashlib.sha256(self.root.rstrip('/').encode()).hexdigest()[:16]}"

    def schema(self, layer: str) -> str:
        return f"{self._prefix}_{layer}"

    def table(self, layer: str, name: str | None = None) -> str:
        """Catalog name of a layer's table."""
        return f"{self.schema(layer)}.{name or LAYER_TABLES[layer]}"

    def folder(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def bronze(self, name: str = LAYER_TABLES["bronze"]) -> str:
        return self._path("bronze", name)

    def silver(self, name: str = LAYER_TABLES["silver"]) -> str:
        return self._path("silver", name)

    def gold(self, name: str) -> str:
        return self._path("gold", name)

    def checkpoint(self, name: str) -> str:
        return self._path("_checkpoints", name)
