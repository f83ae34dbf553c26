"""Names of columns that a frame does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name
