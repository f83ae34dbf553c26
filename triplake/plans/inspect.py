"""Looking at results and plans: previews, fetches by pages, plan text."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import TimestampType


def preview(df: DataFrame, n: int = 5, schema: bool = True) -> None:
    """Print the schema and the first ``n`` rows (untruncated)."""
    if schema:
        df.printSchema()
    df.show(n, truncate=False)


def fetch_pages(df: DataFrame, page_rows: int = 50_000) -> Iterator[pd.DataFrame]:
    """The rows in order, a page at a time.

    Tasks make the pages (Arrow batches of at most ``page_rows`` rows as
    binary values); the driver holds those of one partition at a time."""

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, page_rows):
                part = b.slice(at, page_rows)
                out = io.BytesIO()
                with pa.ipc.new_stream(out, part.schema) as writer:
                    writer.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], names=["page"])

    for row in df.mapInArrow(pages, "page binary").toLocalIterator():
        yield _naive(pa.ipc.open_stream(row["page"]).read_all(), df)


def _naive(table: pa.Table, df: DataFrame) -> pd.DataFrame:
    """As ``toPandas``: instants without a zone, in the session's."""
    pdf = table.to_pandas(date_as_object=True)
    for field in df.schema.fields:
        if isinstance(field.dataType, TimestampType):
            zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
            pdf[field.name] = pdf[field.name].dt.tz_convert(zone).dt.tz_localize(None)
    return pdf


def fetch(df: DataFrame, page_rows: int = 50_000) -> pd.DataFrame:
    """A result as one pandas frame, fetched by pages.  It should be an
    aggregated one: the caller holds all of it (``fetch_pages`` does not)."""
    found = list(fetch_pages(df, page_rows))
    return pd.concat(found, ignore_index=True) if found else df.limit(0).toPandas()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
