"""WARC archives: written by tasks, read back by a sequential reader.

Writing: each task appends records to archives in the shared folder, one gzip
member per record, and begins a new archive after ``ARCHIVE_BYTES``.  Of
records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with
the smallest page_id is a response, the others are revisits that refer to it
and carry no payload.

Reading: one pass over each archive with incremental decompression.  A record
starts where the gzip member before it ended; its header block ends at the
empty line, ``Content-Length`` frames the block, the end of the member must
follow two line ends, and the payload's SHA-256 must equal its digest.
Records of any length are read in pieces of ``READ_BYTES``.

Defined results: null and empty payloads have no bytes and are responses; a
null page_id has no id header, refers to nothing and is never referred to;
rows that repeat page_id and payload are all responses if theirs is the
smallest page_id; an empty table gives no rows; other columns but url are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm import shared_files
from triplake.plans.materialize import materialize
from triplake.session import scratch_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 << 20
READ_BYTES = 1 << 16

# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8), digest, refers_to (null: response).

    Only digests that occur more than once are joined back, each with its
    smallest page_id; a hot digest is a skewed left side that AQE can split."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.where(F.length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def _header_text(value: str) -> str:
    """A header value must not hold line ends."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_text(url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("WARC-Record-ID", f"<urn:page:{page_id}>"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def write_archives(rows: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Writes the archives of ``rows`` (see ``with_revisits``); returns their
    folder and the manifest (archive, records) of the successful attempts."""
    folder = scratch_path(rows.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["archive", "records"])

        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(
                b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist()
            ):
                if out is None:
                    out, name = shared_files.new_file(folder, ".warc.gz")
                member = record(page_id, url, payload.as_py(), digest, refers_to)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    yield closed()
                    out, records, size = None, 0, 0
        if out is not None:
            yield closed()

    manifest = materialize(rows.mapInArrow(run, "archive string, records long"), "warc-manifest")
    return folder, manifest


class ArchiveReader:
    """Sequential records of one archive stream."""

    def __init__(self, stream: pa.NativeFile, name: str = "archive"):
        self.stream, self.name, self.rest = stream, name, b""

    def _member(self) -> Iterator[bytes]:
        """Decompressed pieces of the member at hand; what follows it stays in
        ``rest``."""
        z = zlib.decompressobj(31)
        while not z.eof:
            data = self.rest or self.stream.read(READ_BYTES)
            self.rest = b""
            if not data:
                raise ValueError(f"{self.name}: a record ends too early")
            while data and not z.eof:
                piece = z.decompress(data, READ_BYTES)
                data = z.unconsumed_tail
                if piece:
                    yield piece
        self.rest = z.unused_data

    def __iter__(self) -> Iterator[tuple[dict[str, str], int, str]]:
        """Header fields, block length and SHA-256 of the block."""
        while True:
            if not self.rest:
                self.rest = self.stream.read(READ_BYTES)
                if not self.rest:
                    return
            pieces = self._member()
            head = b""
            while (end := head.find(b"\r\n\r\n")) < 0:
                piece = next(pieces, None)
                if piece is None:
                    raise ValueError(f"{self.name}: a record without end of header")
                head += piece
            lines = head[:end].split(b"\r\n")
            if lines[0] != VERSION:
                raise ValueError(f"{self.name}: not a {VERSION.decode()} record")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
            left, digest = int(fields["content-length"]), hashlib.sha256()
            total, after, piece = left, b"", head[end + 4 :]
            while piece is not None:
                digest.update(piece[:left])
                after += piece[left:]
                left -= min(left, len(piece))
                if len(after) > 4:
                    break
                piece = next(pieces, None)
            if left or after != b"\r\n\r\n":
                raise ValueError(f"{self.name}: Content-Length does not frame the record")
            yield fields, total, digest.hexdigest()


def read_archives(folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest,
    record_type, refers_to; every response's digest is verified."""

    def number(urn: str | None) -> int | None:
        return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for archive, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, seen = [], 0
                with shared_files.read_file(folder, archive) as f:
                    for fields, length, digest in ArchiveReader(f, archive):
                        said = fields["warc-payload-digest"].removeprefix("sha256:")
                        if fields["warc-type"] == "response" and (digest != said or length != int(fields["x-payload-length"])):
                            raise ValueError(f"{archive}: the payload of record {seen} does not have its digest")
                        rows.append(
                            (number(fields.get("warc-record-id")), int(fields["x-payload-length"]), said, fields["warc-type"], number(fields.get("warc-refers-to")))
                        )
                        seen += 1
                        if len(rows) == 8192:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows = []
                if seen != records:
                    raise ValueError(f"{archive}: {seen} records instead of {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    # an archive per task; without the number, adaptive execution would merge
    # the manifest's few rows into one task, which then reads every archive
    return manifest.repartitionByRange(max(1, manifest.count()), "archive").mapInArrow(run, RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes a record per page, reads the archives back."""
    folder, manifest = write_archives(with_revisits(pages))
    return read_archives(folder, manifest)
