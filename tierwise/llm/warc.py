"""WARC: archives as monolithic gzip, normalised to a member per record with a sidecar index.

``write_archives`` writes one archive per task, gzipped as a single stream (the
monolithic form that can't be read from the middle). ``normalise`` inflates each
archive once as a stream, rewrites every record as a gzip member of its own and
writes ``<archive>.idx`` beside it: offset, length, record type and id per
record. ``read_records`` reads the normalised archives by the index.

Archives live in the cluster's shared folder, reached with pyarrow's file
systems, so any executor reads what another wrote. A file is written under a
name of its own and then moved into place; a task that runs again writes the
same bytes.

Payloads that repeat are written once: of records with equal payloads that with
the largest page_id is the response and the others are revisits that name it;
payloads under ``min_bytes`` are always responses. Only (digest, page_id) rows
are shuffled to find that out, summed before the shuffle; the payloads of
repeated digests aren't brought together.

Memory: a task holds one Arrow batch and one record; archives are rolled at
``ROLL_BYTES`` of payload.

Defined cases: a null html or url is empty; rows that repeat a page_id and a
payload are all responses; a null page_id is never the largest: its record revisits the response of an
equal payload that has an id, and is a response where none has; a very long payload is one record in memory; an empty table gives no archives and no records;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import written

ROLL_BYTES = 64 << 20
LEVEL = 1                   # of both gzip forms
CHUNK = 1 << 20
GZIP = 31                   # zlib's window size for the gzip format
# One date for all records: archives are functions of the table.
DATE = "2024-01-01T00:00:00Z"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string, payload binary")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str):
    """(file system, folder path in it)."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class _Sink:
    """A file that appears under its name only when it is whole."""

    def __init__(self, filesystem, path: str):
        self.fs, self.path = filesystem, path
        self.part = f"{path}.{TaskContext.get().taskAttemptId()}.part"
        self.out = filesystem.open_output_stream(self.part)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC 1.0 record; a revisit has no payload."""
    lines = [f"WARC/1.0\r\nWARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Target-URI: {url}".replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = b"" if revisit else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names lowered) and body of one record."""
    end = data.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in data[:end].decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, data[end + 4:end + 4 + int(fields["content-length"])]


def records_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records from a byte stream that is cut anywhere."""
    held, need = bytearray(), 0
    for chunk in chunks:
        held += chunk
        while len(held) >= need:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            head = held[:end].lower()
            at = head.rindex(b"\r\ncontent-length:")
            need = end + 4 + int(head[at + 17:].split(b"\r\n")[0]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"the archive ends within a record ({len(held)} bytes)")


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip stream of any number of members, in bounded pieces."""
    unzip = zlib.decompressobj(GZIP)
    while chunk := stream.read(CHUNK):
        while chunk:
            out = unzip.decompress(chunk, 4 * CHUNK)
            if out:
                yield out
            if unzip.eof:
                chunk, unzip = unzip.unused_data, zlib.decompressobj(GZIP)
            else:
                chunk = unzip.unconsumed_tail


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (binary) and digest (SHA-1 in hex)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"))


def typed(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages with refers_to: the page_id of the response that a revisit repeats, else null."""
    p = with_digests(pages)
    again = (p.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 AND last IS NOT NULL")
             .select(F.col("digest").alias("again"), "last"))
    again = written(again, "warc-repeats")
    p = p.join(again, (F.col("digest") == F.col("again")) & (F.octet_length("payload") >= min_bytes), "left")
    return p.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the records as monolithic gzip archives; gives path and records of each."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        part, n_files, sink, done = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    sink = _Sink(fs, f"{base}/part-{part:06d}-{n_files:04d}.warc.gz")
                    zipped, size, n = zlib.compressobj(LEVEL, wbits=GZIP), 0, 0
                sink.out.write(zipped.compress(record(page_id, url, payload, _digest(payload), refers_to,
                                                      refers_to is not None)))
                size, n = size + len(payload), n + 1
                if size >= roll_bytes:
                    sink.out.write(zipped.flush())
                    sink.close()
                    done.append((sink.path, n))
                    sink, n_files = None, n_files + 1
        if sink is not None:
            sink.out.write(zipped.flush())
            sink.close()
            done.append((sink.path, n))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return written(typed(pages, min_bytes).mapInArrow(rows, "path string, records long"), "warc-archives")


def _paths(folder: str, batches: Iterator[pa.RecordBatch]):
    fs, _ = _open(folder)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            yield fs, path


def _dealt(archives: DataFrame) -> DataFrame:
    """path, an archive a task: these few rows stand for many bytes, so their partitions are not to be put together."""
    return archives.select("path").repartitionByRange(max(1, archives.count()), "path")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """archives: path. Rewrite each with a gzip member per record and write its index; gives path, index, records."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fs, path in _paths(folder, batches):
            new = path.removesuffix(".warc.gz") + ".members.warc.gz"
            sink, index, at = _Sink(fs, new), _Sink(fs, f"{new}.idx"), 0
            n = 0
            with fs.open_input_stream(path, compression=None) as source:
                for data in records_of(inflated(source)):
                    zipped = zlib.compressobj(LEVEL, wbits=GZIP)
                    member = zipped.compress(data) + zipped.flush()
                    sink.out.write(member)
                    kind = "revisit" if b"\r\nWARC-Profile: " in data[:data.index(b"\r\n\r\n")] else "response"
                    index.out.write(f"{at} {len(member)} {kind}\n".encode())
                    at, n = at + len(member), n + 1
            sink.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"path": [new], "index": [f"{new}.idx"], "records": pa.array([n], pa.int64())})

    return written(_dealt(archives).mapInArrow(rows, "path string, index string, records long"), "warc-normalised")


def read_records(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """archives: path, index. A row per record; payload is null unless asked for. Every member is found
    by its index entry, inflated and checked against its digest."""
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def batch(rows: list) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        cols = zip(*rows) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    def urn(value: str | None) -> int | None:
        found = (value or "").removeprefix("<urn:page:").removesuffix(">")
        return int(found) if found not in ("", "None") else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fs, path in _paths(folder, batches):
            got = []
            with fs.open_input_stream(f"{path}.idx", compression=None) as f:
                entries = [line.split() for line in f.read().decode().splitlines()]
            with fs.open_input_file(path) as source:
                for offset, length, kind in entries:
                    source.seek(int(offset))
                    h, body = parse(zlib.decompress(source.read(int(length)), GZIP))
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    if kind != h["warc-type"] or kind == "response" and _digest(body) != digest:
                        raise ValueError(f"{path} at {offset}: the record differs from its index entry or digest")
                    got.append((urn(h["warc-record-id"]), int(h["x-payload-length"]), digest, kind,
                                urn(h.get("warc-refers-to")), h["warc-target-uri"], body if payloads else None))
                    if len(got) == 1000:
                        yield batch(got)
                        got = []
            yield batch(got)

    return _dealt(archives).mapInArrow(rows, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Write pages as monolithic archives, normalise them and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    monolithic = write_archives(pages, folder, min_bytes)
    return read_records(normalise(monolithic, folder), folder, payloads)
