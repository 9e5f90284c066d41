"""WARC archives, index first.

Tasks write one gzip member per record to archives in a shared folder and return the index:
archive, offset, length, url and digest of each record. A read selects index rows, sorts them by
archive and offset, coalesces near byte ranges, and opens each archive once per coalesced range.
Records of equal payload from ``min_bytes`` on are written once: the largest id is the response,
the others are ``revisit`` records without payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filegate.llm.staging import shared_path, shuffle_width, stage

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
#: A read fetches at most about this many bytes at once, and skips gaps of up to ``GAP_BYTES`` by reading them.
RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Payload digests that occur more than once, as far as they are broadcast (about 60 bytes each).
BROADCAST_DIGESTS = 200_000
RECORD_DATE = "1970-01-01T00:00:00Z"

INDEX = ("archive string, offset long, length long, url string, payload_digest string, page_id string, "
         "record_type string")
RECORDS = ("page_id string, url string, record_type string, refers_to string, payload_bytes long, "
           "payload_digest string, payload binary")


def _open(path: str):
    """Filesystem and path of a folder in the shared store (local, or a URI that Arrow's filesystems know)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _header(value: str) -> str:
    """A header value: control characters are percent-encoded, so that a value stays on its line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: str | None, url: str | None, payload: bytes, digest: str, size: int,
                 refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    kind = "response" if refers_to is None else "revisit"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    if refers_to is None:
        block += payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.0", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:x-record:{'none' if page_id is None else page_id}>", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-record:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    name = lambda v: None if v is None else (None if (k := v[len("<urn:x-record:"):-1]) == "none" else k)
    return {"page_id": name(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": name(fields.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all rows of ``pages`` as WARC records below ``folder``; returns the index, one row per record.

    A null html is an empty payload; a null url leaves out the target line; a null id is written
    as ``none`` and is never referred to while an equal payload has an id. Repeated rows of the
    largest id are all responses. Extra columns are not read; an empty table writes nothing.
    An attempt writes to a file of its own name, so the index (staged at once) only names files
    of attempts that were committed, also after a lost executor.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.cast("binary").alias("payload"), F.sha1(payload.cast("binary")).alias("digest"),
                        F.octet_length(payload).cast("long").alias("size"))
    repeated = stage(rows.filter(F.col("size") >= min_bytes).groupBy("digest")
                     .agg(F.max("id").alias("original"), F.count("*").alias("n"))
                     .filter("n > 1 and original is not null").drop("n"), "warc-repeated")
    small = repeated.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    roles = rows.join(F.broadcast(repeated) if small else repeated, "digest", "left")
    roles = roles.select("id", "url", "payload", "digest", "size",
                         F.when(F.col("id").eqNullSafe(F.col("original")), F.lit(None))
                         .otherwise(F.col("original")).alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        out, archive, offset, parts = None, "", 0, 0
        try:
            for batch in batches:
                for low in range(0, batch.num_rows, 1000):
                    index: list[tuple] = []
                    for page, url, raw, digest, size, refers in zip(
                            *(c.to_pylist() for c in batch.slice(low, 1000).columns), strict=True):
                        if out is None or offset >= archive_bytes:
                            if out is not None:
                                out.close()
                            store.create_dir(base, recursive=True)
                            archive, offset, parts = f"{name}-{parts:03d}.warc.gz", 0, parts + 1
                            out = store.open_output_stream(f"{base}/{archive}", compression=None)
                        key = None if page is None else str(page)
                        refers = None if refers is None else str(refers)
                        gz = zlib.compressobj(4, zlib.DEFLATED, 31)
                        member = gz.compress(record_bytes(key, url, raw, digest, size, refers)) + gz.flush()
                        out.write(member)
                        index.append((archive, offset, len(member), url, digest, key,
                                      "response" if refers is None else "revisit"))
                        offset += len(member)
                    if index:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX_TYPES, strict=True)],
                            names=_INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    return stage(roles.mapInArrow(write, INDEX), "warc-index")


_INDEX_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_INDEX_TYPES = [pa.int64() if f.split()[1] == "long" else pa.string() for f in INDEX.split(", ")]
_RECORD_NAMES = [f.split()[0] for f in RECORDS.split(", ")]
_RECORD_TYPES = [{"long": pa.int64(), "binary": pa.binary()}.get(f.split()[1], pa.string())
                 for f in RECORDS.split(", ")]


def coalesce_ranges(rows: list[tuple[str, int, int]], gap: int = GAP_BYTES,
                    most: int = RANGE_BYTES) -> Iterator[list[tuple[str, int, int]]]:
    """Runs of sorted (archive, offset, length) that one read fetches.

    A run ends where the archive changes, where more than ``gap`` bytes lie between, or
    before it spans more than ``most`` bytes (a longer record is a run of its own).
    """
    run: list[tuple[str, int, int]] = []
    for row in rows:
        if run and (row[0] != run[0][0] or row[1] - (run[-1][1] + run[-1][2]) > gap
                    or row[1] + row[2] - run[0][1] > most):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read_records(index: DataFrame, folder: str, gap: int = GAP_BYTES, most: int = RANGE_BYTES,
                 with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, read back from the archives and checked.

    Rows are dealt by archive and block of ``most`` bytes, so that neighbours meet in one task.
    """
    picked = index.select("archive", "offset", "length", F.expr(f"offset div {int(most)}").alias("block"))
    dealt = (picked.repartition(shuffle_width(index.sparkSession), "archive", "block")
             .sortWithinPartitions("archive", "offset"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True))
            for run in coalesce_ranges(rows, gap, most):
                with store.open_input_file(f"{base}/{run[0][0]}") as archive:
                    archive.seek(run[0][1])
                    raw = archive.read(run[-1][1] + run[-1][2] - run[0][1])
                found = [parse_record(zlib.decompress(raw[o - run[0][1]:o - run[0][1] + n], 31)) for _, o, n in run]
                if not with_payload:
                    for r in found:
                        r["payload"] = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in found], t) for c, t in zip(_RECORD_NAMES, _RECORD_TYPES, strict=True)],
                    names=_RECORD_NAMES)

    return dealt.mapInArrow(read, RECORDS)


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                    min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder and return what a full read finds, one row per page."""
    folder = shared_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, id_col, url_col, html_col, min_bytes)
    found = read_records(index, folder, with_payload=False)
    return found.select(F.col("page_id").cast("long").alias(id_col), "payload_bytes", "payload_digest",
                        "record_type", F.col("refers_to").cast("long").alias("refers_to"))
