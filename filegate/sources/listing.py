"""Landing listing spread over tasks: each task lists its own prefixes, so file statuses never gather in the driver.

``binaryFile`` lists a folder through the driver, which holds one status per file for the whole scan. Here
the driver sees folder names down to ``depth``; tasks walk what lies below them and read the bytes of
names that may be manifests. For stores that Arrow opens by URI (local, S3, HDFS); others keep ``read_landing``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from filegate.schemas import RAW_LISTING_SCHEMA
from filegate.sources.landing import MANIFEST_ESCAPE, MANIFEST_SUFFIX, empty_listing
from filegate.sources.storage import Storage

#: Files of one emitted batch; with ``all_content`` a batch also ends at this many bytes.
BATCH_FILES, BATCH_BYTES = 5000, 32 << 20
PREFIX_SCHEMA = "prefix string, whole boolean"


def prefixes(spark: SparkSession, path: str, depth: int = 1) -> list[tuple[str, bool]]:
    """(folder, list all below it) that cover ``path``: the folders at ``depth``, and the files above them."""
    files, level, out = Storage(spark), [path], []
    for _ in range(depth):
        out += [(folder, False) for folder in level]
        level = [f for folder in level for f in files.folders(folder) if f.rsplit("/", 1)[1][:1] not in ("_", ".")]
    return out + [(folder, True) for folder in level]


def _hidden(path: str, base: str) -> bool:
    return any(part[:1] in ("_", ".") for part in path[len(base):].strip("/").split("/"))


def _lister(all_content: bool):
    schema = to_arrow_schema(RAW_LISTING_SCHEMA)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)],
                                          schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                parts = urlsplit(row["prefix"])
                head = f"{parts.scheme or 'file'}:" + (f"//{parts.netloc}" if parts.netloc else "")
                folder = unquote(parts.path) if parts.scheme else row["prefix"]
                scheme = {"s3a": "s3", "": "file"}.get(parts.scheme, parts.scheme)
                store, base = pafs.FileSystem.from_uri(f"{scheme}://{parts.netloc}{quote(folder)}")
                below = pafs.FileSelector(base, recursive=row["whole"], allow_not_found=True)
                for info in store.get_file_info(below):
                    if info.type != pafs.FileType.File or not info.size or _hidden(info.path, base):
                        continue
                    name = info.base_name
                    content = None
                    if all_content or name.endswith(MANIFEST_SUFFIX) or MANIFEST_ESCAPE in name:
                        with store.open_input_stream(info.path) as stream:
                            content = stream.read()
                    changed = info.mtime_ns // 1_000_000 * 1000  # milliseconds, as the file sources report them
                    when = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc) + _dt.timedelta(microseconds=changed)
                    path = info.path if not parts.netloc else info.path.split("/", 1)[1]
                    held.append((f"{head}{path if path.startswith('/') else '/' + path}", when, info.size, content))
                    size += len(content or b"")
                    if len(held) >= BATCH_FILES or size >= BATCH_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
        if held:
            yield batch_of(held)

    return run


def read_landing_spread(spark: SparkSession, path: str, all_content: bool = False, depth: int = 1,
                        tasks: int | None = None) -> DataFrame:
    """``path, modificationTime, length, content`` of all files under ``path``, as ``read_landing`` gives them.

    A missing folder gives an empty listing. Hidden names (``_``, ``.``) and empty files are skipped, as there.
    """
    if not Storage(spark).exists(path):
        return empty_listing(spark)
    found = prefixes(spark, path, depth)
    rows = spark.createDataFrame(found, PREFIX_SCHEMA).repartition(tasks or max(1, min(len(found), 10_000)))
    return rows.mapInArrow(_lister(all_content), RAW_LISTING_SCHEMA)
