"""Landing-area readers: batch listing, incremental stream, JSONL sample adapter.

Both readers use Spark's ``binaryFile`` source, twice: ``content`` is read only where the column is
selected, so one scan lists the files without their bytes, and one reads the bytes of
names that may be manifests (``MANIFEST_GLOB``: the plain suffix, or any escape, which may hide
it). The two scans are disjoint and unioned - no join, no shuffle. ``all_content=True`` reads
every file's bytes in one scan; a content checksum needs that.
Note that ``binaryFile`` skips names that start with ``_`` or ``.``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.schemas import RAW_LISTING_SCHEMA

MANIFEST_SUFFIX, MANIFEST_ESCAPE = "MANIFEST.json", "%"
MANIFEST_GLOB = f"{{*{MANIFEST_SUFFIX},*{MANIFEST_ESCAPE}*}}"

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("logical_file_name", T.StringType(), True),
        T.StructField("payload", T.StringType(), True),
    ]
)


def empty_listing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_LISTING_SCHEMA)


def _may_be_manifest() -> Column:
    """The rows that ``MANIFEST_GLOB`` selects."""
    name = F.substring_index("path", "/", -1)
    return name.endswith(MANIFEST_SUFFIX) | name.contains(MANIFEST_ESCAPE)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _scans(reader: Callable, path: str, all_content: bool) -> DataFrame:
    """The listing of ``path`` from fresh readers (batch or stream) of the ``binaryFile`` source."""
    columns = RAW_LISTING_SCHEMA.fieldNames()
    if all_content:
        return reader().load(path).select(*columns)
    listing = reader().load(path).select("path", "modificationTime", "length").where(~_may_be_manifest())
    manifests = reader().option("pathGlobFilter", MANIFEST_GLOB).load(path).select(*columns)
    return listing.withColumn("content", F.lit(None).cast("binary")).unionByName(manifests)


def read_landing(spark: SparkSession, path: str, all_content: bool = False,
                 modified_after: str | None = None) -> DataFrame:
    """All files under ``path`` (recursive) as ``path, modificationTime, length, content``.

    A missing directory gives an empty listing instead of an error. ``modified_after``
    (``yyyy-MM-ddTHH:mm:ss``) keeps only newer files, the batch form of "do not include
    existing files".
    """
    if not path_exists(spark, path):
        return empty_listing(spark)

    def reader():
        r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return r.option("modifiedAfter", modified_after) if modified_after else r

    return _scans(reader, path, all_content)


def read_landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        all_content: bool = False, archive: str | None = None,
                        max_file_age: str | None = None) -> DataFrame:
    """Incremental listing: each file is delivered once per checkpoint (two sources of one query).

    ``archive`` (a folder outside ``path``) takes the files of finished batches, so each trigger lists what is new
    and not all that ever came. One source must then do for all files: it reads every file's bytes.
    ``max_file_age`` (``7d``) bounds the list of delivered files that the source remembers; older files are
    left out, the first batch excepted.
    """

    def reader():
        r = (spark.readStream.format("binaryFile").schema(RAW_LISTING_SCHEMA)
             .option("recursiveFileLookup", "true"))
        if archive:
            r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive)
        if max_file_age:
            r = r.option("maxFileAge", max_file_age)
        return r.option("maxFilesPerTrigger", str(max_files_per_trigger)) if max_files_per_trigger else r

    return _scans(reader, path, all_content or archive is not None)


def read_jsonl_samples(spark: SparkSession, path: str, modification_time: str | None = None) -> DataFrame:
    """Sample listings (``logical_file_name`` + ``payload`` per line) -> raw listing rows.

    The payload object is kept as its JSON text; its byte length becomes ``length``.
    Every line is one delivery, so repeated lines are repeated deliveries.
    """
    rows = spark.read.schema(SAMPLE_SCHEMA).json(path)
    mtime = F.to_timestamp(F.lit(modification_time)) if modification_time else F.current_timestamp()
    return rows.select(
        F.concat(F.lit(path.rstrip("/") + "/"), F.col("logical_file_name")).alias("path"),
        mtime.alias("modificationTime"),
        F.octet_length("payload").cast("long").alias("length"),
        F.col("payload").cast("binary").alias("content"),
    )
