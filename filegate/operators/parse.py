"""Landing rows -> parsed metadata -> file events (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filegate.functions import keys, parsing
from filegate.schemas import FILE_EVENTS_SCHEMA

ARRIVAL_MODES = ("ingest", "modification")
#: Columns of ``file_events`` that follow from the others and the run's time; no shuffle carries them.
DERIVED_COLUMNS = ("file_event_id", "ingested_at", "is_duplicate", "raw_metadata_json")


def _raw_columns(raw: DataFrame) -> DataFrame:
    """Accept the binaryFile listing, with or without ``content``."""
    if "content" not in raw.columns:
        raw = raw.withColumn("content", F.lit(None).cast("binary"))
    return raw


def clock(now: Column, timezone: str = "UTC") -> Column:
    """``now`` as the wall time of ``timezone`` shifted to UTC; the instant itself for UTC."""
    return now if timezone == "UTC" else F.to_utc_timestamp(now, timezone)


def with_parsed_metadata(raw: DataFrame, now: Column, arrival: str = "ingest", strict: bool = False,
                         strict_manifest: bool = False, timezone: str = "UTC") -> DataFrame:
    """Attach the parsed file-name metadata to a landing listing.

    ``raw`` has ``path, modificationTime, length[, content]``. ``arrival="ingest"``
    stamps every row with ``now`` (the reference's behaviour, one value per batch);
    ``"modification"`` uses the file's modification time instead. ``strict`` adds the
    ``PART_NUMBER_OUT_OF_RANGE`` parse error for part numbers beyond int range;
    ``strict_manifest`` makes the diagnosis of a bad manifest payload its parse error.
    ``timezone`` says in which zone ``now`` is read (a session whose clock shows local time).
    """
    if arrival not in ARRIVAL_MODES:
        raise ValueError(f"arrival must be one of {ARRIVAL_MODES}")
    raw = _raw_columns(raw)
    step1 = raw.select(
        "*",
        F.col("path").alias("file_path"),
        parsing.base_name("path").alias("file_name"),
    ).withColumn("logical_file_name", parsing.decoded_name("file_name"))
    step2 = step1.select(
        "*",
        parsing.matches_name_pattern("logical_file_name").alias("_name_ok"),
        parsing.is_manifest_name("logical_file_name").alias("is_manifest"),
    )
    fields = parsing.name_fields("logical_file_name", F.col("_name_ok"))
    step2b = step2.select("*", *[col.alias(name) for name, col in fields.items()])
    step3 = step2b.select(
        "*",
        parsing.reference_date("dt_ref_str").alias("dt_ref"),
        parsing.part_number("part_number_str", "is_manifest").alias("part_number"),
        (F.when(F.col("is_manifest"), parsing.strict_expected_parts("content")) if strict_manifest
         else parsing.manifest_expected_parts("content", "is_manifest")).alias("expected_parts"),
        (clock(now, timezone) if arrival == "ingest" else F.col("modificationTime")).alias("arrived_at"),
    )
    error = parsing.parse_error(
        "logical_file_name", "dt_ref", "part_number_str", "part_number", strict=strict, name_ok=F.col("_name_ok"))
    if strict_manifest:
        error = F.coalesce(error, F.when(F.col("is_manifest"), parsing.manifest_error("content")))
    return step3.select(
        *[c for c in step3.columns if c != "_name_ok"],
        parsing.group_key("system_name", "table_name", "dt_ref", "dt_ref_str").alias("group_key"),
        error.alias("parse_error"),
    )


def parsed_files(raw: DataFrame, now: Column, arrival: str = "ingest", checksum: str | None = None,
                 strict: bool = False, strict_manifest: bool = False, timezone: str = "UTC") -> DataFrame:
    """Landing listing -> what registration carries of each file, with its business key.

    ``file_name`` holds the decoded name; ``checksum`` selects the content checksum
    (``None`` off, ``"raw"`` bytes, ``"base64_text"`` the reference's form).
    """
    parsed = with_parsed_metadata(raw, now, arrival, strict, strict_manifest, timezone)
    named = {
        "file_name": F.col("logical_file_name"),
        "file_checksum": keys.content_checksum("content", checksum),
        "file_size": F.col("length").cast("long"),
        "source_modification_time": F.col("modificationTime"),
    }
    carried = [c for c in FILE_EVENTS_SCHEMA.fieldNames() if c not in (*DERIVED_COLUMNS, "file_business_key")]
    prepared = parsed.select(*[named[c].alias(c) if c in named else F.col(c) for c in carried])
    return prepared.withColumn("file_business_key", keys.file_business_key())


def complete_file_events(files: DataFrame, now: Column, timezone: str = "UTC") -> DataFrame:
    """The columns of ``file_events`` in schema order: what ``parsed_files`` carries, and what follows from it."""
    derived = {
        "file_event_id": keys.file_event_id("file_business_key"),
        "ingested_at": clock(now, timezone),
        "is_duplicate": F.lit(False),
        "raw_metadata_json": parsing.raw_metadata_json("file_path", "file_name", "file_size",
                                                       "source_modification_time"),
    }
    return files.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in FILE_EVENTS_SCHEMA.fieldNames()])


def build_file_events(raw: DataFrame, now: Column, arrival: str = "ingest", checksum: str | None = None,
                      strict: bool = False, strict_manifest: bool = False, timezone: str = "UTC") -> DataFrame:
    """Landing listing -> the columns of ``file_events`` (schema order)."""
    files = parsed_files(raw, now, arrival, checksum, strict, strict_manifest, timezone)
    return complete_file_events(files, now, timezone)
