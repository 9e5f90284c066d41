"""Deterministic keys: every key is the SHA-256 hex digest of a ``|``-joined text.

Because keys depend only on content, a replayed batch produces the same keys and the
keyed appends of the write layer ignore it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must stay equal to the reference for identical results) -----------
KEY_SEPARATOR = "|"
PARSE_ERROR_TAG = "PARSE_ERROR"
MANIFEST_TAG = "MANIFEST"
PART_TAG = "PART"
UNKNOWN_EXPECTED = "UNKNOWN"
MISSING_VALUE = "-"
PART_NUMBER_WIDTH = 10
# ---------------------------------------------------------------------------------------

CHECKSUM_MODES = (None, "raw", "base64_text")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def file_business_key(
    parse_error: Column | str = "parse_error",
    file_name: Column | str = "file_name",
    file_path: Column | str = "file_path",
    group_key: Column | str = "group_key",
    is_manifest: Column | str = "is_manifest",
    expected_parts: Column | str = "expected_parts",
    part_number: Column | str = "part_number",
) -> Column:
    """Business key of a file, by priority: parse error, manifest, part.

    * parse error: ``PARSE_ERROR|<file name, else path>`` (equal bad names collapse)
    * manifest:    ``<group>|MANIFEST|<expected parts or UNKNOWN>``
    * part:        ``<group>|PART|<part number, zero padded to 10>``; a part number that
      did not fit int is null and is skipped by ``concat_ws`` (key ``<group>|PART``).
    """
    error_key = F.concat_ws(
        KEY_SEPARATOR, F.lit(PARSE_ERROR_TAG), F.coalesce(_col(file_name), _col(file_path))
    )
    manifest_key = F.concat_ws(
        KEY_SEPARATOR,
        _col(group_key),
        F.lit(MANIFEST_TAG),
        F.coalesce(_col(expected_parts).cast("string"), F.lit(UNKNOWN_EXPECTED)),
    )
    part_key = F.concat_ws(
        KEY_SEPARATOR,
        _col(group_key),
        F.lit(PART_TAG),
        F.lpad(_col(part_number).cast("string"), PART_NUMBER_WIDTH, "0"),
    )
    text = F.when(_col(parse_error).isNotNull(), error_key).when(_col(is_manifest), manifest_key).otherwise(part_key)
    # the text is never null, but Spark takes a digest for nullable: a join on the key would then push `isnotnull(key)`
    # with the whole parse inlined (several times over) below the de-duplication, onto every landing row
    return F.coalesce(sha256_hex(text), F.lit(""))


def file_event_id(business_key: Column | str = "file_business_key") -> Column:
    return sha256_hex(_col(business_key))


def dispatch_key(group_key: Column | str = "group_key") -> Column:
    return sha256_hex(_col(group_key))


def audit_id(
    event_type: Column | str = "event_type",
    group_key: Column | str = "group_key",
    business_key: Column | str = "file_business_key",
    dedupe_key: Column | str = "dedupe_key",
) -> Column:
    """``<type>|<group or ->|<file key or ->|<dedupe key or ->``."""
    missing = F.lit(MISSING_VALUE)
    return sha256_hex(
        F.concat_ws(
            KEY_SEPARATOR,
            _col(event_type),
            F.coalesce(_col(group_key), missing),
            F.coalesce(_col(business_key), missing),
            F.coalesce(_col(dedupe_key), missing),
        )
    )


def content_checksum(content: Column | str = "content", mode: str | None = None) -> Column:
    """Checksum of the file content.

    * ``None``          - disabled, null (the default of the reference);
    * ``"raw"``         - SHA-256 of the bytes;
    * ``"base64_text"`` - SHA-256 of Spark's ``base64`` text of the bytes (compatible
      with the reference; Spark chunks that text every 76 characters).
    """
    if mode not in CHECKSUM_MODES:
        raise ValueError(f"checksum mode must be one of {CHECKSUM_MODES}, got {mode!r}")
    if mode is None:
        return F.lit(None).cast("string")
    data = _col(content).cast("binary")
    if mode == "raw":
        return sha256_hex(data)
    return sha256_hex(F.base64(data))
