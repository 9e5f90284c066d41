"""Column expressions that read the metadata coded in landing file names and manifests.

Every function returns a ``Column`` built from native Spark expressions, so the whole
parse stays inside whole-stage code generation. Nothing here raises on bad input:
ANSI casts are replaced by their ``try_`` forms and problems become codes in
``parse_error`` / ``manifest_error`` columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must stay equal to the reference for identical results) -----------
# File name layout: SISTEMA=<system>|TABELA=<table>|DT_REF=<yyyy-mm-dd>|PART=<n>.json
#                or SISTEMA=<system>|TABELA=<table>|DT_REF=<yyyy-mm-dd>|MANIFEST.json
FILE_NAME_PATTERN = (
    r"^SISTEMA=([^|]+)\|TABELA=([^|]+)\|DT_REF=(\d{4}-\d{2}-\d{2})\|"
    r"(PART=(\d+)\.json|MANIFEST\.json)$"
)
BASE_NAME_PATTERN = r"([^/\\]+)$"
MANIFEST_SUFFIX_PATTERN = r"MANIFEST\.json$"
DT_REF_FORMAT = "yyyy-MM-dd"
_DATE_FORM = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
GROUP_KEY_SEPARATOR = "|"

# Parse error codes.
INVALID_FILENAME_PATTERN = "INVALID_FILENAME_PATTERN"
INVALID_DT_REF = "INVALID_DT_REF"
PART_NUMBER_OUT_OF_RANGE = "PART_NUMBER_OUT_OF_RANGE"

# Manifest payload diagnosis codes.
EMPTY_MANIFEST_PAYLOAD = "EMPTY_MANIFEST_PAYLOAD"
INVALID_MANIFEST_JSON = "INVALID_MANIFEST_JSON"
MISSING_EXPECTED_PARTS = "MISSING_EXPECTED_PARTS"
INVALID_EXPECTED_PARTS = "INVALID_EXPECTED_PARTS"
# ---------------------------------------------------------------------------------------

_MANIFEST_DDL = "expected_parts INT"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """Last path segment; both ``/`` and ``\\`` separate segments.

    Same result as ``regexp_extract(path, BASE_NAME_PATTERN, 1)`` (empty when the path
    ends with a separator) without running a regex over the whole path.
    """
    return F.substring_index(F.substring_index(_col(path), "/", -1), "\\", -1)


def decoded_name(name: Column | str) -> Column:
    """URL-decoded name; an undecodable name (e.g. ``%zz``) is kept as it is.

    Decoding only changes ``%xx`` escapes and ``+``, so names without either are passed
    through without calling the decoder.
    """
    name = _col(name)
    encoded = name.contains("%") | name.contains("+")
    return F.when(encoded, F.coalesce(F.try_url_decode(name), name)).otherwise(name)


def name_field(logical_name: Column | str, group: int) -> Column:
    """Capture group of the file name pattern; ``''`` when the name does not match.

    Reference form: ``regexp_extract(name, FILE_NAME_PATTERN, group)``.
    """
    return F.regexp_extract(_col(logical_name), FILE_NAME_PATTERN, group)


def name_fields(logical_name: Column | str, matches: Column) -> dict[str, Column]:
    """Groups 1, 2, 3 and 5 of the file name pattern with a single regex evaluation.

    ``matches`` is ``matches_name_pattern(name)``. When the pattern matches, the name is
    ``SISTEMA=<s>|TABELA=<t>|DT_REF=<d>|<tail>`` with no ``|`` inside ``s``, ``t``, ``d``
    or ``tail``, so the groups are the texts between the three ``|`` minus their fixed prefixes,
    and the part number stands between ``PART=`` and the first point of the tail. They are cut by
    ``substring_index``: ``split_part`` builds an array of all pieces for each field, which cost
    more than the rest of the parse together.
    Without a match every group is ``''``, as ``regexp_extract`` returns.
    """
    name = _col(logical_name)
    empty = F.lit("")

    def field(cut: Column, prefix: str) -> Column:
        return F.when(matches, F.substring(cut, len(prefix) + 1, 1 << 30)).otherwise(empty)

    tail = F.substring_index(name, "|", -1)
    part = F.substring_index(F.substring(tail, len("PART=") + 1, 1 << 30), ".", 1)
    return {
        "system_name": field(F.substring_index(name, "|", 1), "SISTEMA="),
        "table_name": field(F.substring_index(F.substring_index(name, "|", 2), "|", -1), "TABELA="),
        "dt_ref_str": field(F.substring_index(F.substring_index(name, "|", -2), "|", 1), "DT_REF="),
        "part_number_str": F.when(matches & tail.startswith("PART="), part).otherwise(empty),
    }


def matches_name_pattern(logical_name: Column | str) -> Column:
    return _col(logical_name).rlike(FILE_NAME_PATTERN)


def is_manifest_name(logical_name: Column | str) -> Column:
    return _col(logical_name).rlike(MANIFEST_SUFFIX_PATTERN)


def reference_date(dt_ref_text: Column | str) -> Column:
    """``yyyy-MM-dd`` text to a date; impossible dates such as month 13 become null.

    Same result as ``try_to_date(text, DT_REF_FORMAT)``: the cast reads more forms, which are kept out; it needs
    no formatter per row.
    """
    text = _col(dt_ref_text)
    return F.when(text.rlike(_DATE_FORM), text.try_cast("date"))


def part_number(part_text: Column | str, is_manifest: Column | str) -> Column:
    """Part number as int, null for manifests, empty text, or values beyond int range."""
    return F.when(~_col(is_manifest), _col(part_text).try_cast("int"))


def manifest_expected_parts(content: Column | str, is_manifest: Column | str) -> Column:
    """``expected_parts`` of a manifest payload (PERMISSIVE JSON read, int field).

    Bad JSON, a missing key, and values that are not integral or overflow int all give
    null; ``0`` and negative values pass (see ``manifest_error`` for the strict rules).
    Only manifests are parsed.
    """
    parsed = F.from_json(_col(content).cast("string"), _MANIFEST_DDL)
    return F.when(_col(is_manifest), parsed.getField("expected_parts").cast("int"))


def group_key(system: Column | str, table: Column | str, dt_ref: Column | str,
              dt_ref_text: Column | str) -> Column:
    """``system|table|dt_ref``; null unless all three parts are valid."""
    valid = (_col(system) != "") & (_col(table) != "") & _col(dt_ref).isNotNull()
    return F.when(valid, F.concat_ws(GROUP_KEY_SEPARATOR, _col(system), _col(table), _col(dt_ref_text)))


def parse_error(logical_name: Column | str, dt_ref: Column | str,
                part_text: Column | str | None = None,
                part: Column | str | None = None, strict: bool = False,
                name_ok: Column | None = None) -> Column:
    """First failing rule: name pattern, then reference date, then (strict) part range.

    ``name_ok`` may pass an already computed ``matches_name_pattern`` column.
    """
    ok = matches_name_pattern(logical_name) if name_ok is None else name_ok
    rule = F.when(~ok, F.lit(INVALID_FILENAME_PATTERN)).when(
        _col(dt_ref).isNull(), F.lit(INVALID_DT_REF)
    )
    if strict:
        if part_text is None or part is None:
            raise ValueError("strict parse_error needs part_text and part")
        rule = rule.when((_col(part_text) != "") & _col(part).isNull(), F.lit(PART_NUMBER_OUT_OF_RANGE))
    return rule


def manifest_error(content: Column | str) -> Column:
    """Diagnosis of a manifest payload, null when it holds a positive int ``expected_parts``.

    Rules in order: no payload; payload is not a JSON object; key missing or JSON null;
    value not an integer that fits int, or not positive.
    """
    text = _col(content).cast("string")
    doc = F.try_parse_json(text)
    value = F.try_variant_get(doc, "$.expected_parts", "variant")
    as_int = F.try_variant_get(doc, "$.expected_parts", "int")
    return (
        F.when(_col(content).isNull(), F.lit(EMPTY_MANIFEST_PAYLOAD))
        .when(doc.isNull() | ~F.schema_of_variant(doc).startswith("OBJECT"), F.lit(INVALID_MANIFEST_JSON))
        .when(value.isNull() | F.is_variant_null(value), F.lit(MISSING_EXPECTED_PARTS))
        .when(
            (F.schema_of_variant(value) != "BIGINT") | as_int.isNull() | (as_int <= 0),
            F.lit(INVALID_EXPECTED_PARTS),
        )
    )


def strict_expected_parts(content: Column | str) -> Column:
    """``expected_parts`` under the strict rules: null whenever ``manifest_error`` is set."""
    doc = F.try_parse_json(_col(content).cast("string"))
    return F.when(manifest_error(content).isNull(), F.try_variant_get(doc, "$.expected_parts", "int"))


def raw_metadata_json(path: Column | str, logical_name: Column | str, size: Column | str,
                      modification_time: Column | str) -> Column:
    return F.to_json(
        F.struct(
            _col(path).alias("path"),
            _col(logical_name).alias("logical_file_name"),
            _col(size).alias("size"),
            _col(modification_time).alias("source_modification_time"),
        )
    )
