"""File-name and manifest parsing through the DataFrame operators."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filegate.functions import parsing
from filegate.functions.rules import timestamp_literal
from filegate.operators import parse

NOW = "2031-07-08 10:00:00"


def _parse(spark, names, contents=None, strict=False):
    contents = contents or [None] * len(names)
    rows = [(f"/landing/x/{n}", dt.datetime(2031, 7, 8, 9), 10, c.encode() if c else None)
            for n, c in zip(names, contents)]
    raw = spark.createDataFrame(rows, "path string, modificationTime timestamp, length long, content binary")
    out = parse.with_parsed_metadata(raw, timestamp_literal(NOW), strict=strict)
    return {r["file_path"].split("/")[-1]: r for r in out.collect()}


def test_valid_part(spark):
    r = _parse(spark, ["SISTEMA=ACME|TABELA=invoices|DT_REF=2031-07-08|PART=0042.json"])
    row = next(iter(r.values()))
    assert (row.system_name, row.table_name, row.dt_ref, row.part_number) == ("ACME", "invoices",
                                                                              dt.date(2031, 7, 8), 42)
    assert row.is_manifest is False and row.parse_error is None
    assert row.group_key == "ACME|invoices|2031-07-08"


def test_valid_manifest_reads_expected_parts(spark):
    name = "SISTEMA=ACME|TABELA=invoices|DT_REF=2031-07-08|MANIFEST.json"
    row = next(iter(_parse(spark, [name], ['{"expected_parts": 6}']).values()))
    assert row.is_manifest is True and row.part_number is None and row.expected_parts == 6
    assert row.parse_error is None


def test_url_encoded_name_is_decoded(spark):
    name = "SISTEMA%3DACME%7CTABELA%3Dinvoices%7CDT_REF%3D2031-07-08%7CPART%3D0001.json"
    row = next(iter(_parse(spark, [name]).values()))
    assert row.logical_file_name == "SISTEMA=ACME|TABELA=invoices|DT_REF=2031-07-08|PART=0001.json"
    assert row.part_number == 1 and row.parse_error is None


def test_bad_pattern_and_bad_date(spark):
    rows = _parse(spark, ["invoices_2031-07-08.json", "SISTEMA=ACME|TABELA=invoices|DT_REF=2031-13-77|PART=1.json"])
    assert rows["invoices_2031-07-08.json"].parse_error == parsing.INVALID_FILENAME_PATTERN
    assert rows["invoices_2031-07-08.json"].system_name == ""
    bad_date = rows["SISTEMA=ACME|TABELA=invoices|DT_REF=2031-13-77|PART=1.json"]
    assert bad_date.parse_error == parsing.INVALID_DT_REF and bad_date.group_key is None


def test_part_number_overflow_is_null_and_strict_flags_it(spark):
    name = "SISTEMA=A|TABELA=b|DT_REF=2031-07-08|PART=99999999999.json"
    assert next(iter(_parse(spark, [name]).values())).part_number is None
    assert next(iter(_parse(spark, [name]).values())).parse_error is None
    strict = next(iter(_parse(spark, [name], strict=True).values()))
    assert strict.parse_error == parsing.PART_NUMBER_OUT_OF_RANGE


# Fixed test cases: payload, permissive count, strict diagnosis.
MANIFESTS = [
    ('{"expected_parts": 4}', 4, None),
    ('{"expected_parts": "x"}', None, parsing.INVALID_EXPECTED_PARTS),
    ('{"expected_parts": 0}', 0, parsing.INVALID_EXPECTED_PARTS),
    ('{"expected_parts": 3.5}', None, parsing.INVALID_EXPECTED_PARTS),
    ('{}', None, parsing.MISSING_EXPECTED_PARTS),
    ('{"expected_parts": null}', None, parsing.MISSING_EXPECTED_PARTS),
    ('not json', None, parsing.INVALID_MANIFEST_JSON),
    ('[1, 2]', None, parsing.INVALID_MANIFEST_JSON),
    (None, None, parsing.EMPTY_MANIFEST_PAYLOAD),
]


def test_manifest_payload_rules(spark):
    df = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(MANIFESTS)], "i int, content string")
    rows = df.select("i", parsing.manifest_expected_parts("content", F.lit(True)).alias("permissive"),
                     parsing.manifest_error("content").alias("error"),
                     parsing.strict_expected_parts("content").alias("strict")).collect()
    want = {i: (n, e, n if e is None else None) for i, (_, n, e) in enumerate(MANIFESTS)}
    assert {r.i: (r.permissive, r.error, r.strict) for r in rows} == want


def test_strict_manifests_become_parse_errors(spark):
    names = [f"SISTEMA=A|TABELA=t{i}|DT_REF=2031-07-08|MANIFEST.json" for i in range(len(MANIFESTS))]
    rows = [(f"/l/{n}", dt.datetime(2031, 7, 8, 9), 10, p.encode() if p else None)
            for n, (p, _, _) in zip(names, MANIFESTS, strict=True)]
    raw = spark.createDataFrame(rows, "path string, modificationTime timestamp, length long, content binary")
    out = parse.build_file_events(raw, timestamp_literal(NOW), strict_manifest=True).collect()
    got = {r.table_name: (r.expected_parts, r.parse_error) for r in out}
    assert got == {f"t{i}": (n if e is None else None, e) for i, (_, n, e) in enumerate(MANIFESTS)}


_segment = st.text(alphabet="ab|=/\\%.\n", max_size=12)
_paths = st.lists(st.lists(_segment, min_size=1, max_size=4).map("/".join), min_size=30, max_size=60)


@settings(max_examples=4, deadline=None)
@given(_paths)
def test_base_name_matches_regex_form(spark, paths):
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(
        parsing.base_name("p").alias("fast"), F.regexp_extract("p", parsing.BASE_NAME_PATTERN, 1).alias("regex"))
    assert rows.where("fast <> regex").count() == 0


_names = st.one_of(
    st.builds(
        lambda s, t, d, tail: f"SISTEMA={s}|TABELA={t}|DT_REF={d}|{tail}",
        st.text(alphabet="ab=|\n", max_size=4),
        st.text(alphabet="cd=|", max_size=4),
        st.sampled_from(["2031-07-08", "2026-4-14", "2031-13-77"]),
        st.sampled_from(["PART=0001.json", "PART=.json", "MANIFEST.json", "PART=12.json\n", "MANIFEST.json\n",
                         "PART=1.jsonx"]),
    ),
    st.text(alphabet="SISTEMA=|TBLDR_0-9.json", max_size=30),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(_names, min_size=40, max_size=80))
def test_name_fields_match_regex_groups(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    fields = parsing.name_fields("n", parsing.matches_name_pattern("n"))
    rows = df.select(*[c.alias(k) for k, c in fields.items()],
                     *[parsing.name_field("n", g).alias(f"g{g}") for g in (1, 2, 3, 5)])
    assert rows.where("system_name <> g1 or table_name <> g2 or dt_ref_str <> g3 or part_number_str <> g5").count() == 0


def test_ingest_time_is_read_in_the_given_zone(spark):
    """10:00 as a wall time of Sao Paulo (three hours behind) is 13:00 UTC; modification times are instants and stay."""
    raw = spark.createDataFrame([("/landing/x/SISTEMA=ACME|TABELA=t|DT_REF=2031-07-08|PART=1.json", dt.datetime(2031, 7, 8, 9), 10)],
                                "path string, modificationTime timestamp, length long")
    now = timestamp_literal("2031-07-08 10:00:00")
    zone = {"timezone": "America/Sao_Paulo"}
    by_ingest = parse.build_file_events(raw, now, **zone).first()
    assert str(by_ingest.arrived_at) == str(by_ingest.ingested_at) == "2031-07-08 13:00:00"
    by_file = parse.build_file_events(raw, now, arrival="modification", **zone).first()
    assert str(by_file.arrived_at) == "2031-07-08 09:00:00" and str(by_file.ingested_at) == "2031-07-08 13:00:00"
    assert str(parse.build_file_events(raw, now).first().arrived_at) == "2031-07-08 10:00:00"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_join_on_the_key_does_not_parse_below_the_de_duplication(spark):
    from filegate.operators import register

    raw = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    batch = register.dedupe_by_key(parse.parsed_files(raw, timestamp_literal(NOW), "modification"))
    known = spark.createDataFrame([("k",)], "file_business_key string")
    for joined in (register.duplicate_candidates(batch, known), register.tag_registered(batch, known).where("not is_new"),
                   register.tag_registered(known, batch)):
        assert "isnotnull(sha2" not in _plan(joined).lower()


def test_fields_and_dates_are_read_without_arrays_and_formatters(spark):
    raw = spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    plan = _plan(parse.with_parsed_metadata(raw, timestamp_literal(NOW))).lower()
    assert "split" not in plan and "gettimestamp" not in plan

    names = [head + tail for head in ("SISTEMA=a|TABELA=b|DT_REF=2024-01-01|PART=1.json",
                                      "SISTEMA=PART=.|TABELA=MANIFEST.json|DT_REF=2024-99-01|MANIFEST.json")
             for tail in ("", "\n", "\r\n", "\u0085", " ", "x", "\n\n", "|")]
    names += ["SISTEMA=a=b|TABELA=TABELA=é x|DT_REF=2024-01-01|PART=00099999999999999.json", "|||PART=3.json", "",
              "SISTEMA=a\nb|TABELA=c|DT_REF=2024-01-01|PART=٣.json", "SISTEMA=a|TABELA=b|DT_REF=2024-01-01|PART=.json"]
    fields = parsing.name_fields("n", parsing.matches_name_pattern("n"))
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(
        *[c.alias(k) for k, c in fields.items()], *[parsing.name_field("n", g).alias(f"g{g}") for g in (1, 2, 3, 5)])
    for row in rows.collect():
        assert row[:4] == row[4:]

    dates = ["2024-01-01", "2024-13-01", "0000-01-01", "0001-01-01", "9999-12-31", "2024-02-30", "2023-02-29", "1582-10-10",
             "1500-02-29", "", "  2024-01-01", "2024-1-1", "2024-01-01 ", "2024-01-01T00", "+2024-01-01", "12024-01-01",
             "2024-01-01\n", None, "2024-00-10", "٢٠٢٤-01-01"]
    both = spark.createDataFrame([(d,) for d in dates], "d string").select(
        "d", parsing.reference_date("d").cast("string").alias("got"),
        F.try_to_date("d", parsing.DT_REF_FORMAT).cast("string").alias("want"))
    assert both.where("not (got <=> want)").collect() == []
