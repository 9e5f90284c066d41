"""Deterministic keys: golden SHA-256 values and layout rules."""

from pyspark.sql import functions as F

from filegate.functions import keys

GOLDEN = {
    "part": ("TJSP|clientes|2026-04-14", False, 1, None, None,
             "bfd5ba27ee60af005d55909dff425a906efbe31ffa7289fcd84ecc02b5e50007"),
    "manifest3": ("TJSP|clientes|2026-04-14", True, None, 3, None,
                  "647a9d725704e71acfd6eaed4fe37d68733fd73f1269990a3dde812d820b7650"),
    "adv2": ("TJSP|advogados|2026-04-14", True, None, 2, None,
             "af26c303cdf047cab8e07395e8aa0ea62e12edbce8158215793dd1c94a78679b"),
    "adv3": ("TJSP|advogados|2026-04-14", True, None, 3, None,
             "3c8c15017ade9cf075f172d332c5280789868e56cfe90b59d08d3b5a97d1ced4"),
    "error": (None, False, None, None, "INVALID_FILENAME_PATTERN",
              "efb494f4dc468d75b4cc50e8333f975b710e22b4f088571b88acfcb1dceb0d7b"),
}


def test_golden_business_keys(spark):
    rows = [(k, g, m, p, e, err, "invalid-name.json", "/x/invalid-name.json") for k, (g, m, p, e, err, _) in
            GOLDEN.items()]
    df = spark.createDataFrame(rows, "k string, group_key string, is_manifest boolean, part_number int, "
                                     "expected_parts int, parse_error string, file_name string, file_path string")
    got = {r.k: r.key for r in df.select("k", keys.file_business_key().alias("key")).collect()}
    assert got == {k: v[-1] for k, v in GOLDEN.items()}


def test_dispatch_key_and_unknown_manifest(spark):
    df = spark.createDataFrame([("TJSP|clientes|2026-04-14",)], "group_key string")
    row = df.select(
        keys.dispatch_key().alias("d"),
        keys.file_business_key(F.lit(None), F.lit("n"), F.lit("p"), "group_key", F.lit(True), F.lit(None).cast("int"),
                               F.lit(None).cast("int")).alias("unknown"),
        F.sha2(F.lit("TJSP|clientes|2026-04-14|MANIFEST|UNKNOWN"), 256).alias("expected_unknown"),
    ).first()
    assert row.d == "0df78174433dc701ea56add38353cad4851baa4c2f45a93dfefe1a033251be94"
    assert row.unknown == row.expected_unknown


def test_keys_are_deterministic_and_distinct(spark):
    df = spark.createDataFrame([("g|t|2026-01-01", 3), ("g|t|2026-01-01", 4), ("g|t|2026-01-01", 3)],
                               "group_key string, expected_parts int")
    rows = df.select(keys.file_business_key(F.lit(None), F.lit("n"), F.lit("p"), "group_key", F.lit(True),
                                            "expected_parts", F.lit(None).cast("int")).alias("k")).collect()
    assert rows[0].k == rows[2].k != rows[1].k


def test_audit_id_uses_dashes_for_missing_parts(spark):
    df = spark.createDataFrame([("GROUP_CREATED", "g", None, None)],
                               "event_type string, group_key string, file_business_key string, dedupe_key string")
    row = df.select(keys.audit_id().alias("a"), F.sha2(F.lit("GROUP_CREATED|g|-|-"), 256).alias("b")).first()
    assert row.a == row.b


def test_checksum_modes(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "content binary")
    row = df.select(keys.content_checksum("content", None).alias("off"), keys.content_checksum("content", "raw").alias("raw"),
                    keys.content_checksum("content", "base64_text").alias("b64")).first()
    assert row.off is None
    assert row.raw == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert row.b64 == spark.sql("select sha2('YWJj', 256) s").first().s
