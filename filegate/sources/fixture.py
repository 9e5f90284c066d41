"""A landing listing derived from the shared test tables.

The test tables hold no landing directory, so one is derived from them with plain
DataFrame expressions (a join of ``lineitem`` and ``orders`` plus two projections),
shaped like the ``binaryFile`` listing: ``path, modificationTime, length, content``.

* parts     - one file per ``lineitem`` row, named after its order's group and line
  number (repeated ``(order, line)`` pairs are duplicate deliveries);
* manifests - one per order with ``o_orderkey % 4 <> 0``, payloads cycling through
  valid counts and four broken forms;
* misc      - one per ``events`` row: a bad name, an impossible date, a part number beyond int, or
  (97 of 100) a URL-encoded name of one hot group.

The same rules are written in SQL by ``filegate.plans.oracle.LANDING_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes(n) -> F.Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def _group_prefix() -> F.Column:
    table = F.replace(F.lower(F.expr("substr(o_orderpriority, 3)")), F.lit(" "), F.lit("_"))
    return F.concat(
        F.lit("SISTEMA=S"),
        (F.col("o_orderkey") % 5).cast("string"),
        F.lit("|TABELA="),
        table,
        F.lit("|DT_REF="),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.lit("|"),
    )


def derived_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing listing of the scale factor in ``sf_dir`` (NTZ timestamps)."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", _group_prefix().alias("prefix")
    )
    lineitem = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")

    parts = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey, "inner").select(
        F.concat(
            F.lit("file:/landing/parts/"),
            F.col("l_orderkey").cast("string"),
            F.lit("/"),
            F.col("l_partkey").cast("string"),
            F.lit("-"),
            F.col("l_suppkey").cast("string"),
            F.lit("/"),
            F.col("prefix"),
            F.lit("PART="),
            F.lpad(F.col("l_linenumber").cast("string"), 4, "0"),
            F.lit(".json"),
        ).alias("path"),
        (F.col("o_orderdate") + _minutes(F.col("l_partkey") % 60)).alias("modificationTime"),
        F.col("l_quantity").cast("long").alias("length"),
        F.concat(F.lit('{"row":'), F.col("l_linenumber").cast("string"), F.lit("}")).alias("content"),
    )

    bucket = F.col("o_orderkey") % 50
    payload = (
        F.when(bucket == 7, F.lit("{}"))
        .when(bucket == 11, F.lit("not json"))
        .when(bucket == 13, F.lit('{"expected_parts":0}'))
        .when(bucket == 17, F.lit('{"expected_parts":"x"}'))
        .otherwise(F.concat(F.lit('{"expected_parts":'), (F.col("o_orderkey") % 6 + 1).cast("string"), F.lit("}")))
    )
    manifests = orders.where(F.col("o_orderkey") % 4 != 0).select(
        F.concat(
            F.lit("file:/landing/manifests/"),
            F.col("o_orderkey").cast("string"),
            F.lit("/"),
            F.col("prefix"),
            F.lit("MANIFEST.json"),
        ).alias("path"),
        (F.col("o_orderdate") + _minutes(F.col("o_custkey") % 60)).alias("modificationTime"),
        F.lit(20).cast("long").alias("length"),
        payload.alias("content"),
    )

    kind = F.col("event_id") % 100
    encoded = F.replace(
        F.replace(
            F.concat(
                F.lit("SISTEMA=EV|TABELA=events|DT_REF=2024-01-01|PART="),
                F.lpad(F.col("user_id").cast("string"), 4, "0"),
                F.lit(".json"),
            ),
            F.lit("="),
            F.lit("%3D"),
        ),
        F.lit("|"),
        F.lit("%7C"),
    )
    name = (
        F.when(kind == 0, F.concat(F.lit("event_"), F.col("event_id").cast("string"), F.lit(".json")))
        .when(kind == 1, F.lit("SISTEMA=EV|TABELA=events|DT_REF=2024-13-01|PART=0001.json"))
        .when(kind == 2, F.lit("SISTEMA=EV|TABELA=events|DT_REF=2024-01-01|PART=99999999999.json"))
        .otherwise(encoded)
    )
    misc = events.select(
        F.concat(F.lit("file:/landing/misc/"), F.col("event_id").cast("string"), F.lit("/"), name).alias("path"),
        F.col("ts").alias("modificationTime"),
        F.lit(10).cast("long").alias("length"),
        F.col("props").alias("content"),
    )
    return parts.unionByName(manifests).unionByName(misc)
