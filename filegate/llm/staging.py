"""Lineage cuts in the shared folder, and small helpers every operator uses."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import filegate
from filegate.session import checkpoint_dir, default_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared checkpoint folder of the session."""
    base = checkpoint_dir(spark, default=default_checkpoint_dir(spark))
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later steps prune columns on re-read, and a lost executor loses nothing that was written.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (compared without case)."""
    used = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in used:
        name = "_" + name
    return name


def by_name(name: str) -> Column:
    """Column reference for any column name, also one with dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_batches(df: DataFrame, fn: Callable, added: list[T.StructField]) -> DataFrame:
    """``df.mapInArrow`` that appends columns, for any column names (inside, columns go by position).

    ``fn(batches, names)`` gets the names its batches must have.
    """
    inside = [T.StructField(f"_column_{i}", f.dataType) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([*inside, *added])
    names = [f.name for f in schema.fields]
    out = df.toDF(*names[:len(inside)]).mapInArrow(lambda batches: fn(batches, names), schema)
    return out.toDF(*df.columns, *[f.name for f in added])


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``), so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(filegate.__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="filegate-"), "filegate.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
