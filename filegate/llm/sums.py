"""Sums of fixed-size arrays over all tasks, and a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_arrays(parts: DataFrame, size: int) -> np.ndarray:
    """Element-wise sum of the float64 arrays in ``parts.value`` (binary, one row for each task or so).

    Two levels: about the square root of the rows meets in each task of the first, and the last
    adds those. The driver receives one array of ``size`` numbers.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_buffer(), dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["value"])

    fan = max(1, int(parts.rdd.getNumPartitions() ** 0.5))
    first = parts.select("value").repartition(fan).mapInArrow(add, "value binary")
    rows = first.coalesce(1).mapInArrow(add, "value binary").collect()
    return np.frombuffer(rows[0]["value"], dtype=np.float64).copy() if rows else np.zeros(size)


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, bound: int, folds: int | None = None,
                    held_out: int | None = None) -> DataFrame:
    """Up to ``bound`` labelled rows (id, label), the first by hash of the id; one label per id.

    Rows of a null id or label are left out, and those of the held-out fold. An id with several
    labels takes the largest.
    """
    rows = labels.select(F.col(id_col).alias("sample_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter("sample_id is not null and label is not null")
    if folds:
        rows = rows.filter(F.crc32(F.col("sample_id").cast("string")) % folds != held_out)
    rows = rows.groupBy("sample_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("sample_id"), "sample_id").limit(bound)
