"""File registration: de-duplicate a batch, split it against the stored keys, count.

All steps are aggregations or joins on ``file_business_key``. The batch de-duplication
is a keyed aggregation (not a window), so a key delivered millions of times is reduced
map-side before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SURVIVOR_ORDER = ("arrived_at", "source_modification_time", "file_path")


def dedupe_by_key(events: DataFrame, key: str = "file_business_key",
                  order: tuple[str, ...] = SURVIVOR_ORDER, copies: bool = False) -> DataFrame:
    """One row per ``key``: the earliest by ``order`` (remaining columns break ties).

    ``copies=True`` adds ``n_copies``, the number of batch rows that carried the key.
    """
    rest = [c for c in events.columns if c != key and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    aggs = [best]
    if copies:
        aggs.append(F.count(F.lit(1)).alias("n_copies"))
    reduced = events.groupBy(key).agg(*aggs)
    cols = [F.col(key) if c == key else F.col("_best").getField(c).alias(c) for c in events.columns]
    if copies:
        cols.append(F.col("n_copies"))
    return reduced.select(*cols)


def tag_registered(batch: DataFrame, registered_keys: DataFrame,
                   key: str = "file_business_key") -> DataFrame:
    """Add ``is_new``: the key is not in ``registered_keys`` (a unique-key frame)."""
    seen = registered_keys.select(F.col(key), F.lit(True).alias("_seen"))
    return batch.join(seen, key, "left").withColumn("is_new", F.col("_seen").isNull()).drop("_seen")


def new_candidates(batch: DataFrame, registered_keys: DataFrame, key: str = "file_business_key") -> DataFrame:
    """Rows whose key is not registered yet (insert-if-absent source)."""
    return batch.join(registered_keys.select(key), key, "left_anti")


def duplicate_candidates(batch: DataFrame, registered_keys: DataFrame,
                         key: str = "file_business_key") -> DataFrame:
    """Rows whose key is already registered (semi join: stored keys are unique)."""
    return batch.join(registered_keys.select(key), key, "left_semi")


def registration_counters(tagged: DataFrame) -> DataFrame:
    """One row of counters from a de-duplicated batch with ``n_copies`` and ``is_new``.

    ``duplicates`` = raw - inserted, as in the reference (it includes copies inside the
    batch); ``in_batch_duplicates`` and ``already_registered`` split it up.
    """
    raw = F.coalesce(F.sum("n_copies"), F.lit(0)).cast("long")
    inserted = F.count_if(F.col("is_new"))
    return tagged.agg(
        raw.alias("raw_events"),
        F.count(F.lit(1)).alias("unique_candidates"),
        inserted.alias("inserted"),
        (raw - inserted).alias("duplicates"),
        F.count_if(F.col("is_new") & F.col("parse_error").isNotNull()).alias("parse_errors"),
        (raw - F.count(F.lit(1))).alias("in_batch_duplicates"),
        F.count_if(~F.col("is_new")).alias("already_registered"),
    )


# --- filters ----------------------------------------------------------------------------

def valid_event_rule() -> Column:
    return F.col("parse_error").isNull() & F.col("group_key").isNotNull()


def valid_events(events: DataFrame) -> DataFrame:
    """Events that belong to a group: no parse error and a group key."""
    return events.where(valid_event_rule())


def parse_error_rows(events: DataFrame) -> DataFrame:
    return events.where(F.col("parse_error").isNotNull())


def snapshot_part_rows(events: DataFrame) -> DataFrame:
    """Part files that go into a dispatch snapshot: no parse error, not a manifest."""
    return events.where(F.col("parse_error").isNull() & ~F.col("is_manifest"))
