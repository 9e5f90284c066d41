"""Incremental ingest with Structured Streaming: drain new landing files, then stop.

``binaryFile`` as a streaming source keeps the list of files it has delivered in the
query checkpoint, so each file reaches ``foreachBatch`` once per checkpoint; the batch
function is the keyed registration of the batch job, so a micro-batch replayed after a
failure (same files, same keys) inserts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filegate.functions.rules import timestamp_literal
from filegate.plans.jobs import FilegateConfig, ingest_batch
from filegate.sources.landing import path_exists, read_landing_stream
from filegate.sources.tables import ControlTables

COUNTERS = ("raw_events", "unique_candidates", "inserted", "duplicates", "parse_errors",
            "in_batch_duplicates", "already_registered", "audit_events")


def run_ingest_stream(spark: SparkSession, config: FilegateConfig, now=None,
                      max_files_per_trigger: int | None = None, modified_after=None) -> dict:
    """``trigger(availableNow=True)``: process every file not yet seen, then return totals.

    ``now`` fixes the ingest time of every micro-batch (tests); by default each batch
    takes the current time. ``modified_after`` (a timestamp) skips files written before
    it - the "do not include existing files" start of a new landing area.
    """
    if not config.checkpoints_root:
        raise ValueError("streaming ingest needs config.checkpoints_root")
    store = ControlTables(spark, config.tables_root)
    store.ensure()
    totals = {k: 0 for k in COUNTERS}
    totals["batches"] = 0

    if not path_exists(spark, config.landing):
        return totals
    start = timestamp_literal(modified_after) if modified_after is not None else None

    def process(batch: DataFrame, batch_id: int) -> None:
        if start is not None:
            batch = batch.where(F.col("modificationTime") >= start)
        result = ingest_batch(spark, config, batch, now=now, store=store)
        for key, value in result.items():
            totals[key] = totals.get(key, 0) + value
        totals["batches"] += 1

    stream = read_landing_stream(spark, config.landing, max_files_per_trigger=max_files_per_trigger,
                                 all_content=config.checksum is not None, archive=config.archive or None,
                                 max_file_age=config.max_file_age)
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", config.ingest_checkpoint)
        .foreachBatch(process)
        .start()
    )
    query.awaitTermination()
    return totals
