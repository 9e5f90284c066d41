"""Session helpers: a local session for tests and benchmarks, and staged frames.

Lineage is cut with Parquet written to the folder the cluster names in
``spark.checkpoint.dir`` (reliable storage shared by all executors, so a lost executor
does not lose the staged data). The folder is read from the session; a default is set
only where none is configured and the session is a single local process.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from filegate.sources.storage import Storage

SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None, app: str = "filegate",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A ``local[cores]`` session with the settings the engine assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or (int(cores) if str(cores).isdigit() else 8))
    conf.setdefault("spark.driver.memory", os.environ.get("FILEGATE_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """The shared checkpoint folder of the session.

    Order: the folder already set on the context, then ``spark.checkpoint.dir`` from the
    session configuration, then ``default`` (for tests). Raises when none is known,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    chosen = configured or default
    if not chosen:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a folder on shared storage"
        )
    sc.setCheckpointDir(chosen)
    return sc.getCheckpointDir() or chosen


LOCAL_CHECKPOINT_DEFAULT = "file:/tmp/filegate-checkpoint"


def default_checkpoint_dir(spark: SparkSession) -> str | None:
    """A folder for one-process sessions (``local``, ``local[n]``) that configure none.

    ``None`` for every session with executors of its own, ``local-cluster`` among them.
    """
    master = spark.sparkContext.master or ""
    return LOCAL_CHECKPOINT_DEFAULT if master == "local" or master.startswith("local[") else None


def materialize(df: DataFrame) -> DataFrame:
    """Run ``df`` once and cut its lineage: a Parquet folder in the shared checkpoint folder.

    Consumers read back only the columns they use, and a lost executor loses nothing that was
    written. This is an action: it runs while the plan is built.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark, default=default_checkpoint_dir(spark))
    path = f"{base.rstrip('/')}/staged/{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_staged: list[str] = []


@contextmanager
def staged_frames(spark: SparkSession) -> Iterator[None]:
    """Remove what ``materialize`` wrote inside the block when it ends, also by an error."""
    mark = len(_staged)
    try:
        yield
    finally:
        files = Storage(spark)
        for path in _staged[mark:]:
            files.remove(path)
        del _staged[mark:]
