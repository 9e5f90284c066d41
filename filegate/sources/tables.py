"""Control tables on plain Parquet: keyed appends, a change feed by run, and the versioned group state.

* ``file_events``, ``dispatch``, ``dispatch_files``, ``audit`` are insert-only, partitioned by ``dt_ref`` and
  ``key_bucket``. A keyed append is ``batch left_anti stored`` over the stored partitions that can hold a key
  of the batch (``near``), appended. Replaying a batch adds nothing; a partly written append is completed by
  the next run, row by row.
* ``file_events`` has ``run_id`` as its first partition. A run is announced before it writes and marked when it is
  done (``runs/``); evaluate reads the runs after the last one it folded, never the rows before them.
* the group state changes by versions (``state.py``): a run's changes appear whole or not at all.

``key_bucket`` is 0 for rows with a date. Rows without one (bad names) are spread over ``NULL_BUCKETS`` folders by
their key, so a batch with a few of them reads a few folders, not all bad names of all time. The key columns carry
Parquet bloom filters, which batches of a few keys use.

Single writer per table, as the jobs run one at a time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.schemas import STATE_SCHEMAS, TABLE_KEYS, TABLE_SCHEMAS
from filegate.session import materialize
from filegate.sources.state import GroupState
from filegate.sources.storage import Storage

PARTITION = "dt_ref"
BUCKET = "key_bucket"
RUN = "run_id"
NULL_BUCKETS = 64
#: Date ranges of a partition filter; more are merged across their smallest gaps (the filter only prunes).
RANGES = 64
#: Batches of at most so many keys name them in the read, for the bloom filters (the reader's own limit for ``IN``).
NAMED_KEYS = 10


def date_ranges(dates: list[tuple[_dt.date, _dt.date]], limit: int = RANGES) -> list[tuple[_dt.date, _dt.date]]:
    """``limit`` ranges at most that cover the given (first, last) ones, joined where the gaps are smallest."""
    ranges = sorted(dates)
    if len(ranges) <= limit:
        return ranges
    gaps = sorted(range(1, len(ranges)), key=lambda i: (ranges[i][0] - ranges[i - 1][1], i))
    cuts = [0, *sorted(gaps[len(gaps) - limit + 1:]), len(ranges)]
    return [(ranges[a][0], ranges[b - 1][1]) for a, b in zip(cuts, cuts[1:], strict=False)]


class ControlTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Storage(spark)
        self.state = GroupState(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def ensure(self) -> None:
        """Create every missing insert-only table as an empty, typed, partitioned Parquet table."""
        for name in TABLE_SCHEMAS:
            if not self.files.exists(self.path(name)):
                empty = self.spark.createDataFrame([], self._stored_schema(name))
                empty.write.partitionBy(*self._partitions(name)).parquet(self.path(name))

    def _partitions(self, name: str) -> list[str]:
        return [RUN, PARTITION, BUCKET] if name == "file_events" else [PARTITION, BUCKET]

    def _stored_schema(self, name: str) -> T.StructType:
        more = [T.StructField(BUCKET, T.IntegerType()), T.StructField(RUN, T.LongType())]
        return T.StructType([*TABLE_SCHEMAS[name].fields, *[f for f in more if f.name in self._partitions(name)]])

    # --- reads ------------------------------------------------------------------------------
    def _stored(self, name: str, runs: list[int] | None = None) -> DataFrame:
        """Every stored row with its partition columns; of ``file_events``, the rows of ``runs`` (all that count)."""
        reader = self.spark.read.schema(self._stored_schema(name)).option("basePath", self.path(name))
        if name != "file_events":
            return reader.parquet(self.path(name))
        folders = set(self.files.names(self.path(name)))
        wanted = [f"{RUN}={r}" for r in (self.runs() if runs is None else runs)]
        paths = [f"{self.path(name)}/{f}" for f in wanted if f in folders]
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self._stored_schema(name))

    def read(self, name: str) -> DataFrame:
        """The table in schema order."""
        if name in STATE_SCHEMAS:
            return self.state.read(name)
        return self._stored(name).select(*TABLE_SCHEMAS[name].fieldNames())

    def near(self, name: str, batch: DataFrame) -> DataFrame:
        """The table's rows in the partitions that can hold a key of ``batch`` (staged).

        The batch is reduced to its first and last date of each month and to the buckets of its rows without date;
        at most one row per calendar month reaches the driver, ``RANGES`` ranges the filter.
        """
        key = TABLE_KEYS[name][-1]
        keyed = key in batch.columns
        bucket = self._bucket(key) if keyed else F.lit(None).cast("int")
        found = batch.groupBy(F.trunc(PARTITION, "month"), bucket).agg(
            F.min(PARTITION), F.max(PARTITION), F.count(F.lit(1))).collect()
        rule = F.lit(False)
        for first, last in date_ranges([(r[2], r[3]) for r in found if r[0] is not None]):
            rule = rule | F.col(PARTITION).between(F.lit(first), F.lit(last))
        buckets = sorted(r[1] for r in found if r[0] is None and r[1] is not None)
        if buckets:
            rule = rule | (F.col(PARTITION).isNull() & F.col(BUCKET).isin(buckets))
        rows = self._stored(name).where(rule)
        if keyed and 0 < sum(r[4] for r in found) <= NAMED_KEYS:
            rows = rows.where(F.col(key).isin([r[0] for r in batch.select(key).distinct().collect()]))
        return rows.select(*TABLE_SCHEMAS[name].fieldNames())

    # --- writes -----------------------------------------------------------------------------
    @staticmethod
    def _bucket(key: str) -> Column:
        spread = 1 + F.pmod(F.xxhash64(F.col(key)), F.lit(NULL_BUCKETS))
        return F.when(F.col(PARTITION).isNull(), spread).otherwise(F.lit(0)).cast("int")

    def _write(self, name: str, rows: DataFrame, path: str) -> None:
        """One file per date or so: small dates share a task, a hot one is split (rebalance)."""
        key = TABLE_KEYS[name][-1]
        rows = rows.select(*TABLE_SCHEMAS[name].fieldNames(), self._bucket(key).alias(BUCKET))
        writer = rows.hint("rebalance", F.col(PARTITION), F.col(BUCKET)).write.mode("append")
        (writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the keys of a file, not at its maximum
         .partitionBy(PARTITION, BUCKET).parquet(path))

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows; those of ``file_events`` as a run of their own."""
        if name == "file_events":
            self.append_run(df)
        else:
            self._write(name, df, self.path(name))

    def insert_if_absent(self, name: str, df: DataFrame) -> DataFrame:
        """Append the rows of the staged ``df`` whose key is not stored; returns them (staged)."""
        key = TABLE_KEYS[name]
        new = materialize(df.join(self.near(name, df).select(*key), key, "left_anti"))
        self.append(name, new)
        return new

    # --- runs: the change feed of file_events -------------------------------------------------
    # runs/<id>.open before a run writes, <id>.done after it; <id>.merged=<n> for rows that took the place of the
    # runs up to n and of the merge before
    def _marks(self) -> dict[int, set[str]]:
        marks: dict[int, set[str]] = {}
        for name in self.files.names(self.path("runs")):
            run, kind = name.split(".")
            marks.setdefault(int(run), set()).add(kind)
        return marks

    def runs(self) -> list[int]:
        """Runs whose rows count, a stopped run's among them (its rows are stored as far as it came)."""
        marks = self._marks()
        merges = sorted((r, int(k[7:])) for r, kinds in marks.items() for k in kinds if k.startswith("merged="))
        if not merges:
            return sorted(marks)
        last, upto = merges[-1]
        return sorted(r for r in marks if r == last or (r > upto and r not in {m for m, _ in merges}))

    def new_runs(self, after: int) -> list[int]:
        """Finished runs after ``after``; a merge holds nothing new."""
        return sorted(r for r, kinds in self._marks().items() if r > after and "done" in kinds)

    def feed(self, after: int) -> DataFrame:
        """The events of the finished runs after ``after``: no older folder is listed, the plan filters on ``run_id``."""
        rows = self._stored("file_events", self.new_runs(after)).where(F.col(RUN) > after)
        return rows.select(*TABLE_SCHEMAS["file_events"].fieldNames())

    def _run_folders(self) -> set[int]:
        return {int(f.split("=")[1]) for f in self.files.names(self.path("file_events")) if f.startswith(f"{RUN}=")}

    def _next_run(self) -> int:
        return max([*self._marks(), *self._run_folders()], default=-1) + 1

    def _mark(self, run: int, kind: str) -> None:
        self.files.touch(f"{self.path('runs')}/{run}.{kind}")

    def close_stopped_runs(self) -> None:
        """Finish runs that stopped before their mark (there is one writer, and it is here now): evaluate may fold them."""
        for run, kinds in self._marks().items():
            if kinds == {"open"}:
                self._mark(run, "done")

    def append_run(self, df: DataFrame) -> int:
        run = self._next_run()
        self._mark(run, "open")
        self._write("file_events", df, f"{self.path('file_events')}/{RUN}={run}")
        self._mark(run, "done")
        return run

    def merge_runs(self, least: int = 2) -> int | None:
        """Rewrite the folded runs as one, so that reads list one folder per date; returns its id.

        With one marker file the new run counts and the old ones stop counting: stopped before it, nothing has
        changed. Their folders go with the next merge, when no reader of then is left.
        """
        live = self.state.live()
        upto = live[-1].run if live else -1
        marks, counting = self._marks(), self.runs()
        stale = self._run_folders() - set(counting)
        folded = [r for r in counting if r <= upto or "done" not in marks[r]]
        if len(folded) < least:
            return None
        run = self._next_run()
        self._write("file_events", self._stored("file_events", folded), f"{self.path('file_events')}/{RUN}={run}")
        self._mark(run, f"merged={upto}")
        for old in folded:
            for kind in marks[old]:
                self.files.remove(f"{self.path('runs')}/{old}.{kind}")
        for old in stale:
            self.files.remove(f"{self.path('file_events')}/{RUN}={old}")
        return run
