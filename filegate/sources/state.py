"""The group state as versions: a run's changes appear whole or not at all.

A commit writes the changed rows of three tables into folders of a new version and then one empty marker file
whose name says what the version covers. Readers list the markers: the latest base and the later
versions count, a folder without marker does not exist for them. A run that stops anywhere before the marker
leaves the old state, and the next commit takes a higher number.

* ``groups`` - one row per group;
* ``part_bitmaps`` - the received part numbers of a group as bitmaps of 32,768 numbers;
* ``announced`` - one row per group and announced count, with its first manifest.

A row of a later version replaces the one of the same key. After ``DELTAS`` versions a commit writes all
rows, as a new base; versions older than the base before it are removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filegate.schemas import STATE_KEYS, STATE_SCHEMAS
from filegate.sources.storage import Storage

PARTITION = "dt_ref"
DELTAS = 24


@dataclass(frozen=True)
class Version:
    """A complete version: its number, whether it holds all rows, the last run folded into it, and the timeout."""

    number: int
    base: bool
    run: int
    timeout: int

    @property
    def marker(self) -> str:
        return f"{self.number:010d}.{'base' if self.base else 'delta'}.run={self.run}.timeout={self.timeout}"

    @staticmethod
    def of(marker: str) -> Version:
        number, kind, run, timeout = marker.split(".")
        return Version(int(number), kind == "base", int(run.split("=")[1]), int(timeout.split("=")[1]))


class GroupState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, f"{root}/state", Storage(spark)

    def versions(self) -> list[Version]:
        """Complete versions in order, old ones that no reader uses any more included."""
        return sorted(map(Version.of, self.files.names(f"{self.root}/complete")), key=lambda v: v.number)

    def live(self) -> list[Version]:
        """The latest base and what came after it."""
        versions = self.versions()
        last = max((i for i, v in enumerate(versions) if v.base), default=len(versions))
        return versions[last:]

    def _folder(self, name: str, number: int) -> str:
        return f"{self.root}/{name}/version={number:010d}"

    def _load(self, name: str, versions: list[Version]) -> DataFrame:
        schema = T.StructType([*STATE_SCHEMAS[name].fields, T.StructField("version", T.LongType())])
        if not versions:
            return self.spark.createDataFrame([], schema)
        paths = [self._folder(name, v.number) for v in versions]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def read(self, name: str = "groups", rule: Column | None = None) -> DataFrame:
        """The rows of a state table; ``rule`` (on ``dt_ref``) prunes the partitions of every version."""
        keys, columns = STATE_KEYS[name], STATE_SCHEMAS[name].fieldNames()
        live = self.live()
        base, deltas = (self._load(name, vs) for vs in (live[:1], live[1:]))
        if rule is not None:
            base, deltas = base.where(rule), deltas.where(rule)
        if len(live) < 2:
            return base.select(*columns)
        rest = [c for c in columns if c not in keys]
        latest = deltas.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_row")).select(*keys, "_row.*")
        kept = base.join(latest.select(*keys), keys, "left_anti")
        return kept.select(*columns).unionByName(latest.select(*columns))

    def commit(self, changes: dict[str, DataFrame], run: int | None = None, timeout: int | None = None,
               whole: bool = False) -> Version:
        """Make the rows of ``changes`` (staged) the latest of their keys; ``whole`` says that they are all rows.

        ``run`` and ``timeout`` stay those of the version before where they are not given.
        """
        live = self.live()
        before = live[-1] if live else Version(0, True, -1, -1)
        base = whole or not live or len(live) > DELTAS
        version = Version(self._next(), base, before.run if run is None else run,
                          before.timeout if timeout is None else timeout)
        for name, schema in STATE_SCHEMAS.items():
            rows = changes.get(name, self.spark.createDataFrame([], schema)).select(*schema.fieldNames())
            if base and not whole:
                rows = self.read(name).join(rows.select(*STATE_KEYS[name]), STATE_KEYS[name], "left_anti").unionByName(rows)
            self.write(name, rows, version.number)
        self.complete(version)
        self._clean()
        return version

    def write(self, name: str, rows: DataFrame, number: int) -> None:
        """One table of a version, rebalanced on the date: a file per date or so, a hot date split."""
        rows = rows.hint("rebalance", F.col(PARTITION))
        rows.write.mode("overwrite").partitionBy(PARTITION).parquet(self._folder(name, number))

    def complete(self, version: Version) -> None:
        self.files.touch(f"{self.root}/complete/{version.marker}")

    def _next(self) -> int:
        """A number above all, those of versions without marker included."""
        used = [v.number for v in self.versions()]
        for name in STATE_SCHEMAS:
            used += [int(f.split("=")[1]) for f in self.files.names(f"{self.root}/{name}") if f.startswith("version=")]
        return max(used, default=0) + 1

    def _clean(self) -> None:
        """Remove versions before the last base but one: readers of the state before this one still find theirs."""
        versions = self.versions()
        bases = [v.number for v in versions if v.base]
        if len(bases) < 3:
            return
        for v in versions:
            if v.number < bases[-2]:
                self.files.remove(f"{self.root}/complete/{v.marker}")
                for name in STATE_SCHEMAS:
                    self.files.remove(self._folder(name, v.number))
