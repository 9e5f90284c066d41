"""Small file-system steps by Hadoop's interface: any store that Spark reads, no local paths."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Storage:
    """Existence, names, markers and removal of files and folders."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def names(self, path: str) -> list[str]:
        """Names in a folder (none, where it is missing)."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def folders(self, path: str) -> list[str]:
        """The folders in a folder, as paths."""
        fs, p = self._at(path)
        return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())

    def touch(self, path: str) -> None:
        """An empty file. It is there or not: a marker has no half-written form."""
        fs, p = self._at(path)
        fs.create(p, True).close()

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
