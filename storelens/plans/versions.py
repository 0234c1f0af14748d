"""Versioned folders: a build writes a folder of its own, and a published name makes it the live one.

Under a root lie ``versions/<n>``, one folder per build, and ``published/<n>``, an empty file per build that ended. The live
version is the highest published one. A reader looks it up once and keeps to its folder, so that it sees one build from
beginning to end, whatever is written meanwhile. A build that fails publishes nothing. Nothing is overwritten or renamed:
claiming and publishing a version each create one file, which a store does wholly or not at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelens.session import remove_path
from storelens.sources.parquet import overwrite

_DIGITS = 8


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def live(self) -> str | None:
        """The folder of the live version."""
        published = self._numbers("published")
        return self.folder(max(published)) if published else None

    def folder(self, number: int) -> str:
        return f"{self.root}/versions/{number:0{_DIGITS}}"

    def begin(self) -> str:
        """A new folder to build in. Of two builds that claim one number at once, one takes the next."""
        number = max([0, *self._numbers("versions"), *self._numbers("published")]) + 1
        while not self._created(f"{self.folder(number)}/_claimed"):
            number += 1
        return self.folder(number)

    def publish(self, folder: str) -> None:
        """Make ``folder`` the live version, unless a later one is live already."""
        self._created(f"{self.root}/published/{folder.rsplit('/', 1)[1]}")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all versions below the last ``keep`` published ones, failed builds among them; returns what went.

        Readers that still hold one of these lose their files. Later numbers stay: a build may be on its way there.
        """
        published = sorted(self._numbers("published"))
        if not published:
            return []
        least = published[-keep:][0]
        gone = [n for n in sorted(self._numbers("versions")) if n < least]
        for number in gone:
            remove_path(self.spark, f"{self.root}/published/{number:0{_DIGITS}}")
            remove_path(self.spark, self.folder(number))
        return [self.folder(n) for n in gone]

    def _numbers(self, name: str) -> list[int]:
        path, files = self._at(f"{self.root}/{name}")
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return [int(n) for n in names if n.isdigit()]

    def _created(self, name: str) -> bool:
        """Create an empty file; false if it is there already."""
        path, files = self._at(name)
        if files.exists(path):
            return False
        try:
            files.create(path, False).close()
        except Exception:
            if files.exists(path):
                return False
            raise
        return True

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())


def load(df: DataFrame, root: str, columns: list[str] | None = None, partition_by: list[str] | None = None) -> int:
    """Replace a table wholly or not at all; returns the rows written. Readers take it with ``read``."""
    versions = Versions(df.sparkSession, root)
    folder = versions.begin()
    rows = overwrite(df, f"{folder}/rows", columns, partition_by)
    versions.publish(folder)
    return rows


def read(spark: SparkSession, root: str) -> DataFrame:
    """The live version of a table that ``load`` writes."""
    live = Versions(spark, root).live()
    if live is None:
        raise FileNotFoundError(f"{root} holds no loaded table")
    return spark.read.parquet(f"{live}/rows")
