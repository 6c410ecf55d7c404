"""Published tables: written whole beside the old ones, then made current.

A table is a folder of numbered versions, and the newest version that carries
Spark's ``_SUCCESS`` marker is the current one. A job that dies half-way leaves
the previous version in force, and nothing is renamed, so object stores serve too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Parquet codec, level and rows per row group.
PARQUET_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.block.row.count.limit": "256000",
}
_VERSION = re.compile(r"v=([0-9]+)")


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _files(self, path):
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _versions(self, name: str) -> list[int]:
        folder = self._path(name)
        files = self._files(folder)
        if not files.exists(folder):
            return []
        found = (_VERSION.fullmatch(s.getPath().getName()) for s in files.listStatus(folder))
        return sorted(int(m.group(1)) for m in found if m)

    def current(self, name: str) -> str | None:
        """The path of the newest complete version."""
        for version in reversed(self._versions(name)):
            marker = self._path(name, f"v={version}", "_SUCCESS")
            if self._files(marker).exists(marker):
                return f"{self.root}/{name}/v={version}"
        return None

    def has(self, name: str) -> bool:
        return self.current(name) is not None

    def exists(self, name: str) -> bool:
        folder = self._path(name)
        return self._files(folder).exists(folder)

    def read(self, name: str) -> DataFrame:
        path = self.current(name)
        if path is None:
            raise FileNotFoundError(f"no published table {name} under {self.root}")
        return self.spark.read.parquet(path)

    def write(self, name: str, frame: DataFrame, **options: str) -> str:
        """Write a new version; it is current once the write commits."""
        versions = self._versions(name)
        path = f"{self.root}/{name}/v={versions[-1] + 1 if versions else 1}"
        frame.write.options(**PARQUET_OPTIONS, **options).parquet(path)
        return path

    def append(self, name: str, frame: DataFrame) -> None:
        """Add rows to an unversioned log table."""
        frame.write.mode("append").options(**PARQUET_OPTIONS).parquet(f"{self.root}/{name}")

    def drop_version(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files(where).delete(where, True)

    def keep_only(self, name: str, path: str) -> None:
        """Delete every other version of a table."""
        for version in self._versions(name):
            other = f"{self.root}/{name}/v={version}"
            if other != path:
                self.drop_version(other)

    def purge(self, name: str) -> bool:
        """Delete a table with all its versions; tells whether there was one."""
        folder = self._path(name)
        return bool(self._files(folder).delete(folder, True))

    def size(self, path: str) -> int:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return self._files(where).getContentSummary(where).getLength()
