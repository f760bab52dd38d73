"""Small files and folders on whatever store Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        store, where = self._at(path)
        return store.exists(where)

    def remove(self, path: str) -> None:
        store, where = self._at(path)
        store.delete(where, True)

    def make_folder(self, path: str) -> None:
        store, where = self._at(path)
        store.mkdirs(where)

    def move(self, source: str, target: str) -> None:
        store, where = self._at(target)
        store.mkdirs(where.getParent())
        if not store.rename(self._at(source)[1], where):
            raise OSError(f"cannot move {source} to {target}")

    def write_whole(self, path: str, text: str) -> None:
        """The file appears with all of its text."""
        aside = f"{path.rpartition('/')[0]}/_{path.rpartition('/')[2]}.part"
        store, where = self._at(aside)
        out = store.create(where, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(aside, path)
