"""The few file operations a commit needs, on any store Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """List, put in place and remove small files through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def numbers(self, folder: str) -> list[int]:
        """Numbers of the ``.json`` files of a folder, in order."""
        return sorted(int(n[:-5]) for n in self.names(folder) if n.endswith(".json") and not n.startswith("."))

    def put(self, folder: str, number: int, text: str) -> None:
        """Write a numbered file whose number must be free; it is there as a whole or not at all."""
        name = f"{number:012}.json"
        beside, final = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}"), self._path(f"{folder}/{name}")
        out = self.fs.create(beside)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(final) or not self.fs.rename(beside, final):
            self.fs.delete(beside, False)
            raise RuntimeError(f"{final}: another writer was faster; nothing was changed")

    def drop(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def read_numbered(spark: SparkSession, folder: str, number: int) -> str:
    return spark.read.text(f"{folder}/{number:012}.json", wholetext=True).first()["value"]
