"""Folders of a table: listing, moving and deleting where Spark's writers offer no way."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


class Files:
    """The file system below ``root``; paths are relative to it. Takes no Spark job."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self._path(f"{self.root}/{path}" if path else self.root)

    def names(self, path: str = "", folders: bool | None = None) -> list[str]:
        """What a folder holds, nothing if it is missing; only folders or only files if asked for."""
        where = self.at(path)
        if not self._files.exists(where):
            return []
        found = self._files.listStatus(where)
        return sorted(x.getPath().getName() for x in found if folders is None or x.isDirectory() == folders)

    def below(self, path: str, depth: int) -> list[str]:
        """Folders ``depth`` levels down whose names read ``key=value``, relative to ``path``."""
        found = [""]
        for _ in range(depth):
            found = [
                f"{parent}/{name}".lstrip("/") for parent in found
                for name in self.names(f"{path}/{parent}".strip("/"), folders=True) if "=" in name
            ]
        return found

    def exists(self, path: str) -> bool:
        return self._files.exists(self.at(path))

    def age(self, path: str, now: float) -> float:
        """Seconds since the folder last changed."""
        return now - self._files.getFileStatus(self.at(path)).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._files.delete(self.at(path), True)

    def empty(self, path: str) -> None:
        """Delete what a folder holds; the folder stays."""
        for name in self.names(path):
            self.delete(f"{path}/{name}")

    def move(self, source: str, target: str) -> None:
        """Rename; the target's parents are made, and it must not be there."""
        self._files.mkdirs(self.at(target).getParent())
        if not self._files.rename(self.at(source), self.at(target)):
            raise OSError(f"{self.root}: cannot move {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """All of it or nothing: readers never see half a file."""
        stream = self._files.create(self.at(f"{path}.new"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(f"{path}.new", path)

    def read_text(self, path: str) -> str:
        stream = self._files.open(self.at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def partition_name(self, keys: Iterable[str], values: Iterable[object]) -> str:
        """The folder of a partition, spelt as Spark does."""
        spelt = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return "/".join(spelt.getPartitionPathString(key, str(value)) for key, value in zip(keys, values))
