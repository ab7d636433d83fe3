"""The few file-system calls the driver needs, on whatever file system a path names."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._io = jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self, path: str) -> str:
        """A path with its file system, as Spark names it in plans."""
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def ages(self, path: str) -> dict[str, float]:
        """Hours since each entry of a folder was last changed, by the clock of the driver."""
        if not self.exists(path):
            return {}
        now = time.time() * 1000
        return {s.getPath().getName(): (now - s.getModificationTime()) / 3_600_000 for s in self._fs.listStatus(self._path(path))}

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, path: str, text: str) -> None:
        """Write a small file that appears whole or not at all, and never replaces one."""
        if self.exists(path):
            raise FileExistsError(path)
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/_draft-{name}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if not self._fs.rename(draft, self._path(path)):
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
