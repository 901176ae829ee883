"""The few file operations that tables need, on whatever store a path lies in."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Folder:
    """A folder of the session's file system; names are relative to it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = lambda name="": spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}" if name else path)
        self._files = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str = "") -> bool:
        return self._files.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """Entries of the folder, none where there is no folder."""
        if not self.exists(name):
            return []
        return sorted(f.getPath().getName() for f in self._files.listStatus(self._path(name)))

    def age(self, name: str) -> float:
        """Seconds since the entry was last changed."""
        return time.time() - self._files.getFileStatus(self._path(name)).getModificationTime() / 1000

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False, and nothing written, where one of that name exists."""
        if self.exists(name):
            return False
        try:
            out = self._files.create(self._path(name), False)
        except Exception:
            if self.exists(name):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def text(self, name: str) -> str:
        size = self._files.getFileStatus(self._path(name)).getLen()
        stream = self._files.open(self._path(name))
        try:
            return bytes(stream.readNBytes(int(size))).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self._files.delete(self._path(name), True)
