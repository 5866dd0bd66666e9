"""Small files and folders on the file system that a path names."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """What the driver does with a folder besides reading and writing tables."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if there is no such folder."""
        if not self.exists(path):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(self._path(path))]

    def delete(self, path: str) -> None:
        """Delete a file or folder; one that is not there is no error."""
        self._files.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self._files.mkdirs(self._path(path))

    def read(self, path: str) -> str:
        stream = self._files.open(self._path(path))
        try:
            scanner = self._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
            return scanner.next() if scanner.hasNext() else ""
        finally:
            stream.close()

    def create(self, path: str, text: str, overwrite: bool = False) -> bool:
        """Write a small file; False if it is there already and must not be replaced."""
        try:
            stream = self._files.create(self._path(path), overwrite)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True


def keep_newest(spark: SparkSession, folder: str, n: int) -> None:
    """Of the folders ``batch_id=...`` keep the ``n`` with the greatest numbers."""
    files = Files(spark, folder)
    ids = sorted(int(name.split("=")[1]) for name in files.names(folder) if name.startswith("batch_id="))
    for i in ids[:-n]:
        files.delete(f"{folder}/batch_id={i}")
