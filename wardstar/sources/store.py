"""Small files and directories of a warehouse, through the file system API that Spark itself uses.

Commit records, claims and manifests are a few lines each; the driver reads
and writes them without a Spark job, in whatever store the warehouse lives.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Store:
    """Paths are relative to ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        at = self._path("")
        self._fs = at.getFileSystem(self._conf)
        # renames through a FileContext fail, rather than replace, when the target exists
        self._files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        self._no_options = spark.sparkContext._gateway.new_array(rename, 0)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """Write a file that must not exist: whole or not at all, and False if someone else was first."""
        folder, _, last = name.rpartition("/")
        draft = self._path(f"{folder}/.{last}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self._files.rename(draft, self._path(name), self._no_options)
        except Py4JJavaError as ex:
            self._fs.delete(draft, False)
            if ex.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        """Delete a file, or a folder with all that is in it."""
        self._fs.delete(self._path(name), True)
