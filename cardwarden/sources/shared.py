"""Single files on the file system all machines share, through the file API Spark brings along.

Only names, moves and small texts pass here; rows are read and written by Spark.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    """A file or folder: full path, name, bytes, time of last change in milliseconds."""

    path: str
    name: str
    length: int
    modified: int
    is_folder: bool


class SharedFiles:
    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        """The path with the file system Spark would take it for."""
        return self._system(path).makeQualified(self._path(path)).toString()

    def entries(self, folder: str) -> list[Entry]:
        """What lies in a folder; nothing if there is no such folder."""
        try:
            found = self._system(folder).listStatus(self._path(folder))
        except Py4JJavaError as error:
            if _raised(error, "FileNotFoundException"):
                return []
            raise
        return [
            Entry(
                status.getPath().toString(),
                status.getPath().getName(),
                status.getLen(),
                status.getModificationTime(),
                status.isDirectory(),
            )
            for status in found
        ]

    def size(self, folder: str) -> int:
        """Bytes of all files below a folder."""
        return self._system(folder).getContentSummary(self._path(folder)).getLength()

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def read(self, path: str) -> str | None:
        """A small text file; None if it is gone."""
        try:
            source = self._system(path).open(self._path(path))
        except Py4JJavaError as error:
            if _raised(error, "FileNotFoundException"):
                return None
            raise
        text = self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return text

    def delete(self, path: str) -> bool:
        return self._system(path).delete(self._path(path), True)

    def move(self, source: str, target: str) -> bool:
        """Rename; False if the source is gone or the target is taken. Never replaces a file.

        On a file system whose rename is atomic, of several callers one gets True.
        """
        system = self._system(source)
        system.mkdirs(self._path(target).getParent())
        source_path = system.makeQualified(self._path(source))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            source_path.toUri(), self._conf
        )
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source_path, system.makeQualified(self._path(target)), options)
        except Py4JJavaError as error:
            if _raised(error, "FileAlreadyExistsException") or _raised(
                error, "FileNotFoundException"
            ):
                return False
            raise
        return True

    def put_once(self, path: str, text: str) -> bool:
        """Write a small text file whole or not at all; False if the name is taken."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/_drafts/{name}-{uuid.uuid4().hex}"
        out = self._system(draft).create(self._path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.move(draft, path):
            return True
        self.delete(draft)
        return False


def _raised(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name
