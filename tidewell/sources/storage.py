"""Small files and folders through Hadoop's file systems, so that any shared storage will do."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self.jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if it is missing."""
        system, place = self._at(folder)
        return [x.getPath().getName() for x in system.listStatus(place)] if system.exists(place) else []

    def matching(self, pattern: str) -> list[str]:
        system, place = self._at(pattern)
        return [x.getPath().toString() for x in system.globStatus(place) or []]

    def read(self, path: str) -> str:
        system, place = self._at(path)
        try:
            stream = system.open(place)
        except Py4JJavaError as error:
            if "FileNotFound" in error.java_exception.getClass().getName():
                raise FileNotFoundError(path) from None
            raise
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, contents: str) -> bool:
        """Write a file that becomes visible whole or not at all. False if there is one by that name."""
        system, place = self._at(path)
        draft = self.jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}")
        stream = system.create(draft)
        stream.write(bytearray(contents.encode()))
        stream.close()
        if system.exists(place) or not system.rename(draft, place):
            system.delete(draft, False)
            return False
        return True

    def replace(self, path: str, contents: str) -> None:
        self.delete(path)
        self.write_new(path, contents)

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)
