"""Numbered commits in a shared folder: what a writer made visible, one JSON file each, moved into place whole."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed under this number."""


class Folder:
    """A folder of any file system that Spark reaches, a path or URI."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self.system = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.root, name)

    def names(self, name: str = "") -> list[str]:
        place = self.at(name) if name else self.root
        return sorted(s.getPath().getName() for s in self.system.listStatus(place)) if self.system.exists(place) else []

    def read(self, name: str) -> str | None:
        place = self.at(name)
        if not self.system.exists(place):
            return None
        stream = self.system.open(place)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def put(self, name: str, text: str, replace: bool = False) -> None:
        """Writes a file whole: a reader sees all of it or nothing. One that is there stays, unless it is to be replaced."""
        made = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.system.create(made, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
            stream.hsync()
        finally:
            stream.close()
        how = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(how, 1)
        options[0] = how.OVERWRITE if replace else how.NONE
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self.system.makeQualified(made), self.system.makeQualified(self.at(name)), options)
        except Py4JJavaError as e:
            self.system.delete(made, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise Conflict(f"{self.path}/{name} is there") from e
            raise

    def remove(self, name: str) -> None:
        self.system.delete(self.at(name), True)


class Commits:
    """Versions 1, 2, ... of a table: each a dict, visible once its file is in place."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, f"{path.rstrip('/')}/_commits")

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names() if n.endswith(".json")]

    def load(self, version: int | None = None) -> tuple[int, dict[str, Any]]:
        """The newest version, or the one asked for; version 0 is empty."""
        there = self.versions()
        if version is not None and version and version not in there:
            raise ValueError(f"version {version} is not one of {there}")
        number = max(there, default=0) if version is None else version
        return number, json.loads(self.folder.read(f"{number:012d}.json") or "{}") if number else {}

    def commit(self, number: int, state: dict[str, Any]) -> int:
        """Makes state the version number; Conflict if there is one."""
        self.folder.put(f"{number:012d}.json", json.dumps(state, sort_keys=True))
        return number
