"""A commit log in a folder: numbered JSON files, each a whole manifest, created once and never changed.

What a commit names is written first; the commit file appears last, by a rename that fails where
the number is taken.  So a reader that takes the highest number sees all of a commit or nothing
of it, and two writers can't both take a number.  Files are reached through Spark's file systems
only, so the folder can be in any store that Spark reads.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self._conf)

    def names(self, name: str = "") -> list[str]:
        """Files and folders inside, sorted; none where it doesn't exist."""
        path, fs = self._at(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def files(self, name: str = "") -> int:
        """Data files below."""
        path, fs = self._at(name)
        if not fs.exists(path):
            return 0
        found, n = fs.listFiles(path, True), 0
        while found.hasNext():
            n += not found.next().getPath().getName().startswith(("_", "."))
        return n

    def exists(self, name: str) -> bool:
        path, fs = self._at(name)
        return bool(fs.exists(path))

    def read(self, name: str) -> str:
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False, and nothing changed, where there is one of that name."""
        folder, _, last = name.rpartition("/")
        draft, fs = self._at(f"{folder}/.{last}-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        final, _ = self._at(name)
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf).rename(draft, final, options)
            return True
        except Py4JJavaError as e:
            fs.delete(draft, False)
            if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)


class CommitLog:
    """Manifests (JSON objects) under consecutive numbers."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names() if n.endswith(".json") and n[:-5].isdigit()]

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def read(self, version: int | None = None) -> tuple[int | None, dict]:
        """(number, manifest); the latest by default, (None, {}) of an empty log."""
        version = self.latest() if version is None else version
        return (None, {}) if version is None else (version, json.loads(self.folder.read(f"{version:012d}.json")))

    def commit(self, manifest: dict, after: int | None) -> int | None:
        """The new number, one above ``after`` (None: of an empty log); None where another writer took it."""
        version = 0 if after is None else after + 1
        return version if self.folder.create(f"{version:012d}.json", json.dumps(manifest, sort_keys=True)) else None

    def forget(self, version: int) -> None:
        self.folder.delete(f"{version:012d}.json")
