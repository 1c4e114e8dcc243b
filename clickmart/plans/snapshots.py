"""Versioned rebuilds: the tables of one run become visible together, or not at all.

    <root>/versions/<run>/<table>      Parquet, never overwritten
    <root>/commits/000000000012.json   the tables of version 12 with their paths and schemas

A rebuild writes all of its tables into a new folder and commits one small file at last.  A run
that fails half-way leaves the former version as it was, and readers pin a version: all tables
they open are of one run, also while the next one is committed.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.commits import CommitLog, Folder

_STAMP = "%Y%m%dT%H%M%S%f"


@dataclass(frozen=True)
class Snapshot:
    """The tables of one committed version."""

    spark: SparkSession
    root: str
    version: int
    manifest: dict

    @property
    def tables(self) -> list[str]:
        return sorted(self.manifest["tables"])

    @property
    def notes(self) -> dict:
        return self.manifest["notes"]

    def path(self, table: str) -> str:
        return f"{self.root}/{self.manifest['tables'][table]['path']}"

    def read(self, table: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.manifest["tables"][table]["schema"]))
        return self.spark.read.schema(schema).parquet(self.path(table))


@dataclass
class Rebuild:
    """A version being written; nothing of it can be seen before it is committed."""

    spark: SparkSession
    root: str
    run: str
    tables: dict[str, dict] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)
    version: int | None = None  # once committed

    def folder(self, table: str) -> str:
        return f"{self.root}/versions/{self.run}/{table}"

    def add(self, table: str, schema: T.StructType) -> DataFrame:
        """A table that the caller wrote to ``folder(table)``."""
        self.tables[table] = {"path": f"versions/{self.run}/{table}", "schema": schema.json()}
        return self.spark.read.schema(schema).parquet(self.folder(table))

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Write a table of the new version and return it as written."""
        df.write.parquet(self.folder(table))
        return self.add(table, df.schema)


class Snapshots:
    """The versions under a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")

    def latest(self) -> Snapshot | None:
        version, manifest = self.log.read()
        return None if version is None else Snapshot(self.spark, self.root, version, manifest)

    def pin(self, version: int | None = None) -> Snapshot:
        """A version to read from; the latest by default."""
        version, manifest = self.log.read(version)
        if version is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return Snapshot(self.spark, self.root, version, manifest)

    @contextmanager
    def rebuild(self) -> Iterator[Rebuild]:
        """Commits when the block ends; commits nothing when it raises."""
        run = f"{datetime.now(timezone.utc):{_STAMP}}-{uuid.uuid4().hex[:8]}"
        new = Rebuild(self.spark, self.root, run)
        yield new
        manifest = {"run": run, "tables": new.tables, "notes": new.notes}
        # a rebuild is whole, so one that lost the number to another run takes the next
        while new.version is None:
            new.version = self.log.commit(manifest, self.log.latest())

    def expire(self, keep: int = 2, unfinished_before: datetime | None = None) -> list[str]:
        """Delete all but the ``keep`` latest versions, and the folders of runs that began before
        ``unfinished_before`` (UTC) and never committed.  Returns the deleted runs.

        Readers of the deleted versions must have ended.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = sorted(self.log.versions())
        runs = {v: self.log.read(v)[1]["run"] for v in versions}
        old, kept = versions[:-keep], {runs[v] for v in versions[-keep:]}
        gone = [runs[v] for v in old if runs[v] not in kept]
        for v in old:
            self.log.forget(v)  # first, so that no commit names what is gone
        folder = Folder(self.spark, f"{self.root}/versions")
        if unfinished_before is not None:
            limit = unfinished_before.strftime(_STAMP)
            gone += [n for n in folder.names() if n not in runs.values() and n.split("-")[0] < limit]
        for run in gone:
            folder.delete(run)
        return sorted(gone)
