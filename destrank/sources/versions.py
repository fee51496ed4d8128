"""Tables that are replaced together.

Every load writes its tables to new folders and then adds one entry to a log
of versions. An entry names the folder of every table, so readers see all new
tables or all old ones; the entry with the highest number is the current one.
A load states the version that it started from and fails if another load has
added the next one meanwhile. Folders of a failed load are named by no entry.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from destrank.operators.quality import observed
from destrank.sources import commits


class CommitConflict(RuntimeError):
    """Another load added a version since the one that this load started from."""


@dataclass(frozen=True)
class Table:
    """Where a version of a table lies, its schema and its number of rows."""

    folder: str
    schema: str
    rows: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType.fromJson(json.loads(self.schema))).parquet(self.folder)


@dataclass(frozen=True)
class Snapshot:
    """One version: what it names stays readable until it is expired."""

    version: int
    tables: Mapping[str, Table] = field(default_factory=dict)
    note: Mapping[str, object] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"version {self.version} has no table {name}")
        return self.tables[name].read(spark)


def write_table(df: DataFrame, folder: str) -> Table:
    """``df`` as Parquet in a new folder; its rows are counted by the same job."""
    watched, obs = observed(df, f"rows-{uuid.uuid4().hex}")
    watched.write.parquet(folder)
    return Table(folder, df.schema.json(), int(obs.get["rows"]))


class VersionedTables:
    """The tables below ``root`` (any Hadoop URI)."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _entry(self, version: int) -> str:
        return f"{self.root}/log/{version:020d}.json"

    def versions(self) -> list[int]:
        names = commits.children(self.spark, f"{self.root}/log")
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version, the current one by default; version 0 has no tables."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            return Snapshot(0)
        told = json.loads(commits.read_text(self.spark, self._entry(version)))
        return Snapshot(version, {n: Table(**t) for n, t in told["tables"].items()}, told["note"])

    def new_folder(self, name: str) -> str:
        return f"{self.root}/data/{name}/{uuid.uuid4().hex}"

    def commit(self, base: Snapshot, tables: Mapping[str, Table], note: Mapping[str, object] | None = None) -> Snapshot:
        """The version after ``base``: its tables, with ``tables`` in place of
        those of the same name. Raises if ``base`` is no longer current."""
        merged = {**base.tables, **tables}
        told = {"tables": {n: vars(t) for n, t in sorted(merged.items())}, "note": dict(note or {})}
        if not commits.publish(self.spark, self._entry(base.version + 1), json.dumps(told)):
            raise CommitConflict(f"version {base.version + 1} of {self.root} was added by another load")
        return Snapshot(base.version + 1, merged, told["note"])

    def replace(self, tables: Mapping[str, DataFrame], base: Snapshot | None = None) -> Snapshot:
        """Writes all ``tables`` and then makes them current together."""
        base = self.snapshot() if base is None else base
        return self.commit(base, {n: write_table(df, self.new_folder(n)) for n, df in tables.items()})

    def expire(self, keep: int = 2) -> int:
        """Forgets all but the last ``keep`` versions and deletes the folders
        that only they name; returns how many. A load under way is left alone:
        its folders are named by no version at all."""
        if keep < 1:
            raise ValueError("keep must be positive")
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        named = {t.folder for v in kept for t in self.snapshot(v).tables.values()}
        gone = {t.folder for v in old for t in self.snapshot(v).tables.values()} - named
        gone = {folder for folder in gone if folder.startswith(f"{self.root}/data/")}
        for v in old:
            commits.delete(self.spark, self._entry(v))
        for folder in gone:
            commits.delete(self.spark, folder)
        return len(gone)

