"""Tables kept in parts, of which a new version replaces some and shares the others.

A version is a manifest: a small file that names, for each table, its schema and the folder of each part. Folders are
written once and never changed. The manifest is written last, under a temporary name, and renamed: until then readers
see the old version whole, and what a failed job has left is written over by the next one. Folders that no kept
manifest names are removed by ``vacuum`` alone, so a reader can go on with the version that it began with.

One writer at a time: a second one that has begun from the same version cannot commit. Parts are few (months, or one
for each refresh), so a manifest is small whatever the data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from casebook.sinks.tables import _write_counted

PART = "part"
PARTS_AT_ONCE = 16  # parts that a task writes without sorting its rows by part; beyond that it sorts
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_at_once(spark: SparkSession, files: int) -> Iterator[None]:
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, files)
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES, before)


class Folder:
    """Files of any file system that Spark reaches, by the driver: names and small files only."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self.path = path.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._system = self._at().getFileSystem(conf)

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def names(self, *at: str) -> list[str]:
        place = self._at(*at)
        return [s.getPath().getName() for s in self._system.listStatus(place)] if self._system.exists(place) else []

    def read(self, *name: str) -> str:
        stream = self._system.open(self._at(*name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, text: str, *name: str) -> bool:
        """Writes a whole file or none; false if there is one of that name already."""
        *at, last = name
        beside = self._at(*at, f".{last}.writing")
        stream = self._system.create(beside, True)
        stream.write(text.encode())
        stream.close()
        if self._system.exists(self._at(*name)):
            return False
        return bool(self._system.rename(beside, self._at(*name)))

    def delete(self, *name: str) -> None:
        self._system.delete(self._at(*name), True)


@dataclass(frozen=True)
class Table:
    schema: str
    parts: dict[str, str] = field(default_factory=dict)  # folder of each part, below the root


class ConcurrentWriteError(RuntimeError):
    pass


class VersionedTables:
    """The tables below ``root``, as of the newest version or of a given one."""

    MANIFESTS = "manifests"

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self.version = max(self.versions(), default=0) if version is None else version
        self.tables = self._manifest(self.version)

    def versions(self) -> list[int]:
        names = self.folder.names(self.MANIFESTS)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _manifest(self, version: int) -> dict[str, Table]:
        if not version:
            return {}
        content = json.loads(self.folder.read(self.MANIFESTS, f"{version:08d}.json"))
        return {name: Table(**table) for name, table in content["tables"].items()}

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.tables[name].schema))

    def parts(self, name: str) -> list[str]:
        return sorted(self.tables[name].parts)

    def read(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or some of its parts; no other folder is listed or scanned."""
        table = self.tables[name]
        wanted = table.parts if parts is None else {p: table.parts[p] for p in parts if p in table.parts}
        if not wanted:
            return self.spark.createDataFrame([], self.schema(name))
        return self.spark.read.schema(self.schema(name)).parquet(*[f"{self.root}/{f}" for f in sorted(set(wanted.values()))])

    def begin(self) -> Draft:
        return Draft(self)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes all but the newest ``keep`` versions, and folders that those do not name. Returns the removed folders."""
        kept = self.versions()[-keep:] if keep > 0 else []
        if not kept:
            return []
        for version in self.versions()[:-keep]:
            self.folder.delete(self.MANIFESTS, f"{version:08d}.json")
        named = {f for version in kept for table in self._manifest(version).values() for f in table.parts.values()}
        removed = []
        for name in self.folder.names():
            if name == self.MANIFESTS:
                continue
            for version in self.folder.names(name):
                if int(version.removeprefix("v")) > kept[-1]:  # of a job that has not committed yet
                    continue
                whole = f"{name}/{version}"
                below = [f"{whole}/{part}" for part in self.folder.names(name, version) if part.startswith(f"{PART}=")]
                for folder in below or [whole]:
                    if folder not in named:
                        self.folder.delete(*folder.split("/"))
                        removed.append(folder)
                if below and not named & set(below):
                    self.folder.delete(*whole.split("/"))
            if not self.folder.names(name):
                self.folder.delete(name)
        return removed


class Draft:
    """The next version, which nobody sees before ``commit``."""

    def __init__(self, base: VersionedTables):
        self.base, self.version = base, base.version + 1
        self.tables = dict(base.tables)
        self.rows: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.base.root}/{name}/v{self.version:08d}"

    def read(self, name: str, parts: Iterable[str]) -> DataFrame:
        """Some parts of a table as this draft has them."""
        table = self.tables[name]
        schema = T.StructType.fromJson(json.loads(table.schema))
        wanted = sorted({table.parts[p] for p in parts if p in table.parts})
        spark = self.base.spark
        return spark.read.schema(schema).parquet(*[f"{self.base.root}/{f}" for f in wanted]) if wanted else spark.createDataFrame([], schema)

    def _commit_table(self, name: str, schema: T.StructType, parts: dict[str, str], rows: int) -> int:
        self.tables[name] = Table(schema.json(), parts)
        self.rows[name] = rows
        return rows

    def replace_parts(self, name: str, df: DataFrame, touched: Sequence[str] | None = None, laid_out: bool = False) -> int:
        """Writes ``df``, laid out by its column ``part``, in place of the ``touched`` parts (all, if not given).

        A touched part without rows is gone in the new version; all other parts are shared with the old one.
        Small parts are gathered in few files, and a part that holds much is split over tasks. Rows that are ``laid_out``
        already, few parts to a task, are written by the tasks that have them: nothing is shuffled.
        """
        if laid_out:
            with _open_at_once(self.base.spark, PARTS_AT_ONCE):
                rows = _write_counted(df, self.path(name), "overwrite", (PART,), partitionOverwriteMode="static")
        else:
            rows = _write_counted(df.hint("rebalance", PART), self.path(name), "overwrite", (PART,), partitionOverwriteMode="static")
        schema = T.StructType([f for f in df.schema.fields if f.name != PART])
        old = self.tables[name].parts if name in self.tables and touched is not None else {}
        parts = {p: f for p, f in old.items() if p not in set(touched or ())}
        for folder in self.base.folder.names(name, f"v{self.version:08d}"):
            if folder.startswith(f"{PART}="):
                parts[folder.removeprefix(f"{PART}=")] = f"{name}/v{self.version:08d}/{folder}"
        return self._commit_table(name, _nullable(schema), parts, rows)

    def append(self, name: str, df: DataFrame) -> int:
        """Adds the rows as a part of their own, if there are any."""
        rows = _write_counted(df, self.path(name), "overwrite")
        parts = dict(self.tables[name].parts) if name in self.tables else {}
        if rows or not parts:
            parts[f"{self.version:08d}"] = f"{name}/v{self.version:08d}"
        return self._commit_table(name, _nullable(df.schema), parts, rows)

    def replace(self, name: str, df: DataFrame) -> int:
        """Writes the whole table anew as one part."""
        rows = _write_counted(df, self.path(name), "overwrite")
        return self._commit_table(name, _nullable(df.schema), {f"{self.version:08d}": f"{name}/v{self.version:08d}"}, rows)

    def commit(self) -> VersionedTables:
        """Makes the draft the newest version, in one step."""
        tables = {name: {"schema": table.schema, "parts": table.parts} for name, table in self.tables.items()}
        text = json.dumps({"version": self.version, "tables": tables}, indent=1)
        if not self.base.folder.create(text, VersionedTables.MANIFESTS, f"{self.version:08d}.json"):
            raise ConcurrentWriteError(f"version {self.version} of {self.base.root} has been written by another job")
        return VersionedTables(self.base.spark, self.base.root)


def _nullable(schema: T.StructType) -> T.StructType:
    """As files are read back: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
