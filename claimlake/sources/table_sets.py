"""Sets of tables that readers see all together or not at all.

A set is a folder with one manifest, ``tables.json``, that names the folder of each table. A
commit writes every table to a folder that no manifest names yet, and puts the new manifest in
place last, by one atomic rename. Whatever fails before leaves the former manifest and its
folders as they were, and the new folders are removed. Folders that a commit replaces are removed
after it.

Facts may be stored bucketed and sorted by a key, with the rows of heavy keys in a folder of
their own beside: a bucket is read by one task, other files are split.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from claimlake.sources.writers import write_partitioned

MANIFEST = "tables.json"


@dataclass(frozen=True)
class Entry:
    """Where a table of a set lies, below the folder of the set, and how it was written."""

    path: str
    kind: str = "parquet"
    #: Column and number of the buckets, and the folder of the rows that are not in them.
    bucketed_by: str | None = None
    buckets: int = 0
    rest: str | None = None


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system that holds a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    files, where = _files(spark, path)
    files.delete(where, True)


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it over the old one."""
    beside = f"{path}.{uuid.uuid4().hex}"
    files, source = _files(spark, beside)
    stream = files.create(source, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm = spark._jvm
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(how, 1)
    over[0] = how.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(source), files.makeQualified(target), over)


class TableSet:
    """The tables of a folder, as its manifest names them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def entries(self) -> dict[str, Entry]:
        manifest = f"{self.folder}/{MANIFEST}"
        if not exists(self.spark, manifest):
            return {}
        text = self.spark.read.text(manifest, wholetext=True).first()[0]
        return {name: Entry(**entry) for name, entry in json.loads(text).items()}

    def location(self, path: str) -> str:
        return f"{self.folder}/{path}"

    def paths(self) -> dict[str, str]:
        return {name: self.location(e.path) for name, e in self.entries().items()}

    def read(self, name: str) -> DataFrame:
        """All rows of a table."""
        entry = self.entries()[name]
        if entry.kind == "csv":
            return self.spark.read.option("header", True).csv(self.location(entry.path))
        rows = self.spark.read.parquet(self.location(entry.path))
        return rows if entry.rest is None else rows.unionByName(self.spark.read.parquet(self.location(entry.rest)))

    def bucketed(self, name: str) -> DataFrame:
        """The bucketed rows of a table: joins and totals by its key need no exchange of them."""
        entry = self.entries()[name]
        if entry.bucketed_by is None:
            raise ValueError(f"table {name!r} is not bucketed")
        return open_bucketed(self.spark, self.location(entry.path), entry.bucketed_by, entry.buckets)

    def rest(self, name: str) -> DataFrame | None:
        """The rows of heavy keys, which are not in the buckets; None if there are none."""
        entry = self.entries()[name]
        return None if entry.rest is None else self.spark.read.parquet(self.location(entry.rest))

    @contextmanager
    def commit(self) -> Iterator[Commit]:
        """Write tables; they appear when the block ends, and not at all if it fails."""
        commit = Commit(self)
        try:
            yield commit
            commit._finish()
        except BaseException:
            commit.undo()
            raise


class Commit:
    """Tables written and not yet named by the manifest."""

    def __init__(self, tables: TableSet):
        self.tables, self.spark = tables, tables.spark
        self.written: dict[str, Entry] = {}
        self._folders: list[str] = []
        self._scratch: str | None = None
        self._ended = False

    def fresh(self, path: str) -> str:
        """``path``, or with a number before its ending if something lies there."""
        stem, dot, ending = path.rpartition(".")
        if not dot:
            stem, ending = path, ""
        k, free = 0, path
        while exists(self.spark, self.tables.location(free)):
            k += 1
            free = f"{stem}-{k}{dot}{ending}"
        self._folders.append(free)
        return free

    def write(self, name: str, df: DataFrame, path: str, kind: str = "parquet") -> DataFrame:
        """Write a table to a folder of its own and return it as read back."""
        free = self.fresh(path)
        where = self.tables.location(free)
        if kind == "csv":
            df.write.option("header", True).csv(where)
            self.written[name] = Entry(free, kind)
            return self.spark.read.schema(df.schema).option("header", True).csv(where)
        df.write.parquet(where)
        self.written[name] = Entry(free)
        return self.spark.read.schema(df.schema).parquet(where)

    def write_bucketed(self, name: str, df: DataFrame, path: str, key: str, buckets: int,
                       rest: DataFrame | None = None) -> None:
        """Write a table in buckets of ``key``, sorted by it; ``rest`` are rows beside them."""
        free = self.fresh(path)
        write_bucketed(df, self.tables.location(free), key, buckets)
        beside = None
        if rest is not None:
            beside = self.fresh(f"rest/{path}")
            rest.write.parquet(self.tables.location(beside))
        self.written[name] = Entry(free, "parquet", key, buckets, beside)

    def write_partitioned(self, name: str, df: DataFrame, path: str) -> DataFrame:
        """Write a table in a folder of its own, partitioned by year and month."""
        free = self.fresh(path)
        self.written[name] = Entry(free)
        return write_partitioned(df, self.tables.location(free))

    def scratch(self, df: DataFrame, name: str) -> DataFrame:
        """Rows written once, to be read several times until the commit ends."""
        if self._scratch is None:
            self._scratch = f"staged-{uuid.uuid4().hex}"
        where = self.tables.location(f"{self._scratch}/{name}")
        df.write.parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def _sweep(self) -> None:
        if self._scratch is not None:
            remove(self.spark, self.tables.location(self._scratch))

    def undo(self) -> None:
        """Remove what was written; the set stays as it was."""
        if not self._ended:
            self._ended = True
            for folder in self._folders:
                remove(self.spark, self.tables.location(folder))
            self._sweep()

    def _finish(self) -> None:
        if self._ended:
            return
        before = self.tables.entries()
        after = before | self.written
        _replace_text(self.spark, self.tables.location(MANIFEST),
                      json.dumps({n: asdict(e) for n, e in after.items()}, indent=1))
        self._ended = True
        self._sweep()
        for name in self.written.keys() & before.keys():
            for folder in (before[name].path, before[name].rest):
                if folder is not None:
                    remove(self.spark, self.tables.location(folder))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write to buckets of ``key``, sorted by it. Rows are brought together by bucket first, so
    that a bucket gets few files; a large bucket is written by several tasks."""
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = df.hint("rebalance", buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"drop table {name}")


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A bucketed folder as a table of the session, which knows of its buckets."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`) "
              f"sorted by (`{key}`) into {buckets} buckets location '{path}'")
    return spark.table(name)
