"""Listing of file trees by executors: a data source whose partitions are directories.

Spark's own file index keeps every file's status in the driver. Here the driver sees directories down to a level, never files;
each task walks its directory and streams (path, name, dir, mtime, size) rows, one directory's entries at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows of a batch that a task hands on.
ROWS = 8192


class Directory(InputPartition):
    """A directory to list: with all below it, or its own files alone."""

    def __init__(self, path: str, deep: bool):
        super().__init__(path)
        self.path, self.deep = path, deep


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri if uri.startswith("/") else uri.replace("file:/", "file:///", 1))


def _entries(store: fs.FileSystem, path: str) -> tuple[list[fs.FileInfo], list[str]]:
    """(files, directories) of one directory, by name."""
    found = sorted(store.get_file_info(fs.FileSelector(path)), key=lambda i: i.path)
    return [i for i in found if i.type == fs.FileType.File], [i.path for i in found if i.type == fs.FileType.Directory]


class _Reader(DataSourceReader):
    def __init__(self, root: str, levels: int, since: float | None):
        self.root, self.levels, self.since = root, levels, since

    def partitions(self) -> list[Directory]:
        store, top = _open(self.root)
        parts, level = [], [top]
        for _ in range(self.levels):
            parts += [Directory(d, False) for d in level]
            level = [sub for d in level for sub in _entries(store, d)[1]]
        return parts + [Directory(d, True) for d in level]

    def read(self, partition: Directory) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.root)
        waiting, held = [partition.path], []
        while waiting:
            files, below = _entries(store, waiting.pop())
            if partition.deep:
                waiting += below
            for i in files:
                mtime = i.mtime.timestamp() if i.mtime else 0.0
                if self.since is None or mtime > self.since:
                    held.append((i.path, i.base_name, i.path.rsplit("/", 2)[-2] if i.path.count("/") > 1 else "", mtime, i.size))
                if len(held) >= ROWS:
                    yield self._batch(held)
                    held = []
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "name", "parent", "mtime", "size"])


class FileListing(DataSource):
    """Options: path; levels (directories so deep are partitions of their own, 1 by default); since (only newer files, seconds)."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, name string, parent string, mtime double, size bigint"

    def reader(self, schema) -> _Reader:
        since = self.options.get("since")
        return _Reader(self.options["path"], int(self.options.get("levels", 1)), float(since) if since is not None else None)


def list_files(spark: SparkSession, root: str, prefix: str = "", suffix: str = "", since: float | None = None, levels: int = 1) -> DataFrame:
    """(name, dir, mtime) of the files under root, as scans.list_assets gives them, listed by executors; since: only files that are
    strictly newer. root: a path or URI of a store that pyarrow opens. Folders and files whose names begin with _ or . count too."""
    spark.dataSource.register(FileListing)
    reader = spark.read.format("file_listing").option("path", root).option("levels", levels)
    files = (reader if since is None else reader.option("since", repr(since))).load()
    where = F.when(F.col("parent") == "uploaded", "uploaded").otherwise("base")
    return files.filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix)).select("name", where.alias("dir"), "mtime")


def list_new(spark: SparkSession, root: str, mark: float | None, prefix: str = "", suffix: str = "", levels: int = 1) -> tuple[DataFrame, float | None]:
    """(files newer than the mark, the mark to keep once they are taken in): the newest time among them, or the old mark."""
    files = list_files(spark, root, prefix, suffix, mark, levels)
    newest = files.agg(F.max("mtime")).first()[0]
    if newest is None:
        return files, mark
    return files.filter(F.col("mtime") <= newest), newest
