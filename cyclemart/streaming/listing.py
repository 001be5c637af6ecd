"""ST-1: landed files as a stream that also gives files rewritten at a known path.

Spark's file source remembers paths, so a file that is replaced is not seen again.  This source
remembers a time instead: its offset is the instant up to which files have been given, and a
batch is every file last modified after the one offset and up to the next.  A rewritten file
has a new modification time and comes again; a file never comes twice for one writing, over
restarts too, as a repeated batch has the same bounds.

The folders (type and cycle) are dealt to tasks, which list them; the driver lists only the
folders.  Files count once they are older than ``settle`` seconds, which must cover the time
that the store takes to show a file with its final modification time (and uploads whose time
is that of their begin).  What comes later still is found by the batch reconcile.

Listing uses Arrow's file systems (local, HDFS and the object stores that it supports).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "landed_files"
TASKS = 64  # folders are dealt to at most so many tasks


def _file_system(root: str):
    """(Arrow file system, path of ``root`` in it)."""
    import pyarrow.fs

    if root.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + root[len("file:"):].lstrip("/")
    if "://" not in root:
        return pyarrow.fs.LocalFileSystem(), root
    return pyarrow.fs.FileSystem.from_uri(root)


class _Folders(InputPartition):
    def __init__(self, folders: list[tuple[str, bool]], after: int, until: int) -> None:
        self.folders, self.after, self.until = folders, after, until


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.suffix = options.get("suffix", "")
        self.settle = float(options.get("settle", "10"))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"until_ns": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"until_ns": time.time_ns() - int(self.settle * 1e9)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """The folders below ``raw/{type}``, dealt out; files that lie above them are listed
        where they lie."""
        from pyarrow.fs import FileSelector, FileType

        store, root = _file_system(self.root)
        top = f"{root}/raw"
        folders = [(top, False)]
        for info in store.get_file_info(FileSelector(top, allow_not_found=True)):
            if info.type == FileType.Directory:
                folders.append((info.path, False))
                folders += [(x.path, True) for x in store.get_file_info(FileSelector(info.path)) if x.type == FileType.Directory]
        return [_Folders(folders[i::TASKS], start["until_ns"], end["until_ns"]) for i in range(min(TASKS, len(folders)))]

    def read(self, partition: _Folders) -> Iterator[tuple]:
        from pyarrow.fs import FileSelector, FileType

        store, root = _file_system(self.root)
        for folder, recursive in partition.folders:
            for info in store.get_file_info(FileSelector(folder, allow_not_found=True, recursive=recursive)):
                name = info.base_name
                if info.type != FileType.File or name[:1] in "._" or not name.endswith(self.suffix):
                    continue
                if partition.after < info.mtime_ns <= partition.until:
                    key = info.path[len(root) + 1:]
                    at = dt.datetime.fromtimestamp(info.mtime_ns // 1000 / 1e6, dt.timezone.utc)
                    yield f"{self.root}/{key}", key, info.size, at

    def commit(self, end: dict) -> None:
        pass


class LandedFiles(DataSource):
    """``spark.readStream.format("landed_files").load(landing_root)``; options ``suffix`` and
    ``settle``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "path string, object_key string, length long, modificationTime timestamp"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _Reader(dict(self.options))


def landed_file_stream(spark: SparkSession, landing_root: str, suffix: str = ".pgp", settle: float = 10.0) -> DataFrame:
    """ST-1 source: ``path, object_key, length, modificationTime`` of landed files, again when
    they are rewritten."""
    spark.dataSource.register(LandedFiles)
    return spark.readStream.format(NAME).option("suffix", suffix).option("settle", str(settle)).load(landing_root)
