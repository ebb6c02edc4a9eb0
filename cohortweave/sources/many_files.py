"""Any number of files, listed and read by tasks.

Spark's readers keep a description of every file in the driver, some 2 KB each, and several times over an ingest. Here
files are rows of a table from the listing on. Names that Spark's listings leave out are left out, too.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions.names import c
from cohortweave.functions.shipping import by_value
from cohortweave.sources.layouts import FILES_PER_TASK, is_reachable, opened
from cohortweave.sources.workspace import FILES_PER_READ, stored

# Folders that one task lists, files that are handed on together, and bytes of their contents.
FOLDERS_PER_TASK = 1_000
FILES_PER_BATCH = 10_000
BYTES_PER_BATCH = 4 << 20

_BOM = b"\xef\xbb\xbf"
_ENTRY_DDL = "path string, length bigint, is_folder boolean"


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store, as listings spell it."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()


def _is_listed(name: str, is_folder: bool) -> bool:
    """Whether Spark's listings show a file or folder of this name."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")
    return not hidden or (is_folder and name.startswith(("_common_metadata", "_metadata")))


def entries(folder: str) -> Iterator[tuple[str, int, bool]]:
    """(path, length, whether it is a folder) of what is directly in a folder."""
    if folder.startswith("file:"):
        with os.scandir("/" + folder.removeprefix("file:").lstrip("/")) as found:
            for entry in found:
                try:
                    size, is_folder = entry.stat().st_size, entry.is_dir()
                except FileNotFoundError:  # gone since it was listed, or a link to nothing
                    continue
                if _is_listed(entry.name, is_folder):
                    yield f"file:{entry.path}", size, is_folder
        return
    store, name = fs.FileSystem.from_uri(folder)
    for info in store.get_file_info(fs.FileSelector(name)):
        is_folder = info.type == fs.FileType.Directory
        if (is_folder or info.type == fs.FileType.File) and _is_listed(info.base_name, is_folder):
            yield f"{folder.rstrip('/')}/{info.base_name}", info.size or 0, is_folder


def has_many(root: str, most: int = FILES_PER_READ) -> bool:
    """Whether there are more than `most` files and folders below a qualified folder that tasks can list; looks at no more of them."""
    if not is_reachable(root):
        return False
    folders, seen = [root], 0
    try:
        while folders:
            for path, _, is_folder in entries(folders.pop()):
                seen += 1
                if seen > most:
                    return True
                if is_folder:
                    folders.append(path)
    except OSError:  # no folder, or one that may not be read: the reader says so
        return False
    return False


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = (entry for folder in batch.column("path").to_pylist() for entry in entries(folder))
        while some := list(islice(found, FILES_PER_BATCH)):
            columns = [pa.array(x, t) for x, t in zip(zip(*some), (pa.string(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "is_folder"])


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all files below a qualified folder that are not empty, stored. Tasks list the folders of a level."""
    folders, levels = spark.createDataFrame([(root,)], "path string"), []
    n = 1
    while n:
        tasks = -(-n // FOLDERS_PER_TASK)
        levels.append(stored(folders.select("path").repartition(tasks).mapInArrow(_list, _ENTRY_DDL), "listing"))
        folders = levels[-1].filter("is_folder")
        n = folders.count()
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.filter(~c("is_folder") & (c("length") > 0)).select("path", "length")


def _reader(by_line: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(taken, pa.binary())], names=["path", "content"])

        paths: list[str] = []
        taken: list[bytes] = []
        size = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path) as file:
                    data = file.read().removeprefix(_BOM)
                for part in data.splitlines() if by_line else [data]:
                    paths.append(path)
                    taken.append(part)
                    size += len(part)
                    if size > BYTES_PER_BATCH or len(taken) == FILES_PER_BATCH:
                        yield packed()
                        paths, taken, size = [], [], 0
        if taken:
            yield packed()

    return read


def contents(files: DataFrame, n_files: int | None = None, *, by_line: bool = False) -> DataFrame:
    """(path, content) of files (path), a row per file or per line of it, without the mark of its encoding. Tasks read their share."""
    tasks = -(-(files.count() if n_files is None else n_files) // FILES_PER_TASK)
    rows = files.select("path").repartition(max(1, tasks)).mapInArrow(_reader(by_line), "path string, content binary")
    return rows.select("path", F.col("content").cast("string").alias("content"))


by_value(__name__)
