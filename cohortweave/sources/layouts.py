"""What a file says about its columns, from its first record or its footer; the rest is not read.

Files are a table, so there may be any number of them: each task opens its share. Stores that only
Spark reaches are read by Spark instead, with the same result.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.names import c
from cohortweave.functions.paths import plain
from cohortweave.functions.shipping import by_value
from cohortweave.sources.workspace import listing, stored

# Bytes that are read at once while a first record is not complete.
CHUNK = 1 << 16
# Files that one task opens.
FILES_PER_TASK = 1_000

LAYOUT_DDL = "path string, names array<string>, error string"


def opened(path: str):
    """A file of any store that can be reached from here, ready to read."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def created(path: str):
    """A new file of any store that can be reached from here, with the folders above it, ready to write."""
    if path.startswith(("file:", "/")):
        store, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rpartition("/")[0])
    return store.open_output_stream(name)


def is_reachable(path: str) -> bool:
    """Whether files of this store can be opened without Spark."""
    if path.startswith(("file:", "/")):
        return True
    try:
        fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, ValueError, NotImplementedError):
        return False
    return True


def column_names(record: str) -> list[str]:
    """Fields of a header; nameless ones are numbered, and those of one name get their position behind it."""
    fields = next(csv.reader(io.StringIO(record, newline="")), [])
    named = [f or f"_c{i}" for i, f in enumerate(fields)]
    lowered = [f.lower() for f in named]
    return [f"{f}{i}" if lowered.count(f.lower()) > 1 else f for i, f in enumerate(named)]


def _record_end(text: str) -> int:
    """Where the first record ends: the first line break outside of quotes, or -1."""
    quoted = False
    for at, char in enumerate(text):
        if char == '"':
            quoted = not quoted
        elif char in "\r\n" and not quoted:
            return at
    return -1


def first_record(path: str) -> str:
    """The first record of a text file that is not blank; reads no more chunks than it spans."""
    data = b""
    with opened(path) as file:
        while True:
            chunk = file.read(CHUNK)
            data += chunk
            text = data.decode("utf-8", errors="ignore").lstrip("﻿").lstrip("\r\n")
            end = _record_end(text)
            if end >= 0 or not chunk:
                return text[:end] if end >= 0 else text


def csv_names(path: str) -> list[str]:
    names = column_names(first_record(path))
    if not names:
        raise ValueError("no header")
    return names


def parquet_columns(path: str) -> list[str]:
    """Names of the columns, each with its type behind a zero character."""
    with opened(path) as file:
        return [f"{f.name}\0{f.type}" for f in pq.ParquetFile(file).schema_arrow]


def _lister(names_of: Callable[[str], list[str]]):
    def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, errors = [], []
            for path in batch.column("path").to_pylist():
                try:
                    names.append(names_of(path))
                    errors.append(None)
                except (OSError, ValueError, pa.ArrowException, csv.Error) as error:  # reported with the file
                    names.append(None)
                    errors.append(str(error).splitlines()[0] if str(error) else type(error).__name__)
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(names, pa.list_(pa.string())), pa.array(errors, pa.string())], names=["path", "names", "error"]
            )

    return layouts


def layouts(files: DataFrame, names_of: Callable[[str], list[str]], n_files: int | None = None) -> DataFrame:
    """(path, names, error) of files (path), stored: the columns that each file has, or why they are unknown."""
    tasks = -(-(files.count() if n_files is None else n_files) // FILES_PER_TASK)
    spread = files.select("path").repartition(max(1, tasks))
    return stored(spread.mapInArrow(_lister(names_of), LAYOUT_DDL), "layouts")


def csv_layouts(files: DataFrame, n_files: int | None = None) -> DataFrame:
    """(path, names, error) of CSV files, from their first record."""
    first = files.select("path").first()
    if first is None or is_reachable(first["path"]):
        return layouts(files, csv_names, n_files)
    with listing(files.sparkSession):
        lines = files.sparkSession.read.text([r["path"] for r in files.select("path").toLocalIterator()])
    place = F.struct(c("_metadata").getField("file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    header = (
        lines.filter(F.length("value") > 0).groupBy(c("_metadata").getField("file_path").alias("path"))
        .agg(F.min_by("value", place).alias("header"))
    )

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [column_names(h.lstrip("﻿")) for h in batch.column("header").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(names, pa.list_(pa.string())), pa.nulls(batch.num_rows, pa.string())], names=["path", "names", "error"]
            )

    found = stored(header.mapInArrow(parsed, LAYOUT_DDL), "layouts")
    known = found.select(plain(c("path")).alias("_key"), "names")
    return files.select("path").join(known, plain(c("path")) == c("_key"), "left").select(
        "path", "names", F.when(c("names").isNull(), F.lit("no header")).alias("error")
    )


by_value(__name__)
