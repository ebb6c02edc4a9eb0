"""Files of a format of one's own, read by a function per file.

The function gets an open file and yields rows; the files are a table, of which each task reads its share,
so any number of them is read by as many tasks as there are shares.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortweave.constants import SOURCE
from cohortweave.functions.shipping import by_value
from cohortweave.sources.layouts import opened

# Files of one task, and rows that are handed on together.
FILES_PER_TASK = 200
ROWS_PER_BATCH = 10_000

ReadFile = Callable[[BinaryIO], Iterable[tuple]]
CORRUPT = "_corrupt_record"


def _rows_of(read_file: ReadFile, columns: pa.Schema):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(columns) - 4

        def packed(taken: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*taken), columns)], schema=columns)

        taken = []  # small files share a batch
        for batch in batches:
            for path in batch.column("path").to_pylist():
                n = 0
                try:
                    with opened(path) as file:
                        for n, row in enumerate(read_file(file), 1):
                            taken.append((*row, None, path, 0, n - 1))
                            if len(taken) == ROWS_PER_BATCH:
                                yield packed(taken)
                                taken = []
                except (OSError, ValueError, KeyError, EOFError) as error:  # what the file holds up to here stays
                    taken.append((*[None] * width, f"{type(error).__name__}: {error}", path, 0, n))
                    if len(taken) == ROWS_PER_BATCH:
                        yield packed(taken)
                        taken = []
        if taken:
            yield packed(taken)

    return rows


def reader(schema: str | T.StructType, read_file: ReadFile, *, files_per_task: int = FILES_PER_TASK) -> Callable[[DataFrame], DataFrame]:
    """A reader for `operators.modalities.register`: rows of `schema` by `read_file`, in the order of each file.

    A file that raises gives the rows before the error, and one in `_corrupt_record` that says why.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    listed = T.StructType([*given.fields, T.StructField(CORRUPT, T.StringType()), T.StructField("_file", T.StringType()),
                           T.StructField("_block", T.LongType()), T.StructField("_row", T.LongType())])

    def read(files: DataFrame) -> DataFrame:
        tasks = max(1, -(-files.count() // files_per_task))
        rows = files.select("path").repartition(tasks).mapInArrow(_rows_of(read_file, to_arrow_schema(listed)), listed)
        source = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
        return rows.select(*[F.col(f"`{n}`") for n in (*given.names, CORRUPT)], source.alias(SOURCE))

    return read


by_value(__name__)
