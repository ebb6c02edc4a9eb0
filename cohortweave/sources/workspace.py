"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the cluster in `spark.checkpoint.dir`.

    Where it is unset, a local session gets a temporary folder of its own; on a cluster the
    setting is required, because a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="cohortweave-")
    return _local_folders[application]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Files that one of Spark's readers is given at most: it describes each in the driver. More are listed and read by tasks.
FILES_PER_READ = 20_000

# Rows of a few numbers that are worth a task of their own: starting one and its file takes longer than fewer rows.
NARROW_ROWS_PER_TASK = 50_000


def stored(df: DataFrame, name: str, narrow_rows: int | None = None) -> DataFrame:
    """The table written to the shared folder and read back.

    For results that are used more than once: they are computed once, their size is known
    afterwards, and they survive the loss of executors. Where rows of a few numbers are known to be at
    most `narrow_rows`, the last step is done by as many tasks as they are worth, two per core at least.
    """
    if narrow_rows is not None:
        df = df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-narrow_rows // NARROW_ROWS_PER_TASK)))
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Tasks of a listing per core. Spark's own number is one per folder, up to 10,000, and starting one takes far longer than listing a folder.
LISTING_TASKS_PER_CORE = 4
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def listing(spark: SparkSession) -> AbstractContextManager[None]:
    """Files are listed, when a reader is given its paths, by a number of tasks that follows the cluster's cores, not the folders."""
    tasks = min(int(spark.conf.get(_LISTING_TASKS)), LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return _setting(spark, _LISTING_TASKS, str(tasks))


# Bytes that a file counts beside its own where tasks are cut. Spark's own 4 MB are a task per 32 small files, which takes longer to start.
SMALL_FILE_BYTES = 1 << 16
_OPEN_COST = "spark.sql.files.openCostInBytes"


def small_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Scans that run inside take up to some 2,000 small files in a task; there are still as many tasks as cores."""
    return _setting(spark, _OPEN_COST, str(SMALL_FILE_BYTES))
