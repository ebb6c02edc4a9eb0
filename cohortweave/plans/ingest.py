"""Raw files -> harmonized tier: one job per plugin and kind of file, over all files of the kind."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.constants import MODALITY, OMICS_MARKERS, PARTICIPANT, SESSION, SOURCE, UNKNOWN_MODALITY
from cohortweave.functions.names import c
from cohortweave.functions.paths import plain, relative_to
from cohortweave.operators.fhir import flatten_bundles
from cohortweave.operators.harmonize import registry_names
from cohortweave.operators.modalities import MARKERS, READERS, TAGGERS, harmonize_modality
from cohortweave.operators.status import mark_processed, of_subject, processable, subject_manifests
from cohortweave.sources import bronze, layouts, many_files
from cohortweave.sources.manifest import discover
from cohortweave.sources.tables import BATCH, silver_types, with_types, write_silver
from cohortweave.sources.tables import read_silver as read_plugin_silver
from cohortweave.sources.workspace import FILES_PER_READ, exists, small_files, stored

BAD_RECORDS = "_bad_records"
OUTCOMES = "_outcomes"
_BAD_DDL = "file string, record string, parsed string, plugin string"
_OUTCOME_DDL = "plugin string, relative_path string, outcome string, rows bigint, bad_records bigint, message string"


@dataclass
class IngestReport:
    """What an ingest found and did. `errors` maps a plugin to why its job failed.

    `silver` has the tables as written; `bad_records` (plugin, file, record) what no table holds;
    `outcomes` (plugin, relative_path, outcome, rows, bad_records, message) what became of every file.
    """

    manifest: DataFrame
    summary: DataFrame
    status: str
    silver: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    bad_records: DataFrame | None = None
    outcomes: DataFrame | None = None


@dataclass(frozen=True)
class Scan:
    """Files (path) of one plugin and suffix below one directory."""

    suffix: str
    directory: str
    files: DataFrame
    n_files: int
    files_per_read: int = FILES_PER_READ
    # Files of all scans together, which the driver would hold at the same time.
    n_all: int = 0

    def documents(self) -> DataFrame | None:
        """(path, content) of its files, stored, where all files are too many for Spark's readers and tasks can open them."""
        first = self.files.first() if max(self.n_files, self.n_all) > self.files_per_read else None
        if first is None or not layouts.is_reachable(first["path"]):
            return None
        return stored(many_files.contents(self.files, self.n_files), "documents")

    def sources(self, files: DataFrame) -> tuple[list[str], bool]:
        """What a reader is given to find the files, and whether it finds others too."""
        if self.n_files > self.files_per_read:
            return [self.directory], True
        return [r["path"] for r in files.select("path").collect()], False

    @property
    def options(self) -> dict[str, str]:
        return {"recursiveFileLookup": "true", "pathGlobFilter": f"*{self.suffix}"}


@dataclass(frozen=True)
class Part:
    """Raw rows of files that are tagged alike, and what could not be read of them."""

    rows: DataFrame | None
    # Whether the types of text columns are still to be found.
    open_text: bool = False
    bad: DataFrame | None = None


def plan_scans(manifest: DataFrame, plugin: str, files_per_read: int = FILES_PER_READ) -> list[Scan]:
    """The selected files of a plugin, per first-level directory and suffix. Their paths stay in the table."""
    return all_scans(manifest.filter(c("plugin") == plugin), files_per_read).get(plugin, [])


def all_scans(manifest: DataFrame, files_per_read: int = FILES_PER_READ) -> dict[str, list[Scan]]:
    """The scans of each plugin of a stored manifest."""
    folder = F.concat(F.left(c("path"), F.length("path") - F.length("relative_path")), c("modality_dir"))
    files = manifest.select("plugin", "extension", folder.alias("folder"), "path")
    key = ["plugin", "folder", "extension"]
    scans: dict[str, list[Scan]] = {}
    groups = files.filter(c("plugin").isNotNull()).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).orderBy(*key).collect()
    n_all = sum(g["n"] for g in groups)
    for g in groups:
        mine = files.filter((c("plugin") == g["plugin"]) & (c("extension") == g["extension"]) & (c("folder") == g["folder"]))
        scans.setdefault(g["plugin"], []).append(Scan(g["extension"], g["folder"], mine, g["n"], files_per_read, n_all))
    return scans


def _alike(known: DataFrame, plugin: str, registry: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """Files (path, names) that may be read as one table, and its columns.

    These have the same marker columns, keys and, where a format has types, the same types of the columns
    that differ somewhere. There are few such groups, whatever the number of layouts.
    """
    positions = known.select(F.posexplode("names").alias("place", "name"), F.col("kinds"))
    named = positions.select("name", F.get("kinds", c("place")).alias("kind"))
    columns = named.groupBy("name").agg(F.count_distinct("kind").alias("n_kinds")).collect()  # as many as columns
    mapping, _ = registry_names(registry, [r["name"] for r in columns])
    of_key = {key: [r["name"] for r in columns if mapping.get(r["name"], r["name"]) == key] for key in (PARTICIPANT, SESSION)}
    mixed = sorted(r["name"] for r in columns if r["n_kinds"] > 1)
    has = [F.arrays_overlap("names", F.array(*map(F.lit, names))) for names in of_key.values() if names]
    if plugin in MARKERS:
        has += [F.array_contains("names", m) for m in MARKERS[plugin]]
    else:
        has.append(F.to_json(F.array_sort("names")))
    has += [F.get("kinds", F.array_position("names", F.lit(n)).cast("int") - 1) for n in mixed]
    signature = F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("-")) for x in has], F.lit(""))
    signed = known.withColumn("_signature", signature)
    in_order = signed.select("_signature", F.posexplode("names").alias("place", "name")).groupBy("_signature", "name").agg(
        F.min("place").alias("place")
    )
    groups: dict[str, list[str]] = {}
    for r in in_order.orderBy("_signature", "place", "name").collect():  # one row per column of a group
        groups.setdefault(r["_signature"], []).append(r["name"])
    return [(signed.filter(c("_signature") == s).select("path", "names"), names) for s, names in groups.items()]


def _unreadable(known: DataFrame) -> DataFrame:
    """Files without columns, as bad records."""
    return known.filter("names IS NULL").select(
        c("path").alias("file"), c("error").alias("record"), F.lit(None).cast("string").alias("parsed")
    )


def _csv_parts(plugin: str, scan: Scan, registry: DataFrame) -> list[Part]:
    found = layouts.csv_layouts(scan.files, scan.n_files)
    known = found.filter("names IS NOT NULL").withColumn("kinds", F.array().cast("array<string>"))
    parts = []
    for files, columns in _alike(known, plugin, registry):
        paths, more = scan.sources(files)
        rows, bad = bronze.csv_files(files, columns, paths, options=scan.options if more else None)
        parts.append(Part(rows, True, bad))
    return [*parts, Part(None, bad=_unreadable(found))]


def _parquet_parts(spark: SparkSession, plugin: str, scan: Scan, registry: DataFrame) -> list[Part]:
    first = scan.files.first()
    if first is None or not layouts.is_reachable(first["path"]):
        paths, more = scan.sources(scan.files)
        raw = bronze.read_parquet(spark, paths, {"ignoreCorruptFiles": "true", **(scan.options if more else {})})
        return [Part(part) for part in _by_marker(bronze.only_files(raw, scan.files) if more else raw)]
    found = layouts.layouts(scan.files, layouts.parquet_columns, scan.n_files)
    split = found.withColumn("kinds", F.transform("names", lambda n: F.substring_index(n, "\0", -1))).withColumn(
        "names", F.transform("names", lambda n: F.substring_index(n, "\0", 1))
    )
    parts = []
    for files, _ in _alike(split.filter("names IS NOT NULL"), plugin, registry):
        paths, more = scan.sources(files)
        raw = bronze.read_parquet(spark, paths, scan.options if more else None)
        parts.append(Part(bronze.only_files(raw, files) if more else raw))
    return [*parts, Part(None, bad=_unreadable(split))]


def read_scan(spark: SparkSession, plugin: str, scan: Scan, as_of: Column, registry: DataFrame) -> list[Part]:
    """Raw rows of one scan; files that are tagged apart are parts of their own."""
    if plugin in READERS:
        # Its rows are used twice; the function of the plugin reads every file once.
        rows, bad = bronze.apart(stored(READERS[plugin](scan.files), "read"))
        return [Part(rows, bad=bad)]
    if scan.suffix == ".csv":
        return _csv_parts(plugin, scan, registry)
    if scan.suffix == ".parquet":
        return _parquet_parts(spark, plugin, scan, registry)
    raw = _raw_documents(spark, plugin, scan)
    rows, bad = bronze.apart(raw)
    if plugin == "ehr":
        named = rows.withColumn("_path", c(SOURCE).getField("file"))
        return [Part(flatten_bundles(named, registry, as_of, path="_path", keep=[SOURCE]).drop("_path"), bad=bad)]
    return [Part(rows, bad=bad)]


def _raw_documents(spark: SparkSession, plugin: str, scan: Scan) -> DataFrame:
    """JSON documents as they are, with those that could not be read."""
    extra = "_corrupt_record string"
    if (documents := scan.documents()) is not None:
        return bronze.parse_bundles(documents, extra=extra) if plugin == "ehr" else bronze.parse_documents(documents)
    paths, more = scan.sources(scan.files)
    options = scan.options if more else None
    raw = bronze.read_bundles(spark, paths, extra=extra, options=options) if plugin == "ehr" else bronze.read_json(spark, paths, options=options)
    return bronze.only_files(raw, scan.files) if more else raw


def _by_marker(raw: DataFrame) -> list[DataFrame]:
    """Rows apart by the first marker column that they fill, where a file's own columns cannot be seen.

    Each part loses the marker columns before its own, which its rows do not fill.
    """
    present = [marker for marker, _ in OMICS_MARKERS if marker in raw.columns]
    if len(present) < 2:
        return [raw]
    kind = F.coalesce(*[F.when(c(m).isNotNull(), F.lit(m)) for m in present], F.lit(present[0]))
    return [raw.filter(kind == m).drop(*present[:i]) for i, m in enumerate(present)]


def to_silver(df: DataFrame, plugin: str, registry: DataFrame) -> DataFrame:
    """Tag, harmonize and complete the keys of raw rows of one plugin."""
    harmonized = harmonize_modality(df, plugin, registry)
    if MODALITY not in harmonized.columns:
        harmonized = harmonized.withColumn(MODALITY, F.lit(UNKNOWN_MODALITY))
    return bronze.with_default_keys(harmonized, c(SOURCE).getField("file")).withColumn("_plugin", F.lit(plugin))


def _silver_parts(
    spark: SparkSession, plugin: str, scans: list[Scan], registry: DataFrame, as_of: date | Column | None
) -> tuple[list[tuple[DataFrame, bool]], DataFrame | None]:
    """Harmonized tables with whether their text is open, and the records that could not be read."""
    day = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    parts = [part for scan in scans for part in read_scan(spark, plugin, scan, day, registry)]
    tables = [(to_silver(part.rows, plugin, registry), part.open_text) for part in parts if part.rows is not None]
    bad = [part.bad for part in parts if part.bad is not None]
    return tables, reduce(DataFrame.unionByName, bad).withColumn("plugin", F.lit(plugin)) if bad else None


def harmonize_files(
    spark: SparkSession, plugin: str, scans: list[Scan], registry: DataFrame, as_of: date | Column | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """All files of one plugin as one harmonized table, and the records that could not be read."""
    tables, broken = _silver_parts(spark, plugin, scans, registry, as_of)
    return union_by_name([bronze.cast_columns(t, bronze.infer_types(t)) if open_text else t for t, open_text in tables]), broken


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    """Union with missing columns as null; integers and fractions become fractions, other types that differ text."""
    kinds: dict[str, set[str]] = {}
    for table in tables:
        for f in table.schema:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    shared = {name: "double" if found == {"bigint", "double"} else "string" for name, found in kinds.items() if len(found) > 1}
    result = None
    for table in tables:
        aligned = table.select(*[c(n).cast(shared[n]).alias(n) if n in shared else c(n) for n in table.columns])
        result = aligned if result is None else result.unionByName(aligned, allowMissingColumns=True)
    return result


def _put(df: DataFrame, target: str, batch: str, mode: str) -> None:
    """Rows of a batch, which replaces itself if it is written again."""
    writer = df.withColumn(BATCH, F.lit(batch)).write.partitionBy(BATCH)
    if mode == "append":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(target)


def _of_batches(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The rows of all batches; there may be none."""
    return spark.read.schema(f"{schema}, {BATCH} string").parquet(target)


def _outcomes(files: DataFrame, written: DataFrame | None, bad: DataFrame | None, errors: dict[str, str]) -> DataFrame:
    """What became of each file: processed, partly (some records are bad), failed, empty or skipped."""
    spark = files.sparkSession
    rows = spark.createDataFrame([], "_plugin string, _file string, rows bigint") if written is None else (
        written.groupBy("_plugin", plain(c(SOURCE).getField("file")).alias("_file")).agg(F.count(F.lit(1)).alias("rows"))
    )
    broken = spark.createDataFrame([], "_bad_plugin string, _bad_file string, bad_records bigint, first string") if bad is None else (
        bad.groupBy(c("plugin").alias("_bad_plugin"), plain(c("file")).alias("_bad_file"))
        .agg(F.count(F.lit(1)).alias("bad_records"), F.min(F.left("record", F.lit(200))).alias("first"))
    )
    listed = files.select("plugin", "relative_path", plain(c("path")).alias("_path"), "message")
    # A row per file on both sides: narrow columns of wide tables look small to the planner, which would gather them in the driver.
    joined = (
        listed.join(rows.hint("merge"), (c("_file") == c("_path")) & (c("_plugin") == c("plugin")), "left")
        .join(broken.hint("merge"), (c("_bad_file") == c("_path")) & (c("_bad_plugin") == c("plugin")), "left")
    )
    why = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in errors.items() for x in pair]), c("plugin")), F.lit("")) if errors else F.lit("")
    n, k = F.coalesce("rows", F.lit(0)), F.coalesce("bad_records", F.lit(0))
    outcome = (
        F.when(c("plugin").isNull(), "skipped").when((n > 0) & (k > 0), "partly").when(n > 0, "processed")
        .when((k > 0) | (why != ""), "failed").otherwise("empty")
    )
    message = F.when(c("plugin").isNull(), c("message")).when(k > 0, F.coalesce("first", F.lit(""))).when(n > 0, "").otherwise(why)
    return joined.select("plugin", "relative_path", outcome.alias("outcome"), n.alias("rows"), k.alias("bad_records"), message.alias("message"))


def ingest_manifest(
    spark: SparkSession, manifest: DataFrame, silver_root: str, registry: DataFrame, *, batch: str, mode: str = "append",
    as_of: date | Column | None = None,
) -> IngestReport:
    """Harmonize the files of a stored manifest as one batch, which replaces itself if it is repeated.

    A plugin whose job fails is reported and does not stop the others.
    """
    report = IngestReport(manifest, subject_manifests(manifest), "processed")
    found = []
    for plugin, scans in all_scans(manifest).items():
        target = f"{silver_root}/{plugin}"
        try:
            tables, broken = _silver_parts(spark, plugin, scans, registry, as_of)
            found += [] if broken is None else [broken]
            for i, (table, open_text) in enumerate(tables):
                texts = [f.name for f in table.schema if f.dataType.simpleString() == "string" and f.name not in (MODALITY, "_plugin")]
                write_silver(table, target, mode if i == 0 else "append", open_text=texts if open_text else (), batch=f"{batch}-{i}")
            if (written := _written(spark, target)) is not None:
                report.silver[plugin] = written
        except Exception as error:  # one plugin's bad files must not stop the others
            report.errors[plugin] = str(error).splitlines()[0]
    if found:
        target = f"{silver_root}/{BAD_RECORDS}"
        _put(reduce(DataFrame.unionByName, found), target, batch, mode)
        report.bad_records = _of_batches(spark, target, _BAD_DDL).drop(BATCH)
    present = [read.select("_plugin", SOURCE) for read in report.silver.values()]
    bad = None if report.bad_records is None else _of_batches(spark, f"{silver_root}/{BAD_RECORDS}", _BAD_DDL).filter(c(BATCH) == batch)
    written = reduce(DataFrame.unionByName, present) if present else None
    _put(_outcomes(manifest, written, bad, report.errors), f"{silver_root}/{OUTCOMES}", batch, mode)
    report.outcomes = _of_batches(spark, f"{silver_root}/{OUTCOMES}", _OUTCOME_DDL).filter(c(BATCH) == batch).drop(BATCH)
    return report


def ingest(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    registry: DataFrame,
    *,
    subject: str | None = None,
    dry_run: bool = False,
    as_of: date | Column | None = None,
) -> IngestReport:
    """Discover raw files and write their harmonized rows.

    For all subjects, each plugin's table is replaced. For one subject, its files that have no
    harmonized rows yet are added. A dry run only returns the manifest. A plugin whose job fails
    is reported and does not stop the others; every file's outcome is reported.
    """
    with small_files(spark):
        manifest = stored(of_subject(discover(spark, bronze_root, subject), subject), "manifest")
    summary = subject_manifests(manifest)
    if dry_run:
        return IngestReport(manifest, summary, "dry_run")
    todo = manifest
    if subject is not None:
        done = read_silver(spark, silver_root)
        if done is not None:
            todo = stored(mark_processed(manifest, silver_files(done, bronze_root)).filter(~c("processed")).drop("processed"), "todo")
    if processable(todo).isEmpty():
        return IngestReport(manifest, summary, "no_processable_clinical_files")
    report = ingest_manifest(
        spark, todo, silver_root, registry, batch="all" if subject is None else uuid.uuid4().hex,
        mode="overwrite" if subject is None else "append", as_of=as_of,
    )
    report.manifest, report.summary = manifest, summary
    return report


def _written(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame | None:
    """A plugin's harmonized rows, None if there are none."""
    if not exists(spark, path):
        return None
    try:
        return read_plugin_silver(spark, path, types=types)
    except AnalysisException as error:  # all batches were empty
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return None


def read_silver(spark: SparkSession, silver_root: str, plugins: Iterable[str] | None = None) -> DataFrame | None:
    """Harmonized rows of all plugins in one table; None if nothing has been written.

    A column's type holds the values of all plugins and batches.
    """
    raw = {path: table for plugin in plugins or TAGGERS if (table := _written(spark, path := f"{silver_root}/{plugin}", {})) is not None}
    if not raw:
        return None
    types = silver_types(spark, list(raw))
    return union_by_name([with_types(table, types) for table in raw.values()])


def silver_files(silver: DataFrame, bronze_root: str) -> DataFrame:
    """(plugin, relative_path) of the files that have harmonized rows."""
    return silver.select(
        c("_plugin").alias("plugin"), relative_to(c(SOURCE).getField("file"), bronze_root).alias("relative_path")
    ).distinct()
