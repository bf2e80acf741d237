"""Landing flow: new files of the temporal folder into the persistent zone, each exactly once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import documents as docs
from strandline.operators import landing
from strandline.session import at_once
from strandline.sources.batches import BatchLog
from strandline.sources.readers import first_line, read_csv_strings, with_contents
from strandline.sources.writers import write_files, write_metadata_files

# Files per batch; bounds every list of names held on the driver.
MAX_FILES = 1_000

TABLES = {
    "semi_structured": "semi_structured/delta",
    "text": "unstructured/text/delta",
    "audio": "unstructured/audio/delta",
    "camera_report": "unstructured/images/delta",
    "structured_csv": "structured/delta",
}
SUMMARIES = "landing_summary"
SUMMARY = "kind string, seen bigint, processed bigint, failed bigint"
ROUTED = "path string, object_name string, kind string, destination string, metadata_destination string"
OUTCOME = "path string, object_name string, kind string, error string"
#: Tasks that list the files of a batch; as many as paths, up to 10,000, unless set.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_METADATA = {
    "semi_structured": landing.weather_file_metadata,
    "text": landing.text_file_metadata,
    "audio": landing.wav_file_metadata,
}


def _append(df: DataFrame, path: str, batch_id: int, *partition_by: str) -> None:
    """One folder per batch: a retried batch replaces its own rows instead of adding them again."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def _csv_layouts(paths: DataFrame) -> list[list[str]]:
    """CSV paths of one batch (at most ``max_files``), grouped by their header line."""

    def headers(batches):
        for batch in batches:
            yield batch.assign(header=[first_line(p) for p in batch["path"]])

    groups: dict[str, list[str]] = {}
    for row in paths.mapInPandas(headers, "path string, header string").collect():
        if row["header"]:
            groups.setdefault(row["header"], []).append(row["path"])
    return list(groups.values())


def _rows(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """Rows of strings, handed over as one Arrow table."""
    columns = [field.split()[0] for field in schema.split(",")]
    return spark.createDataFrame(pa.table({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(columns)}), schema)


def _literal(path: str) -> str:
    """A file name as a path pattern that matches only itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _routed(files: DataFrame, source: str) -> DataFrame:
    """Route ``path`` rows; object names are relative to the scanned folder."""
    base = source.rstrip("/").split("://")[-1].split(":", 1)[-1].rstrip("/") + "/"
    name = F.concat(F.lit(landing.TEMPORAL_PREFIX), F.substring_index(F.col("path"), base, -1))
    return landing.route_objects(files.withColumn("object_name", name))


def batch_log(spark: SparkSession, root: str) -> BatchLog:
    """The batches of a landing zone and the tables they write to."""
    tables = [f"{landing.PERSISTENT_PREFIX.rstrip('/')}/{t}" for t in TABLES.values()]
    return BatchLog(spark, root, [*tables, SUMMARIES])


def read_landed(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """Rows of one kind from committed batches only; None before the first."""
    return batch_log(spark, root).read(f"{landing.PERSISTENT_PREFIX.rstrip('/')}/{TABLES[kind]}")


def _land_documents(
    load: Callable, paths: dict[str, str], kind: str, batch_id: int, staged: str, zone: str, held: list[DataFrame]
) -> tuple[dict[str, str | None], list[Callable]]:
    """The error or None of each object name of one kind, and the jobs that write metadata rows, metadata files and copies. ``paths`` has object names by path."""
    rows = _METADATA[kind](load(paths))
    if "error" not in rows.columns:
        rows = rows.withColumn("error", F.lit(None).cast("string"))
    held.append(rows := rows.persist())
    # One name per file of this batch: the stream's file limit bounds it.
    errors = {r["object_name"]: r["error"] for r in rows.select("object_name", "error").collect()}
    landed = [path for path, name in paths.items() if errors[name] is None]
    if not landed:
        return errors, []
    good = rows.filter("error is null").drop("error")
    about = good.withColumn("metadata_destination", F.col("file_metadata.persistent_metadata_path")).drop("object_name")
    return errors, [
        lambda: _append(landing.flatten(good), f"{zone}/{TABLES[kind]}", batch_id),
        lambda: write_metadata_files(about, staged, "metadata_destination"),
        lambda: write_files(load(landed).select("destination", "content"), staged, "destination", "content"),
    ]


def land_batch(
    batch: DataFrame, batch_id: int, root: str, source: str, archive: str | None = None, later: Callable[[Callable], None] | None = None
) -> DataFrame:
    """Process one batch of files, given by ``path``; returns the per-kind summary.

    The names of a batch (at most ``max_files``) are listed on the driver, so each
    branch reads the contents of its own files only. Rows go to the batch's own folders and copies to its staged files;
    the batch counts once it is committed, and a failure before takes all of it back and leaves the sources where they
    are. After the commit copies get their names and, with ``archive``, landed sources move there; ``later`` is given that step if
    the caller wants to run it beside the next batch.
    """
    spark = batch.sparkSession
    log = batch_log(spark, root)
    summary = f"{root.rstrip('/')}/{SUMMARIES}/batch_id={batch_id}"
    if not log.committed(batch_id):
        log.begin(batch_id)
        held: list[DataFrame] = []
        try:
            outcome, jobs = _land_files(batch, batch_id, root, source, log.staged(batch_id), held)
            at_once(
                spark,
                *jobs,
                lambda: outcome.write.parquet(f"{log.folder(batch_id)}/files"),
                lambda: landing.landing_summary(outcome).write.parquet(summary),
            )
        except BaseException:
            log.roll_back(batch_id)
            raise
        finally:
            for rows in held:
                rows.unpersist()
        log.commit(batch_id)
    (later or (lambda step: step()))(lambda: log.finish(batch_id, source, archive))
    return spark.read.schema(SUMMARY).parquet(summary)


def _land_files(batch: DataFrame, batch_id: int, root: str, source: str, staged: str, held: list[DataFrame]) -> tuple[DataFrame, list[Callable]]:
    """Write rows and staged copies of a batch; returns ``OUTCOME`` rows and the jobs that are left to run. ``held`` gets what is persisted."""
    spark = batch.sparkSession
    zone = f"{root.rstrip('/')}/{landing.PERSISTENT_PREFIX.rstrip('/')}"
    routed = _routed(batch.select("path").coalesce(spark.sparkContext.defaultParallelism), source)
    seen = [tuple(r) for r in routed.select(*(field.split()[0] for field in ROUTED.split(","))).collect()]
    known = {row[0]: row for row in seen}
    paths: dict[str, dict[str, str]] = {}
    for path, name, kind, *_ in seen:
        paths.setdefault(kind, {})[path] = name

    def load(chosen) -> DataFrame:
        return with_contents(_rows(spark, ROUTED, [known[p] for p in chosen]))

    errors: dict[str, str | None] = {}
    jobs: list[Callable] = []
    for kind in _METADATA:
        if kind in paths:
            found, writing = _land_documents(load, paths[kind], kind, batch_id, staged, zone, held)
            errors |= found
            jobs += writing
    if "camera_report" in paths:
        reports = load(paths["camera_report"])
        texts = reports.select(F.col("object_name").alias("source_file"), F.col("content").cast("string").alias("content"))
        parsed = docs.parse_documents(texts, docs.REPORT_SCHEMA).persist()
        held.append(parsed)
        found = {r["source_file"]: r["error"] for r in parsed.select("source_file", "error").collect()}
        errors |= found
        if None in found.values():
            jobs.append(lambda: _append(docs.report_table(parsed.filter("error is null")), f"{zone}/{TABLES['camera_report']}", batch_id, "camera_id"))
        # A report that cannot become a table row is still moved; broken documents are not.
        jobs.append(lambda: write_files(reports.select("destination", "content"), staged, "destination", "content"))
    if "structured_csv" in paths:
        at_once(spark, *jobs)
        jobs = []
        names = paths["structured_csv"]
        listed = spark.createDataFrame([(p,) for p in names], "path string")
        frames = []
        for layout in _csv_layouts(listed):
            try:
                frames.append(read_csv_strings(spark, [_literal(p) for p in layout]))
            except ValueError as exc:  # column names that collide: this layout is left out, with its reason
                errors |= {names[p]: str(exc) for p in layout}
        if frames:
            _append(landing.evolve_append(*frames), f"{zone}/{TABLES['structured_csv']}", batch_id)
    outcome = [(path, name, kind, "unknown type" if kind == "skipped" else errors.get(name)) for path, name, kind, *_ in seen]
    return _rows(spark, OUTCOME, outcome).coalesce(1), jobs


@contextmanager
def shared_listing(spark: SparkSession) -> Iterator[None]:
    """A few tasks a core share the paths of a batch; a task for each single file takes most of a batch's time."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def land_available(
    spark: SparkSession, source: str, root: str, checkpoint: str, max_files: int = MAX_FILES, archive: str | None = None
) -> DataFrame:
    """Land every file not seen before under ``checkpoint``; returns the summary of this run.

    The stream's checkpoint records which files are done, so nothing is listed
    against the persistent zone and nothing lands twice. With ``archive`` landed files leave the source folder for
    ``<archive>/batch_id=<n>``; files that failed or have no known type stay. Batches that an earlier run left
    unfinished are finished or taken back first.
    """
    batch_log(spark, root).recover(source, archive)
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(source)
    )
    done: list[int] = []
    moving: list[Future] = []

    with ThreadPoolExecutor(1) as pool, shared_listing(spark):

        def later(step: Callable[[], None]) -> None:
            # files of one batch move beside the next one's landing; a failure ends the run there, and no more than one batch is behind
            while moving:
                moving.pop().result()
            moving.append(pool.submit(inheritable_thread_target(spark)(step)))

        def run(batch: DataFrame, batch_id: int) -> None:
            land_batch(batch, batch_id, root, source, archive, later)
            done.append(batch_id)

        query = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run).trigger(availableNow=True).start()
        query.awaitTermination()
        while moving:
            moving.pop().result()
    if not done:
        return spark.createDataFrame([], SUMMARY)
    paths = [f"{root.rstrip('/')}/{SUMMARIES}/batch_id={n}" for n in done]
    totals = {c: F.sum(c).alias(c) for c in ("seen", "processed", "failed")}
    return spark.read.schema(SUMMARY).parquet(*paths).groupBy("kind").agg(*totals.values())
