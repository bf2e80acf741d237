"""Distributed scans: CSV, JSON documents, JSON lines, binary files, tables, streams."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import normalize_columns
from strandline.functions.text import strip
from strandline.operators.documents import REPORT_SCHEMA, WEATHER_SCHEMA, parse_documents
from strandline.operators.landing import base_name, evolve_append, number_lines
from strandline.session import materialize
from strandline.sources.commits import filesystem

# Cell texts that a CSV scan reads as missing.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
ARTICLE_SCHEMA = "headline string, category string, authors string, date string, short_description string, link string"
TOPIC = "traffic-images"


def read_csv_strings(
    spark: SparkSession,
    *paths: str | list[str],
    limit: int | None = None,
    multiline: bool = True,
    missing: Sequence[str] = CSV_MISSING,
) -> DataFrame:
    """CSV with header as all-string columns with normalised names and ``source_file``.

    Every path (or list of paths) is one layout: its files must share a header (a
    deviating file fails loudly); layouts are united by column name. Line breaks
    inside quotes belong to their cell; ``multiline=False`` makes large files
    splittable where the source is known to have none.
    """
    frames = []
    for path in paths:
        raw = spark.read.csv(
            path, header=True, inferSchema=False, enforceSchema=False, multiLine=multiline, escape='"', recursiveFileLookup=True
        )
        named = normalize_columns(raw).columns
        cells = [F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(n) for c, n in zip(raw.columns, named)]
        frames.append(raw.select(*cells, F.col("_metadata.file_path").alias("source_file")))
    out = evolve_append(*frames)
    return out if limit is None else out.limit(limit)


def first_line(path: str) -> str:
    """First line of a file, read inside a task from any supported file system."""
    from pyarrow import fs

    from strandline.sources.writers import arrow_uri

    store, name = fs.FileSystem.from_uri(arrow_uri(path))
    with store.open_input_stream(name) as source:
        head = b""
        while b"\n" not in head and (chunk := source.read(65_536)):
            head += chunk
    return head.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r")


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Lake table whose files may have gained columns over time."""
    reader = spark.read.option("mergeSchema", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_split(spark: SparkSession, path: str, name: str = "accepted") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows of a table stored by ``write_split``; each reads its own partition only."""
    stored = spark.read.parquet(path)
    flag = F.col(name).cast("boolean")
    return stored.filter(flag).drop(name), stored.filter(~flag).drop(name)


#: Scan partitions of small files that one task reads at most, one after the other; each holds 32 files by Spark's usual cost of opening one.
TOGETHER = 64
#: Spark's usual size of a scan partition and cost of opening a file, in bytes.
PARTITION, OPENING = 128 << 20, 4 << 20
#: Files and bytes that a task hands on at a time.
LOT, LOT_BYTES = 100, 8 << 20
LISTED = "path string, length bigint"


def _local(path: str) -> str | None:
    """The name of a local file in its own file system; None for other stores."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else None


def _store(path: str, known: dict):
    """Arrow's file system of a path of another store, and the path's name in it."""
    from pyarrow import fs

    from strandline.sources.writers import arrow_uri

    scheme, rest = path.split("://", 1)
    authority, _, name = rest.partition("/")
    place = f"{scheme}://{authority}/"
    if place not in known:
        known[place] = fs.FileSystem.from_uri(arrow_uri(place))
    store, base = known[place]
    return store, f"{base.rstrip('/')}/{name}"


def _entries(folder: str, known: dict) -> Iterator[tuple[str, str, bool, int]]:
    """``(path, name, is_folder, length)`` of what lies in a folder; local folders are never held as a whole."""
    if (local := _local(folder)) is not None:
        with os.scandir(local) as entries:
            for e in entries:
                try:
                    is_folder, size = e.is_dir(), e.stat().st_size
                except FileNotFoundError:  # gone meanwhile, or a link to nothing
                    continue
                yield f"{folder}/{e.name}", e.name, is_folder, 0 if is_folder else size
        return
    from pyarrow import fs

    store, base = _store(folder, known)
    for e in store.get_file_info(fs.FileSelector(base)):
        is_folder = e.type == fs.FileType.Directory
        yield f"{folder}/{e.base_name}", e.base_name, is_folder, 0 if is_folder else e.size


def _below(root: str, length: int | None, accepted: re.Pattern) -> Iterator[tuple[str, int]]:
    """Files below a folder, or the file ``root`` if it has a length, by the rules of Spark's file scans: hidden and empty ones are left out."""
    known: dict = {}
    folders, first = [root], [] if length is None else [(root, root.rsplit("/", 1)[-1], False, length)]
    while folders:
        folder = folders.pop()
        for path, name, is_folder, size in first or _entries(folder, known):
            hidden = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
            if is_folder:
                if not hidden or name.startswith(("_metadata", "_common_metadata")):
                    folders.append(path)
            elif not hidden and size and accepted.fullmatch(name):
                yield path, size


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, length)`` of every file below ``path``, as a stored table; a task lists them, so the driver holds none."""
    fs, target = filesystem(spark, path)
    found = fs.globStatus(target)
    if not found:
        spark.read.format("binaryFile").load(path)  # raises Spark's error
    roots = [(s.getPath().toString(), None if s.isDirectory() else s.getLen()) for s in found]
    accepted = re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern(), re.DOTALL)

    def run(batches):
        import pyarrow as pa

        for _ in batches:
            pass
        paths, lengths = [], []
        for root in roots:
            for name, size in _below(*root, accepted):
                paths.append(name)
                lengths.append(size)
                if len(paths) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])
                    paths, lengths = [], []
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])

    return materialize(spark.range(0, 1, 1, 1).mapInArrow(run, LISTED), "listed")


def with_contents(files: DataFrame, skip_corrupt: bool = False) -> DataFrame:
    """``files`` and the ``content`` of the file in ``path``, read by the tasks in lots of bounded bytes."""
    at = files.columns.index("path")

    def run(batches):
        import pyarrow as pa

        known: dict = {}
        for batch in batches:
            rows, bodies, size = [], [], 0

            def lot():
                taken = batch.take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([*taken.columns, pa.array(bodies, pa.binary())], [*batch.schema.names, "content"])

            for row, path in enumerate(batch.column(at).to_pylist()):
                try:
                    if (local := _local(path)) is not None:
                        with open(local, "rb") as source:
                            body = source.read()
                    else:
                        store, name = _store(path, known)
                        with store.open_input_stream(name) as source:
                            body = source.read()
                    if len(body) > 0x7FFFFFFF:
                        raise OSError(f"{path} is longer than a row may be: {len(body)} bytes")
                except (FileNotFoundError, PermissionError):
                    raise
                except OSError:
                    if not skip_corrupt:
                        raise
                    continue
                if rows and size + len(body) > LOT_BYTES:
                    yield lot()
                    rows, bodies, size = [], [], 0
                rows.append(row)
                bodies.append(body)
                size += len(body)
                if len(rows) == LOT:
                    yield lot()
                    rows, bodies, size = [], [], 0
            if rows:
                yield lot()

    return files.mapInArrow(run, T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType())]))


def in_fewer_tasks(listed: DataFrame) -> DataFrame:
    """The names of many small files in as many tasks as a scan has, but at most a few for each core or, if that is more, one for ``TOGETHER`` partitions of a scan.

    A table written from them has as few files. Only the names are moved.
    """
    cores = listed.sparkSession.sparkContext.defaultParallelism
    number, size = listed.agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0))).first()
    cost = size + number * OPENING
    found = math.ceil(cost / min(PARTITION, max(OPENING, cost // cores)))
    return listed.repartition(max(1, min(found, max(4 * cores, -(-found // TOGETHER)))))


def list_objects(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(object_name, length)`` of every file below ``path``; contents are not read."""
    return list_files(spark, path, glob).select(F.col("path").alias("object_name"), "length")


def read_binary(spark: SparkSession, path: str, glob: str = "*", skip_corrupt: bool = False) -> DataFrame:
    """``(key, filename, relative, raw)`` of every file below ``path``; ``relative`` is the path below it.

    An unreadable file fails the read; ``skip_corrupt=True`` leaves such files out.
    """
    files = with_contents(in_fewer_tasks(list_files(spark, path, glob)).select("path"), skip_corrupt)
    base = path.rstrip("/").split("://")[-1].split(":", 1)[-1].rstrip("/") + "/"
    return files.select(
        F.col("path").alias("key"),
        base_name("path").alias("filename"),
        F.substring_index("path", base, -1).alias("relative"),
        F.col("content").alias("raw"),
    )


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``(source_file, content, doc, error)``: one parsed JSON document per file."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    rows = files.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("content"))
    return parse_documents(rows, schema)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, WEATHER_SCHEMA)


def read_camera_reports(spark: SparkSession, path: str) -> DataFrame:
    return read_documents(spark, path, REPORT_SCHEMA)


def read_json_lines(
    spark: SparkSession, path: str, schema: str = ARTICLE_SCHEMA, limit: int | None = None
) -> DataFrame:
    """Parsed JSON lines with ``source_file`` and ``line_number``; blank lines are skipped.

    The first invalid line fails the job with its file and line. ``limit`` keeps
    the first rows in file and line order.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    numbered = number_lines(lines).filter(strip("value") != "")
    if limit is not None:
        numbered = numbered.orderBy("source_file", "line_number").limit(limit)
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    place = F.concat(F.lit("invalid JSON in "), F.col("source_file"), F.lit(" at line "), F.col("line_number").cast("string"))
    broken = F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull()
    checked = F.when(broken, F.raise_error(place).cast("string"))
    rows = numbered.withColumn("doc", parsed)
    # The check is folded into line_number, so no projection can prune it away.
    line = F.coalesce(checked.cast("bigint"), F.col("line_number")).alias("line_number")
    return rows.select("source_file", line, "doc.*").drop("_corrupt_record")


def kafka_frames(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """Kafka stream of frame messages as a ``value`` text column (needs the Kafka connector jar)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))
