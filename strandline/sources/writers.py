"""Executor-side sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.embed import FIELD_BYTES, clip_fields
from strandline.operators.tables import latest_per_key, replace_on_dimension_change, upsert_latest
from strandline.sources.commits import CommitLog, Conflict


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite") -> None:
    """Globally range-ordered Parquet, so min/max statistics can skip row groups.

    Give a unique trailing key: it lets one hot leading value span several ranges.
    """
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def replace_days(df: DataFrame, path: str, day: str, keys: Sequence[str]) -> None:
    """The rows of each day in ``df`` in place of that day's stored ones; other days stay, so a second run changes nothing.

    Days are the table's partitions, their files sorted by ``keys``. Rebalancing gives a small day one file and cuts a large one.
    """
    ordered = df.hint("rebalance", day).sortWithinPartitions(day, *keys)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_rejects(df: DataFrame, path: str) -> str | None:
    """Rejected rows as CSV in a timestamped folder; nothing is written for no rows."""
    if df.isEmpty():
        return None
    target = f"{path.rstrip('/')}/skipped_{datetime.now(UTC):%Y%m%dT%H%M%SZ}"
    # rejected cells are kept as they came, with the spaces around them
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.option("header", True).option("escape", '"').options(**spaces).csv(target)
    return target


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append records; columns may be added over time (read back with mergeSchema)."""
    df.write.mode("append").partitionBy(*partition_by).format(fmt).save(path)


def replace_documents(df: DataFrame, path: str) -> None:
    """All records of the current sources in place of the stored ones, so that a second run changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_parts(df: DataFrame, path: str, rows_per_part: int) -> None:
    """CSV parts of at most ``rows_per_part`` rows, each with a header."""
    df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", rows_per_part).csv(path)


def write_split(df: DataFrame, flag: Column, path: str, name: str = "accepted") -> None:
    """One pass, two partitions: ``accepted=true`` and ``accepted=false``."""
    rows = df.withColumn(name, F.coalesce(flag, F.lit(False)))
    # Static: a run without rejects also clears the rejects of the run before.
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(name).parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row; null fields are kept."""
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    rows.write.mode(mode).text(path)


def arrow_uri(path: str) -> str:
    """A Hadoop path as the URI that Arrow's file systems know (``s3a`` and ``s3n`` are its ``s3``)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path.removeprefix("file:")
    return "s3://" + path.split("://", 1)[1] if path.startswith(("s3a://", "s3n://")) else path


def write_files(df: DataFrame, root: str, name: str, content: str) -> None:
    """One file per row, written by the tasks; a retry replaces whole files only."""

    def put(rows) -> None:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(arrow_uri(root))
        made = set()
        for row in rows:
            body = row[content]
            target = f"{base}/{row[name].lstrip('/')}"
            folder = target.rsplit("/", 1)[0]
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            part = f"{folder}/.{uuid.uuid4().hex}.part"
            with store.open_output_stream(part) as out:
                out.write(body.encode() if isinstance(body, str) else bytes(body))
            store.move(part, target)

    df.select(name, content).foreachPartition(put)


def write_metadata_files(df: DataFrame, root: str, destination: str = "metadata_destination") -> None:
    """Metadata row to a JSON file at its own destination path."""
    body = F.to_json(F.struct(*[c for c in df.columns if c != destination]), {"ignoreNullFields": "false", "pretty": "true"})
    write_files(df.select(destination, body.alias("__json")), root, destination, "__json")


def latest_snapshot(spark: SparkSession, path: str) -> str | None:
    """The current snapshot folder (``v=``) of a versioned table."""
    log = CommitLog(spark, path)
    head, _ = log.state()
    return log.folder("v", head["number"]) if head["number"] else None


def _stored(log: CommitLog, head: dict, adds: list[dict], key: str, version: str) -> DataFrame | None:
    if not head["number"]:
        return None
    stored = log.spark.read.parquet(log.folder("v", head["number"]))
    newer = [log.folder("d", a["number"]) for a in adds if a["dim"] == head["dim"]]
    # A snapshot holds each key once; only increments need the comparison.
    return upsert_latest(stored, log.spark.read.option("mergeSchema", True).parquet(*newer), key, version) if newer else stored


def read_vectors(spark: SparkSession, path: str, key: str = "filename", version: str = "embedded_at") -> DataFrame | None:
    """Stored vectors, newest per key: the current snapshot and the increments (``d=``) it has not merged."""
    log = CommitLog(spark, path)
    return _stored(log, *log.state(), key, version)


def upsert_vectors(
    df: DataFrame, path: str, dim: int, key: str = "filename", version: str = "embedded_at", compact: bool = True, clip: bool = False, attempts: int = 20
) -> str:
    """Merge embeddings into the stored set, newest per key; another stored dimension is replaced.

    ``compact=False`` writes the incoming rows only, as an increment merged by
    :func:`read_vectors`; the default writes a full snapshot. Writers may run at the same time: increments never
    conflict, and a snapshot that another one overtook is merged and written anew, up to ``attempts`` times. ``clip`` cuts the stored texts to the
    byte limits of a vector store, but never the key: two long keys stay two rows.
    """
    log = CommitLog(df.sparkSession, path)
    if clip:
        df = clip_fields(df, {c: n for c, n in FIELD_BYTES.items() if c != key})
    if version not in df.columns:
        df = df.withColumn(version, F.current_timestamp())
    for _ in range(attempts):
        head, adds = log.state()
        number = log.claim()
        same = head["number"] and not replace_on_dimension_change(log.spark.read.parquet(log.folder("v", head["number"])), dim)
        if same and not compact:
            df.write.mode("overwrite").parquet(log.folder("d", number))
            log.add(number, dim=dim)
            return log.folder("d", number)
        rows = upsert_latest(_stored(log, head, adds, key, version), df, key, version) if same else latest_per_key(df, key, version)
        rows.write.mode("overwrite").parquet(log.folder("v", number))
        try:
            log.follow(head["number"], number, [*head["merged"], *(a["number"] for a in adds)], dim=dim)
        except Conflict:
            continue
        return log.folder("v", number)
    raise Conflict(f"{path}: overtaken by other writers {attempts} times")


def truncate_table(spark: SparkSession, path: str) -> None:
    """Remove all rows, keep the schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
