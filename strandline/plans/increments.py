"""The trusted zone batch by batch: each record is cleaned once, however many batches follow.

``<root>/accepted``, ``<root>/rejected`` and ``<root>/keys`` grow by one ``batch_id=`` folder a batch. A batch is deduplicated
in itself and against the keys of all committed batches; of the stored keys only those move that may be among its own
(``not_yet_in``). The first record of a key that came stays, accepted or not, so the batches together hold what one batch of all records holds
whose ties fall to the order of arrival. Null keys are one key.

A batch counts once it is committed: a failure takes its folders back, a batch that was lost is taken back by the next start, and one that is
committed already is not run again. Batches of one zone run one after the other, as those of a stream do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.cleaning import COLLISION_SCHEMA, acceptable, align, cast_records, dedupe
from strandline.operators.membership import not_yet_in
from strandline.session import scratch_path
from strandline.sources.batches import BatchLog
from strandline.sources.commits import filesystem
from strandline.sources.readers import read_split, read_table
from strandline.sources.writers import write_split

TABLES = ("accepted", "rejected", "keys")
SUMMARY = "total_rows bigint, clean_rows bigint, rejected_rows bigint, duplicate_rows bigint"
#: Lake files of one trigger.
MAX_FILES = 1000


def batch_log(spark: SparkSession, root: str) -> BatchLog:
    return BatchLog(spark, root, TABLES)


def read_trusted(spark: SparkSession, root: str, table: str = "accepted") -> DataFrame | None:
    """Rows of the committed batches; None before the first."""
    return batch_log(spark, root).read(table)


def _staged(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trust_batch(
    records: DataFrame, batch_id: int, root: str, key: str = "collision_id", order_by: Sequence[Column | str] | None = None
) -> DataFrame:
    """Clean one batch of all-string records into ``accepted`` (typed) and ``rejected`` (as they came); returns its counts.

    Ties inside the batch fall to ``order_by``, then to the other columns; a record whose key came before is a duplicate.
    A column ``batch_id``, as landed tables have it, is left out: the folders of this zone give their own.
    """
    spark, root, records = records.sparkSession, root.rstrip("/"), records.drop("batch_id")
    log = batch_log(spark, root)
    counts = f"{log.folder(batch_id)}/counts"
    if not log.committed(batch_id):
        log.begin(batch_id)
        scratch = scratch_path(spark, f"trust-{batch_id}")
        try:
            fresh, seen = _staged(dedupe(records, [key], order_by), f"{scratch}/unique"), log.read("keys")
            if seen is not None:
                fresh = _staged(not_yet_in(fresh, seen.select(key), [key]), f"{scratch}/fresh")
            write_split(fresh, acceptable(fresh), f"{scratch}/split")
            kept, rejected = read_split(spark, f"{scratch}/split")
            align(cast_records(kept), COLLISION_SCHEMA).write.parquet(f"{root}/accepted/batch_id={batch_id}")
            rejected.write.parquet(f"{root}/rejected/batch_id={batch_id}")
            fresh.select(key).write.parquet(f"{root}/keys/batch_id={batch_id}")
            total, clean, bad = records.count(), kept.count(), rejected.count()
            spark.createDataFrame([(total, clean, bad, total - clean - bad)], SUMMARY).write.parquet(counts)
        except BaseException:
            log.roll_back(batch_id)
            raise
        finally:
            fs, folder = filesystem(spark, scratch)
            fs.delete(folder, True)
        log.commit(batch_id)
    return spark.read.schema(SUMMARY).parquet(counts)


def trust_available(spark: SparkSession, lake: str, root: str, checkpoint: str, max_files: int = MAX_FILES) -> DataFrame:
    """Clean the files of the lake table that ``checkpoint`` has not seen, a batch at a time; returns the counts of this run."""
    log = batch_log(spark, root)
    for n in set(log.batches()) - set(log.batches("committed")):
        log.roll_back(n)
    done: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        trust_batch(batch, batch_id, root)
        done.append(batch_id)

    files = spark.readStream.schema(read_table(spark, lake).schema).option("maxFilesPerTrigger", max_files).parquet(lake)
    files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run).trigger(availableNow=True).start().awaitTermination()
    paths = [f"{log.folder(n)}/counts" for n in done]
    found = spark.read.schema(SUMMARY).parquet(*paths) if paths else spark.createDataFrame([], SUMMARY)
    return found.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in found.columns))
