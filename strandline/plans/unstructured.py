"""Text and audio flows: cleaning into the trusted zone, embeddings into the exploitation zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.text import clean_text, decode_text, skip_reason
from strandline.operators import embed
from strandline.operators.cleaning import reason_counts
from strandline.operators.enrich import top_counts
from strandline.session import materialize
from strandline.sources.readers import read_binary, read_split
from strandline.sources.writers import read_vectors, replace_documents, upsert_vectors, write_files, write_split

TEXT_FIELDS = ("relative", "filename", "embedding", "headline", "category", "authors", "pub_date", "content_preview", "char_count", "word_count")
AUDIO_FIELDS = ("relative", "filename", "embedding", "duration_s", "sample_rate", "num_channels")


def cleaned_texts(files: DataFrame) -> DataFrame:
    """Add ``cleaned`` (bytes) and ``skip_reason`` to ``(key, filename, raw)`` rows."""
    staged = files.withColumn("__text", decode_text("raw"))
    return staged.withColumns(
        {"cleaned": clean_text("__text").cast("binary"), "skip_reason": skip_reason("__text")}
    ).drop("__text")


def _store(cleaned: DataFrame, out: str, files: bool) -> DataFrame:
    """Write the outcome once; copy files out of the stored table if asked to."""
    spark = cleaned.sparkSession
    kept = cleaned.withColumn("raw", F.when(F.col("skip_reason").isNotNull(), F.col("raw")))
    write_split(kept, F.col("skip_reason").isNull(), f"{out}/table")
    if files:
        accepted, skipped = read_split(spark, f"{out}/table")
        write_files(accepted, f"{out}/data", "relative", "cleaned")
        write_files(skipped, f"{out}/skipped", "relative", "raw")
    return reason_counts(spark.read.parquet(f"{out}/table"), "skip_reason")


def trust_texts(spark: SparkSession, source: str, out: str, files: bool = False) -> DataFrame:
    """Clean all ``.txt`` files below ``source``; returns files per outcome."""
    return _store(cleaned_texts(read_binary(spark, source, "*.txt")), out, files)


def trust_audio(spark: SparkSession, source: str, out: str, files: bool = False) -> DataFrame:
    """Clean all ``.wav`` files below ``source``; returns files per outcome."""
    return _store(embed.clean_audio(read_binary(spark, source, "*.wav")), out, files)


def _accepted(spark: SparkSession, trusted: str) -> DataFrame:
    return read_split(spark, f"{trusted}/table")[0].select("relative", "filename", "cleaned")


def exploit_texts(spark: SparkSession, trusted: str, out: str, files: bool = False) -> DataFrame:
    """Embed the trusted texts into the vector table; returns the ten largest categories.

    Files that could not be embedded are counted by reason under ``failed``.
    """
    texts = _accepted(spark, trusted)
    rows = materialize(embed.embed_articles(texts.withColumn("text", F.col("cleaned").cast("string"))).drop("text", "cleaned"), "texts")
    upsert_vectors(rows.filter("error is null").select(*TEXT_FIELDS), f"{out}/vectors", embed.TEXT_DIM, key="relative")
    replace_documents(reason_counts(rows), f"{out}/failed")
    if files:
        write_files(texts, f"{out}/data", "relative", "cleaned")
    return top_counts(read_vectors(spark, f"{out}/vectors", "relative"), "category")


def exploit_audio(spark: SparkSession, trusted: str, out: str, files: bool = False) -> DataFrame:
    """Embed the trusted audio into the vector table; returns files per outcome."""
    clips = _accepted(spark, trusted)
    rows = materialize(embed.embed_audio(clips, "cleaned").drop("cleaned"), "clips")
    upsert_vectors(rows.filter("error is null").select(*AUDIO_FIELDS), f"{out}/vectors", embed.AUDIO_DIM, key="relative")
    if files:
        write_files(clips, f"{out}/data", "relative", "cleaned")
    return reason_counts(rows)
