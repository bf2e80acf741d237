"""Text and audio embeddings."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import audio as wav
from strandline.functions.columns import as_col
from strandline.functions.hashing import dense_hash, digest_bucket, digest_sign, gram_digest, unit, weighted_grams, word_tokens
from strandline.functions.text import ARTICLE_LINES, non_empty_lines, strip, truncate_bytes, word_count

TEXT_DIM = 128
AUDIO_DIM = 64
# Byte limits of the stored string fields.
FIELD_BYTES = {
    "filename": 512,
    "headline": 512,
    "category": 128,
    "authors": 256,
    "pub_date": 64,
    "content_preview": 1024,
}


def article_fields(df: DataFrame, text: str, positional: bool = False, preview_chars: int | None = None) -> DataFrame:
    """Add headline .. content_preview, char_count and word_count of an article text.

    Fields are the i-th non-empty lines, so a blank line shifts what follows;
    ``positional=True`` takes the i-th line as written instead. The preview is headline and short
    description; ``preview_chars`` cuts it (``PREVIEW_CHARS`` is the usual length).
    """
    body = strip(F.make_valid_utf8(F.col(text)))
    lines = F.split(body, "\n")
    lines = F.transform(lines, strip) if positional else non_empty_lines(lines)
    staged = df.withColumns({"__body": body, "__lines": lines})
    # Names of temporary columns stay out of the caller's way.
    part = {n: F.coalesce(F.get("__lines", F.lit(i)), F.lit("")) for i, n in enumerate(ARTICLE_LINES[:5])}
    category = part["category"]
    preview = strip(F.concat(part["headline"], F.lit(" "), part["short_description"]))
    if preview_chars is not None:
        preview = F.substring(preview, 1, preview_chars)
    return staged.withColumns(
        {
            "headline": part["headline"],
            "category": F.when(category == "", F.lit("UNKNOWN")).otherwise(F.upper(category)),
            "authors": part["authors"],
            "pub_date": part["pub_date"],
            "short_description": part["short_description"],
            "content_preview": preview,
            "char_count": F.length("__body").cast("bigint"),
            "word_count": word_count("__body").cast("bigint"),
        }
    ).drop("__body", "__lines")


def embed_input(preview: Column | str, text: Column | str) -> Column:
    """The preview, or the whole text where the preview is empty."""
    return F.coalesce(F.nullif(as_col(preview), F.lit("")), as_col(text))


def sparse_hash_embedding(df: DataFrame, key: str, text: str, dim: int = TEXT_DIM) -> DataFrame:
    """Native long form ``(key, bucket, weight)`` of the unnormalised vector, zeros left out.

    Grams are summed per (document, bucket) before the shuffle, so even one
    very long document moves at most ``dim`` rows per partition.
    """
    # Tokens, grams and digests in projections of their own: each is computed once.
    words = df.select(key, word_tokens(text).alias("__words"))
    grams = words.select(key, F.inline_outer(weighted_grams("__words"))).filter("gram is not null")
    placed = grams.select(key, "weight", gram_digest("gram").alias("__d")).select(
        key, digest_bucket("__d", dim).alias("bucket"), (digest_sign("__d") * F.col("weight")).alias("weight")
    )
    return placed.groupBy(key, "bucket").agg(F.sum("weight").alias("weight")).filter("weight <> 0")


def hash_embedding(
    df: DataFrame, key: str, text: str, dim: int = TEXT_DIM, sparse: bool = False, out: str = "embedding"
) -> DataFrame:
    """Hashed n-gram embedding: a unit vector column, or :func:`sparse_hash_embedding`."""
    if sparse:
        return sparse_hash_embedding(df, key, text, dim)
    return df.withColumn(out, dense_hash(dim)(text))


def embed_articles(df: DataFrame, text: str = "text", dim: int = TEXT_DIM, preview_chars: int | None = None) -> DataFrame:
    """Article fields plus ``embedding``; a null text becomes a row with ``error`` set.

    The whole text is embedded. With ``preview_chars`` it is the preview of that length, and the
    whole text only where the preview is empty.
    """
    fields = article_fields(df, text, preview_chars=preview_chars)
    body = strip(F.make_valid_utf8(F.col(text)))
    failed = F.col(text).isNull()
    chosen = body if preview_chars is None else embed_input("content_preview", body)
    return fields.withColumn("embedding", F.when(~failed, dense_hash(dim)(chosen))).withColumn(
        "error", F.when(failed, F.lit("no content"))
    )


def clip_fields(df: DataFrame, limits: Mapping[str, int] = FIELD_BYTES) -> DataFrame:
    """Clip stored string fields to their byte limits."""
    return df.withColumns({c: truncate_bytes(c, n) for c, n in limits.items() if c in df.columns})


def check_dimension(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """One row: vectors, and how many of them have another length than ``dim``."""
    return df.agg(
        F.count(vector).alias("vector_count"),
        F.count_if(F.size(vector) != dim).alias("wrong_dim_count"),
    )


def window_features(
    df: DataFrame, signal: str, n_windows: int = wav.N_WINDOWS, out: str = "features", normalize: bool = True
) -> DataFrame:
    """Windowed statistics of a numeric array column, ``4 * n_windows`` values."""

    @F.pandas_udf("array<double>")
    def encode(signals: pd.Series) -> pd.Series:
        present = signals.notna()
        vectors = signals[present].map(lambda s: wav.window_moments(s, n_windows))
        return (vectors.map(unit) if normalize else vectors).reindex(signals.index).astype(object).where(present, None)

    return df.withColumn(out, encode(F.col(signal)))


def per_file(schema: str) -> Callable:
    """A function of one file's bytes as a UDF that is handed rows in small lots.

    An Arrow batch counts rows, 10,000 unless set otherwise, whatever they weigh: of WAV files that is hundreds of MB in a worker, several times
    over while they are converted. There is nothing to vectorize over files either.
    """
    return F.udf(returnType=schema, useArrow=False)


def embed_audio(df: DataFrame, raw: str = "raw", max_seconds: int | None = None) -> DataFrame:
    """``embedding``, ``duration_s``, ``sample_rate``, ``num_channels`` and ``error`` of a WAV column.

    The whole clip is embedded unless ``max_seconds`` ends it (``MAX_SECONDS`` is the usual length).
    """
    schema = "embedding array<float>, duration_s float, sample_rate bigint, num_channels bigint, error string"

    @per_file(schema)
    def encode(content: bytes | None) -> tuple:
        clip = wav.try_clip(content)
        if clip.error:
            return None, None, None, None, clip.error
        vector = unit(wav.window_moments(clip.scaled(max_seconds))).astype(np.float32)
        return vector.tolist(), clip.seconds, clip.sample_rate, clip.num_channels, None

    return df.withColumn("__audio", encode(F.col(raw))).select(*df.columns, "__audio.*")


def clean_audio(df: DataFrame, raw: str = "raw", eight_bit_signed: bool = False) -> DataFrame:
    """Add ``cleaned`` (16 kHz mono 16-bit WAV) and ``skip_reason`` to a binary table."""

    encode = per_file("cleaned binary, skip_reason string")(lambda content: wav.clean_wav(content, eight_bit_signed))
    return df.withColumn("__audio", encode(F.col(raw))).select(*df.columns, "__audio.*")


def wav_header(raw: Column | str) -> Column:
    """Header struct of a WAV column; ``is_valid_wav`` is false (rest null) for other bytes."""
    schema = (
        "sample_rate_hz bigint, channels bigint, sample_width_bytes bigint, "
        "frame_count bigint, duration_seconds double, is_valid_wav boolean"
    )

    names = ("sample_rate_hz", "channels", "sample_width_bytes", "frame_count", "duration_seconds")

    @per_file(schema)
    def encode(content: bytes | None) -> tuple:
        try:
            header = wav.read_header(content)
        except Exception:
            return *[None] * len(names), False
        return *[header[n] for n in names], True

    return encode(as_col(raw))
