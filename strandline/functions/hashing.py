"""Signed feature hashing of word n-grams, as native expressions and as an Arrow batch function."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.columns import as_col

TOKEN = "[a-z0-9]+"
BIGRAM_WEIGHT = 0.5
# Words whose digests a task keeps, about 200 bytes each.
_CACHE_LIMIT = 100_000


def word_tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(TOKEN), F.lit(0))


def weighted_grams(tokens: Column | str) -> Column:
    """Array of ``(gram, weight)``: words at 1, neighbouring pairs at 0.5.

    Feed it a token column made in an earlier projection; it is used repeatedly.
    """
    tokens = as_col(tokens)
    one, half = F.lit(1.0), F.lit(BIGRAM_WEIGHT)
    last = F.size(tokens) - 1
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(last, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(last, F.lit(0))),
        lambda a, b: F.struct(F.concat_ws("_", a, b).alias("gram"), half.alias("weight")),
    )
    words = F.transform(tokens, lambda t: F.struct(t.alias("gram"), one.alias("weight")))
    return F.concat(words, pairs)


def gram_digest(gram: Column | str) -> Column:
    return F.md5(as_col(gram).cast("binary"))


def digest_bucket(digest: Column | str, dim: int) -> Column:
    """The first 8 digest bytes, read as one big-endian number, modulo ``dim``."""
    digest = as_col(digest)
    if dim & (dim - 1) == 0 and dim <= 2**16:
        # A power of two needs the number's last bits only.
        return F.conv(F.substring(digest, 13, 4), 16, 10).cast("int").bitwiseAND(F.lit(dim - 1))
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("bigint")
    return F.pmod(F.pmod(high, F.lit(dim)) * F.lit(2**32 % dim) + F.pmod(low, F.lit(dim)), F.lit(dim)).cast("int")


def digest_sign(digest: Column | str) -> Column:
    """+1 where bit 32 of the same number is set (an odd eighth hex digit), else -1."""
    return F.when(F.substring(as_col(digest), 8, 1).isin(*"13579bdf"), F.lit(1.0)).otherwise(F.lit(-1.0))


def hashed_vectors(texts: Iterable[str | None], dim: int) -> list[np.ndarray]:
    """Unnormalised signed bucket sums of each text; nulls give a zero vector."""
    return list(each_vector(texts, dim))


def each_vector(texts: Iterable[str | None], dim: int) -> Iterator[np.ndarray]:
    """:func:`hashed_vectors`, one at a time."""
    # Word characters are ASCII, so tokens can be cut from the encoded bytes.
    find = re.compile(TOKEN.encode()).findall
    md5 = hashlib.md5
    known: dict[bytes, bytes] = {}
    for text in texts:
        words = find(text.lower().encode()) if text else []
        if not words:
            yield np.zeros(dim)
            continue
        if len(known) > _CACHE_LIMIT:
            known.clear()
        for w in set(words).difference(known):
            known[w] = md5(w).digest()[:8]
        heads = [known[w] for w in words]
        heads += [md5(a + b"_" + b).digest()[:8] for a, b in zip(words, words[1:])]
        numbers = np.frombuffer(b"".join(heads), ">u8").astype(np.uint64)
        weights = ((numbers >> np.uint64(32)) & np.uint64(1)).astype(np.float64) * 2.0 - 1.0
        weights[len(words) :] *= BIGRAM_WEIGHT
        slots = (numbers % np.uint64(dim)).astype(np.int64)
        yield np.bincount(slots, weights=weights, minlength=dim)


def unit(vector: np.ndarray) -> np.ndarray:
    norm = float(np.sqrt(np.dot(vector, vector)))
    return vector / norm if norm > 0.0 else vector


def dense_hash(dim: int, normalize: bool = True) -> Callable[[Column | str], Column]:
    """Arrow UDF: text to its hashed vector, L2-normalised unless asked otherwise."""
    kind = np.float32 if normalize else np.float64

    # Arrow in and out, so that a batch is held as its buffers and one matrix, not as an object for each text and vector.
    @F.arrow_udf("array<float>" if normalize else "array<double>")
    def encode(texts: pa.Array) -> pa.Array:
        matrix = np.empty((len(texts), dim), kind)
        for row, vector in zip(matrix, each_vector((t.as_py() for t in texts), dim)):
            row[:] = unit(vector) if normalize else vector
        return pa.ListArray.from_arrays(pa.array(np.arange(0, matrix.size + 1, dim, dtype=np.int32)), pa.array(matrix.ravel()))

    return lambda c: encode(as_col(c))


def l2_norm(vector: Column | str) -> Column:
    squares = F.aggregate(as_col(vector), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def l2_normalize(vector: Column | str) -> Column:
    """Unit length; a zero vector stays as it is. Feed it a materialised column."""
    vector = as_col(vector)
    norm = l2_norm(vector)
    return F.when(
        norm > 0, F.transform(F.arrays_zip(vector.alias("x"), F.array_repeat(norm, F.size(vector)).alias("n")),
                              lambda p: (p["x"].cast("double") / p["n"]).cast("float"))
    ).otherwise(F.transform(vector, lambda x: x.cast("float")))
