"""Length buckets that waste least, and batches of a token budget inside them.

Texts are cut into pieces of at most ``max_len`` words. The histogram of piece lengths, rounded
up to ``step``, has at most max_len / step entries whatever the input's size; it goes to the
driver, where dynamic programming finds the bucket bounds of least padding. Every batch holds
pieces of one bucket, padded to its bound, up to ``budget`` words.

Null and empty texts have no pieces, hence no rows. Null and repeated doc_ids are allowed; rows
with equal doc_id, piece and length are interchangeable in the result. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.ranking import ranked

MAX_LEN, STEP, BUCKETS, BUDGET = 2048, 64, 8, 65536


def bucket_bounds(histogram: dict[int, tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Bounds minimising the sum over pieces of (bound of its bucket - length).

    ``histogram``: bound -> (pieces, their total length), keys being the allowed bounds. Padding
    is pieces x bound - total, so only pieces x bound matters. Of equal costs, fewer buckets and
    then the smaller last-but-one bound win.
    """
    bounds = sorted(b for b, (n, _) in histogram.items() if n)
    if not bounds:
        return []
    upto = [0]
    for b in bounds:
        upto.append(upto[-1] + histogram[b][0])
    size = len(bounds)
    best = [upto[i + 1] * bounds[i] for i in range(size)]
    back = [[-1] * size]
    total, used = best[-1], 1
    for k in range(2, min(buckets, size) + 1):
        now, came = list(best), [-2] * size
        for i in range(size):
            for j in range(i):
                cost = best[j] + (upto[i + 1] - upto[j + 1]) * bounds[i]
                if cost < now[i]:
                    now[i], came[i] = cost, j
        best = now
        back.append(came)
        if best[-1] < total:
            total, used = best[-1], k
    out, i, k = [], size - 1, used - 1
    while i >= 0:
        out.append(bounds[i])
        while k > 0 and back[k][i] == -2:
            k -= 1
        i, k = back[k][i], k - 1
    return out[::-1]


def pieces(docs: DataFrame, text: str = "text", max_len: int = MAX_LEN, step: int = STEP) -> DataFrame:
    """doc_id, piece (0-based), length in words, and the length rounded up to ``step``."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    counted = docs.select("doc_id", words.alias("n_words")).where("n_words > 0")
    cut = counted.select("doc_id", "n_words", F.explode(F.expr(f"sequence(0L, (n_words - 1) div {max_len})")).alias("piece"))
    length = F.least(F.lit(max_len), F.col("n_words") - F.col("piece") * max_len)
    cut = cut.select("doc_id", "piece", length.alias("length"))
    return cut.withColumn("rounded", F.expr(f"(length + {step - 1}) div {step} * {step}"))


def pack(docs: DataFrame, stage, text: str = "text", max_len: int = MAX_LEN, step: int = STEP, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per piece: doc_id, piece, length, bucket (its bound), batch (numbered in the bucket), place in the batch.

    ``stage(df)`` writes and rereads a table in the shared folder.
    """
    cut = stage(pieces(docs, text, max_len, step))
    # at most max_len / step rows
    histogram = {r[0]: (r[1], r[2]) for r in cut.groupBy("rounded").agg(F.count("*"), F.sum("length")).collect()}
    bucket = F.lit(None).cast("long")
    for bound in reversed(bucket_bounds(histogram, buckets)):
        bucket = F.when(F.col("rounded") <= bound, F.lit(bound).cast("long")).otherwise(bucket)
    placed = ranked(cut.withColumn("bucket", bucket), "bucket", ["doc_id", "piece", "length"], stage)
    room = F.expr(f"greatest(1L, {budget}L div bucket)")
    return placed.select(
        "doc_id", "piece", "length", "bucket", F.expr(f"rank div greatest(1L, {budget}L div bucket)").alias("batch"), (F.col("rank") % room).alias("place")
    )
