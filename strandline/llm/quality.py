"""Quality rules whose cutoffs are certified on labelled holdouts.

All on DataFrame functions. Word counts and repetition are computed inside a row (no
shuffle of texts); the cutoffs come from counts per stratum, rule and grid value.

Null texts count as empty. Repeated rows are judged one by one. Null strata form a
stratum of their own. Only the named columns are used; others may be present.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rules on whole numbers: a document is rejected when the value is above the cutoff.
RULES = {
    "symbols": "n_symbols * 1000 div greatest(n_words, 1)",
    "dup_lines": "n_dup_lines * 1000 div greatest(n_words, 1)",
    "repeats": "n_repeat_words * 1000 div greatest(n_words, 1)",
    "long_words": "word_chars * 100 div greatest(n_words, 1)",
}
GRIDS = {
    "symbols": (10, 20, 40, 60, 80, 100, 120, 160, 200, 250, 300, 400, 600, 800, 1000),
    "dup_lines": (5, 10, 15, 20, 30, 40, 60, 80, 100, 150, 200, 300, 400, 600, 800),
    "repeats": (100, 150, 200, 220, 240, 260, 280, 300, 320, 340, 360, 400, 440, 480, 500),
    "long_words": (600, 650, 700, 750, 800, 850, 900, 950, 1000, 1100, 1200, 1400, 1600, 1800, 2000),
}
ALPHA, DELTA = 0.01, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
WORD_GAP = r"[\x20\x09-\x0D]+"


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    words = F.array_remove(F.split(F.col("body"), WORD_GAP), "")
    lines = F.filter(F.split("body", "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\f\r")) != "")
    base = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("body"))
    base = base.select(*keep, words.alias("w"), lines.alias("lines"), F.regexp_count("body", F.lit(r"[#*$%&|<>]")).alias("n_symbols"))
    base = base.select(
        *keep,
        "w",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # as many low bits as the positions of this text need; the rest of a long keeps the window's hash
        F.length(F.bin(F.size("w").cast("long"))).alias("b"),
    )
    window = "shiftleft(shiftright(xxhash64(x, get(w, i + 1), get(w, i + 2)), b), b) | cast(i AS bigint)"
    keyed = F.expr(f"CASE WHEN n_words >= 4 THEN sort_array(slice(transform(w, (x, i) -> {window}), 1, size(w) - 2)) END")
    base = base.withColumn("s", keyed).drop("w")
    twice = (
        "filter(s, (x, k) -> shiftright(x, b) = shiftright(get(s, k + 1), b)"
        " OR (k > 0 AND shiftright(x, b) = shiftright(get(s, k - 1), b)))"
    )
    base = base.withColumn("p", F.expr(f"sort_array(transform({twice}, x -> x & (shiftleft(1L, b) - 1L)))")).drop("s")
    covered = (
        "coalesce(aggregate(p, named_struct('last', -3L, 'n', 0L),"
        " (a, x) -> named_struct('last', x, 'n', a.n + least(3L, x - a.last)), a -> a.n), 0L)"
    )
    base = base.withColumn("n_repeat_words", F.expr(covered)).drop("p", "b")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return base.withColumn("base_failed", failed)


def _log_gamma(z: str) -> str:
    """ln Gamma by Stirling's series after a shift of 8; the error is below 1e-11 for z >= 1."""
    shift = " + ".join(f"ln({z} + {i})" for i in range(8))
    y = f"({z} + 8)"
    return f"(({y} - 0.5D) * ln({y}) - {y} + {0.5 * math.log(2 * math.pi)!r}D + 1D / (12D * {y}) - 1D / (360D * pow({y}, 3)) + 1D / (1260D * pow({y}, 5)) - ({shift}))"


def binomial_tail(x: str, n: str, p: float) -> str:
    """SQL for P(Bin(n, p) <= x): terms from x downwards, as far as they can matter to a double."""
    log_term = f"{_log_gamma(f'({n} + 1D)')} - {_log_gamma('(k + 1D)')} - {_log_gamma(f'({n} - k + 1D)')} + k * {math.log(p)!r}D + ({n} - k) * {math.log1p(-p)!r}D"
    return f"aggregate(sequence(greatest(0L, {x} - 40L * cast(ceil(sqrt({x} + 1)) AS bigint) - 100L), {x}), 0D, (a, k) -> a + exp({log_term}))"


def certify(
    measured: DataFrame, labels: DataFrame, stratum: str = "lang", label: str = "quality", good: int = 1,
    alpha: float = ALPHA, delta: float = DELTA, rules: dict[str, str] = RULES, grids: dict[str, tuple[int, ...]] = GRIDS,
) -> DataFrame:
    """Per stratum one row with a certified cutoff for each rule (null: the rule stays off).

    A cutoff is certified when the exact binomial test rejects "it turns away more than
    ``alpha`` / rules of good documents" at level ``delta`` / all tests made. Hence with
    probability 1 - delta no stratum loses more than ``alpha`` of its good documents
    through all rules together. Of the certified cutoffs the smallest is taken.
    ``labels`` has doc_id and the label; a document labelled more than once counts as good
    if any label says so.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("mark"))
    held = measured.where(~F.col("base_failed")).join(marks.where(F.col("mark") == good), "doc_id")
    held = held.select(F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), *(F.expr(e).alias(f"v_{r}") for r, e in rules.items()))
    counts = held.groupBy("stratum").agg(
        F.count("*").alias("n"),
        *(F.count_if(F.col(f"v_{r}") > c).alias(f"x_{r}_{i}") for r in rules for i, c in enumerate(grids[r])),
    )
    # strata are counted in the same small table (one row each), so the correction follows the data
    counts = counts.withColumn("tests", F.count("*").over(Window.partitionBy()) * sum(len(grids[r]) for r in rules))
    cells = ", ".join(f"named_struct('rule', '{r}', 'cutoff', {c}L, 'x', x_{r}_{i})" for r in rules for i, c in enumerate(grids[r]))
    counts = counts.select("stratum", "n", "tests", F.explode(F.expr(f"array({cells})")).alias("cell"))
    counts = counts.select("stratum", "n", "tests", "cell.*")
    share = alpha / len(rules)
    tail = F.expr(f"CASE WHEN x <= n * {share!r}D THEN {binomial_tail('x', 'n', share)} ELSE 1D END")
    passed = counts.withColumn("tail", tail).where(F.col("tail") <= delta / F.col("tests"))
    return passed.groupBy("stratum").agg(*(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"c_{r}") for r in rules))


def verdicts(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang", rules: dict[str, str] = RULES) -> DataFrame:
    """``measured`` plus ``kept``: false if a base limit fails or a certified rule rejects."""
    names = measured.columns
    out = measured.withColumn("stratum_key", F.coalesce(F.col(stratum), F.lit("")))
    out = out.join(cutoffs.withColumnRenamed("stratum", "stratum_key"), "stratum_key", "left")
    hit = F.lit(False)
    for r, e in rules.items():
        hit = hit | F.coalesce(F.expr(e) > F.col(f"c_{r}"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~hit).select(*names, "kept")
