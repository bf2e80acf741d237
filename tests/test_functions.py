import re
import tracemalloc
from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import columns as c
from strandline.functions import text as x
from strandline.functions.hashing import dense_hash, each_vector, hashed_vectors, l2_norm, l2_normalize, unit
from strandline.operators.embed import sparse_hash_embedding


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", expr.alias("o")).collect())]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "` CRASH DATE ` int, `ON STREET NAME#` int")
    assert c.normalize_columns(df).columns == ["crash_date", "on_street_name"]
    with pytest.raises(ValueError, match="collide"):
        c.normalize_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int"))


def test_parse_date(spark):
    texts = ["01/02/2024", "2024-01-02T00:00:00.000", "2024-01-02", "1/2/2024", " ", None, "garbage", "13/01/2024"]
    day = date(2024, 1, 2)
    assert values(spark, texts, c.parse_date("v")) == [day, day, day, None, None, None, None, None]


def test_safe_numbers(spark):
    texts = ["1", "1.0", " 12 ", "x", None, "", "-1", "70000", "99999999999", "9007199254740993.0"]
    assert values(spark, texts, c.safe_int("v")) == [1, 1, 12, 0, 0, 0, -1, 70000, 0, 0]
    assert values(spark, texts, c.safe_long("v"))[-2:] == [99999999999, 9007199254740993]
    assert values(spark, ["1.5", "x", None], c.safe_double("v")) == [1.5, None, None]


def test_first_int_drops_the_sign_unless_asked(spark):
    texts = ["10 to 15 mph", "calm", "-5", None]
    assert values(spark, texts, c.first_int("v")) == [10, None, 5, None]
    assert values(spark, texts, c.first_int("v", signed=True))[2] == -5


def test_rules_take_the_first_match(spark):
    places = ["lower_manhattan", "South_Bronx", "riverdale", "staten_island", None, "upper_east_side"]
    expected = ["MANHATTAN", "BRONX", "UNKNOWN", "STATEN ISLAND", "UNKNOWN", "MANHATTAN"]
    assert values(spark, places, c.rule_map("v", c.LOCATION_RULES)) == expected
    cameras = ["Nd_O", "NT2_x", "NT4_x", "SW_O", "zNd"]
    assert values(spark, cameras, c.rule_map("v", c.CAMERA_RULES)) == ["MANHATTAN", "BROOKLYN", "QUEENS", "STATEN ISLAND", "UNKNOWN"]


def test_round_half_even_equals_python(spark):
    rows = [(a / b, a / b) for b in range(1, 120) for a in range(0, 400, 3)] + [(2.675, 2.675), (0.125, 0.125)]
    got = spark.createDataFrame(rows, "q double, r double").select("r", c.round_half_even(F.col("q")).alias("o")).collect()
    assert all(r["o"] == round(r["r"], 2) for r in got)


CLEANED = {
    "": None, " \t\n": None, "\xa0": None, "A": "a\n", " aB \t9 ": "ab 9\n", "a\r\nb\rc": "a\nb\nc\n", "a\n\n\n\nb": "a\n\nb\n", "a\n \n\t\nB": "a\n\nb\n",
    "x\t \ty": "x y\n", "\x85a\xa0": "a\n", "a\n\nb\n\n": "a\n\nb\n", "É ": "é\n",
}


def test_cleaned_texts(spark):
    assert values(spark, list(CLEANED), x.clean_text("v")) == list(CLEANED.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB9é \t\n\r\x0b\x1c\x85\xa0 ", max_size=40), min_size=1, max_size=60))
def test_text_against_python(spark, texts):
    for text, cleaned in zip(texts, values(spark, texts, x.clean_text("v"))):
        assert (cleaned is None) == (not text.strip())
        if cleaned is not None:
            # letters and order stay; runs, ends and cases do not
            assert cleaned.split() == text.lower().split() and cleaned.endswith("\n") and "\n\n\n" not in cleaned
            assert cleaned == cleaned.lower() and not re.search("[ \t]{2}|\r", cleaned)
    assert values(spark, texts, x.word_count("v")) == [len(t.split()) for t in texts]
    assert values(spark, texts, x.split_lines("v")) == [t.splitlines() for t in texts]


def test_clean_text_is_idempotent(spark, table):
    once = table("documents").select(x.clean_text("text").alias("t"))
    assert once.filter(x.clean_text("t") != F.col("t")).isEmpty()


def test_whitespace_constants_match_python():
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    assert set(x.WHITESPACE) == {ch for ch in every if not ch.strip()}
    assert set(x.LINE_BREAKS) == {ch for ch in every if len(f"a{ch}b".splitlines()) == 2}


def test_decode_falls_back_to_latin1(spark):
    rows = [(bytearray("héé".encode()),), (bytearray("héé".encode("latin-1")),)]
    df = spark.createDataFrame(rows, "raw binary")
    assert [r[0] for r in df.select(x.decode_text("raw")).collect()] == ["héé", "héé"]


def test_truncate_bytes(spark):
    texts = ["ééé", "a" * 10, "🙂🙂", None, "aé🙂z"]
    for limit in range(0, 9):
        expected = [(t or "").encode()[:limit].decode(errors="ignore") for t in texts]
        assert values(spark, texts, x.truncate_bytes("v", limit)) == expected


def test_hash_buckets():
    # Known digests: word, bucket of 128, sign.
    for word, bucket, sign in [("politics", 45, 1), ("the", 91, 1), ("x9", 72, 1)]:
        vector = hashed_vectors([word], 128)[0]
        assert vector[bucket] == sign and np.abs(vector).sum() == 1


@pytest.mark.parametrize("dim", [128, 100, 1000])
def test_sparse_and_dense_embeddings_agree(spark, table, dim):
    docs = table("documents").select("doc_id", "text")
    sparse = sparse_hash_embedding(docs, "doc_id", "text", dim).collect()
    dense = {r["doc_id"]: v for r, v in ((r, hashed_vectors([r["text"]], dim)[0]) for r in docs.collect())}
    assert len(sparse) == sum(np.count_nonzero(v) for v in dense.values())
    assert all(dense[r["doc_id"]][r["bucket"]] == r["weight"] for r in sparse)


def test_l2(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    got = df.select(l2_normalize("v").alias("u"), l2_norm("v").alias("n")).collect()
    assert [r["n"] for r in got] == [5.0, 0.0]
    assert np.allclose(got[0]["u"], [0.6, 0.8]) and got[1]["u"] == [0.0, 0.0]


def test_each_vector_keeps_few_digests():
    texts = (" ".join(f"w{i}x{j}" for j in range(100)) for i in range(3000))  # 300,000 words, each once
    tracemalloc.start()
    count = sum(1 for _ in each_vector(texts, 128))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 3000 and peak < 30e6


def test_dense_hash_of_nulls_and_empty_texts(spark):
    rows = spark.createDataFrame([(1, "one two one"), (2, ""), (3, None)], "i int, t string").coalesce(1)
    for normalize in (True, False):
        got = {r["i"]: r["v"] for r in rows.select("i", dense_hash(8, normalize)("t").alias("v")).collect()}
        (want,) = hashed_vectors(["one two one"], 8)
        want = (unit(want).astype(np.float32) if normalize else want).tolist()
        assert got == {1: want, 2: [0.0] * 8, 3: [0.0] * 8}
    assert rows.where("i > 5").select(dense_hash(8)("t")).collect() == []
