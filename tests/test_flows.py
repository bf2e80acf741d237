import pytest

from strandline.session import checkpoint_root
from strandline.sources import writers
import json

import numpy as np

from strandline.plans import unstructured as flow
from strandline.sources.readers import read_split
from strandline.sources.writers import latest_snapshot
from tests.wavs import make_wav, tone


def test_text_flow(spark, tmp_path):
    source, trusted, out = tmp_path / "in", str(tmp_path / "trusted"), str(tmp_path / "out")
    (source / "deep").mkdir(parents=True)
    (source / "a.txt").write_text("Big  News\r\nPolitics\r\n\r\n\r\n\tA. Uthor \r\n2024\r\nShort story\r\nhttp://x\r\n")
    (source / "deep" / "b.txt").write_bytes("Caf\xe9\nTech".encode("latin-1"))
    (source / "blank.txt").write_text(" \n\t\n")
    counts = {r["reason"]: r["row_count"] for r in flow.trust_texts(spark, str(source), trusted, files=True).collect()}
    assert counts == {"accepted": 2, "empty_file": 1}
    assert (tmp_path / "trusted" / "data" / "a.txt").read_text() == "big news\npolitics\n\na. uthor\n2024\nshort story\nhttp://x\n"
    assert (tmp_path / "trusted" / "data" / "deep" / "b.txt").read_text() == "café\ntech\n"
    assert (tmp_path / "trusted" / "skipped" / "blank.txt").exists()
    accepted, skipped = read_split(spark, f"{trusted}/table")
    assert accepted.filter("raw is not null").isEmpty() and skipped.count() == 1
    top = [tuple(r) for r in flow.exploit_texts(spark, trusted, out, files=True).collect()]
    assert top == [("POLITICS", 1), ("TECH", 1)]
    stored = {r["filename"]: r for r in spark.read.parquet(latest_snapshot(spark, f"{out}/vectors")).collect()}
    a = stored["a.txt"]
    assert (a["headline"], a["authors"], a["pub_date"], a["content_preview"]) == ("big news", "a. uthor", "2024", "big news short story")
    assert len(a["embedding"]) == 128 and abs(np.linalg.norm(a["embedding"]) - 1) < 1e-6
    # A second run replaces rows instead of repeating them.
    flow.exploit_texts(spark, trusted, out)
    again = latest_snapshot(spark, f"{out}/vectors")
    assert again.endswith("v=00000002") and spark.read.parquet(again).count() == 2


def test_audio_flow(spark, tmp_path):
    source, trusted, out = tmp_path / "in", str(tmp_path / "trusted"), str(tmp_path / "out")
    source.mkdir()
    (source / "ok.wav").write_bytes(make_wav(tone(8_000, 8_000), 8_000))
    (source / "short.wav").write_bytes(make_wav(tone(100, 8_000), 8_000))
    (source / "bad.wav").write_bytes(b"RIFF")
    counts = {r["reason"]: r["row_count"] for r in flow.trust_audio(spark, str(source), trusted, files=True).collect()}
    assert counts == {"accepted": 1, "too_short_0.013s": 1, "corrupted_wav": 1} or counts == {
        "accepted": 1, "too_short_0.012s": 1, "corrupted_wav": 1,
    }
    assert (tmp_path / "trusted" / "skipped" / "bad.wav").read_bytes() == b"RIFF"
    assert {r["reason"]: r["row_count"] for r in flow.exploit_audio(spark, trusted, out).collect()} == {"accepted": 1}
    row = spark.read.parquet(latest_snapshot(spark, f"{out}/vectors")).first()
    assert (row["filename"], row["sample_rate"], row["num_channels"], len(row["embedding"])) == ("ok.wav", 16_000, 1, 64)


def test_article_fields_shift_unless_positional(spark):
    from strandline.operators.embed import article_fields

    df = spark.createDataFrame([("h\nc\n\n2024\nd\n",), ("",)], "text string")
    first, empty = article_fields(df, "text").collect()
    assert (first["authors"], first["pub_date"], first["category"]) == ("2024", "d", "C")
    assert (empty["category"], empty["content_preview"], empty["word_count"]) == ("UNKNOWN", "", 0)
    placed = article_fields(df, "text", positional=True).first()
    assert (placed["authors"], placed["pub_date"], placed["short_description"]) == ("", "2024", "d")


def test_preview_falls_back_to_the_text(spark):
    from strandline.operators.embed import embed_articles

    rows = embed_articles(spark.createDataFrame([("x",), (None,), ("",)], "text string")).collect()
    assert rows[0]["embedding"] and rows[0]["error"] is None
    assert rows[1]["embedding"] is None and rows[1]["error"] == "no content"
    assert set(rows[2]["embedding"]) == {0.0}


def test_metadata_files(spark, tmp_path):
    from strandline.sources.writers import write_metadata_files

    df = spark.createDataFrame([("m/a.json", 1, None)], "metadata_destination string, n int, missing string")
    write_metadata_files(df, str(tmp_path))
    assert json.loads((tmp_path / "m" / "a.json").read_text()) == {"n": 1, "missing": None}


def test_rerun_leaves_no_old_rows_and_equal_names_stay_apart(spark, tmp_path):
    source, trusted, out = tmp_path / "in", str(tmp_path / "trusted"), str(tmp_path / "out")
    for folder in ("p", "q"):
        (source / folder).mkdir(parents=True)
        (source / folder / "a.txt").write_text(f"{folder} news\nTech\n")
    (source / "blank.txt").write_text(" \n")
    assert {r["reason"] for r in flow.trust_texts(spark, str(source), trusted).collect()} == {"accepted", "empty_file"}
    (source / "blank.txt").unlink()
    assert {r["reason"]: r["row_count"] for r in flow.trust_texts(spark, str(source), trusted).collect()} == {"accepted": 2}
    flow.exploit_texts(spark, trusted, out).collect()
    flow.exploit_texts(spark, trusted, out).collect()
    stored = writers.read_vectors(spark, f"{out}/vectors", "relative")
    assert sorted(r["relative"] for r in stored.collect()) == ["p/a.txt", "q/a.txt"]


def test_long_keys_stay_two_rows(spark, tmp_path):
    keys = ["k" * 600 + "1", "k" * 600 + "2"]
    df = spark.createDataFrame([(k, [1.0], k) for k in keys], "filename string, embedding array<float>, headline string")
    for clip, kept in ((False, 601), (True, 512)):
        path = writers.upsert_vectors(df, str(tmp_path / f"v{clip}"), 1, clip=clip)
        rows = spark.read.parquet(path).collect()
        assert sorted(r["filename"] for r in rows) == keys and {len(r["headline"]) for r in rows} == {kept}


def test_paths_of_object_stores():
    assert writers.arrow_uri("s3a://b/k") == "s3://b/k" and writers.arrow_uri("file:/x") == "file:///x" and writers.arrow_uri("/x") == "/x"


def test_scratch_needs_a_shared_folder():
    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
