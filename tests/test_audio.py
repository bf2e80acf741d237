import numpy as np
import pytest

from strandline.functions import audio
from strandline.operators import embed
from tests.wavs import make_wav, resample_slowly, samples_of, tone


@pytest.mark.parametrize("rate", [8_000, 11_025, 16_000, 22_050, 44_100, 48_000])
def test_resample_against_a_plain_loop(rate):
    x = tone(700, rate) + [-1, 0, 1, -32768, 32767]
    assert audio.resample(np.array(x), rate).tolist() == (x if rate == 16_000 else resample_slowly(x, rate, 16_000))


def test_sample_widths():
    assert audio.to_int16(bytes([0, 128, 255]), 1).tolist() == [-32768, 0, 32512]
    assert audio.to_int16(bytes([255, 1]), 1, eight_bit_signed=True).tolist() == [-256, 256]
    assert audio.to_int16(b"\x00\x01\x02\xff\xff\xff", 3).tolist() == [0x0201, -1]
    assert audio.to_int16((65_536 * 5).to_bytes(4, "little"), 4).tolist() == [5]
    assert audio.to_mono(np.array([1, 2, -1, -2, 9, 10]), 2).tolist() == [1, -2, 9]
    assert audio.to_mono(np.array([3, 6, 9]), 3).tolist() == [6]


def files(spark):
    one = tone(16_000, 16_000)
    rows = {
        "mono16": make_wav(one),
        "stereo": make_wav([v for s in one for v in (s, -s)], channels=2),
        "eight": make_wav([s // 256 for s in tone(8_000, 8_000)], 8_000, 1),
        "short": make_wav(one[:6_400]),
        "half": make_wav(one[:8_000]),
        "long": make_wav(tone(31 * 8_000, 8_000), 8_000),
        "cut": make_wav(one)[:20],
        "junk": b"not a wav",
        "empty": b"",
    }
    return spark.createDataFrame([(k, bytearray(v)) for k, v in rows.items()], "filename string, raw binary"), rows


def test_clean_audio(spark):
    df, rows = files(spark)
    got = {r["filename"]: r for r in embed.clean_audio(df).collect()}
    assert {k: r["skip_reason"] for k, r in got.items() if r["skip_reason"]} == {
        "short": "too_short_0.400s",
        "cut": "corrupted_wav",
        "junk": "corrupted_wav",
        "empty": "corrupted_wav",
    }
    for k in ("mono16", "stereo", "eight", "half", "long"):
        params, _ = samples_of(bytes(got[k]["cleaned"]))
        assert (params.nchannels, params.sampwidth, params.framerate) == (1, 2, 16_000)
    assert bytes(got["mono16"]["cleaned"]) == rows["mono16"]
    assert set(samples_of(bytes(got["stereo"]["cleaned"]))[1]) <= {0, -1}


def test_headers(spark):
    df, _ = files(spark)
    got = {r["filename"]: r["h"] for r in df.select("filename", embed.wav_header("raw").alias("h")).collect()}
    assert got["stereo"].asDict() == {
        "sample_rate_hz": 16_000, "channels": 2, "sample_width_bytes": 2, "frame_count": 16_000,
        "duration_seconds": 1.0, "is_valid_wav": True,
    }
    assert got["junk"]["is_valid_wav"] is False and got["junk"]["channels"] is None


def test_audio_embedding(spark):
    df, rows = files(spark)
    cleaned = embed.clean_audio(df).filter("skip_reason is null").select("filename", "cleaned")
    got = {r["filename"]: r for r in embed.embed_audio(cleaned, "cleaned").collect()}
    assert got["long"]["duration_s"] == pytest.approx(31.0, abs=1e-3)
    assert got["stereo"]["embedding"] == [0.0] * 64  # opposite channels cancel out
    for r in got.values():
        assert len(r["embedding"]) == 64
    for r in (got[k] for k in ("mono16", "eight", "half", "long")):
        assert np.linalg.norm(r["embedding"]) == pytest.approx(1.0, abs=1e-5)
    # The whole clip is described, or its first seconds where asked for.
    _, x = samples_of(audio.clean_wav(rows["long"])[0])
    cut = {r["filename"]: r for r in embed.embed_audio(cleaned, "cleaned", max_seconds=30).collect()}
    for vector, samples in ((got["long"]["embedding"], x), (cut["long"]["embedding"], x[: 30 * 16_000])):
        described = audio.window_moments(np.array(samples) / 32768.0)
        assert np.allclose(vector, described / np.linalg.norm(described), atol=1e-6)
    broken = embed.embed_audio(df.filter("filename = 'junk'")).first()
    assert broken["embedding"] is None and broken["error"]


def test_window_moments_edge_cases():
    assert audio.window_moments(np.zeros(5)).tolist() == [0.0] * 64
    short = audio.window_moments(np.array([1.0, -1.0]))
    assert short[:3].tolist() == [1.0, 1.0, 0.0] and short[48:].tolist() == [0.0] * 16
    alternating = audio.window_moments(np.tile([1.0, -1.0], 32))
    assert alternating[48:].tolist() == [1.0] * 16 and alternating[32:48].tolist() == [1.0] * 16


def test_window_features_run_once_per_row(spark, table):
    from strandline.plans.catalog import exploitation

    plan = exploitation.window_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_files_reach_workers_in_small_lots(spark):
    # an Arrow batch is 10,000 files, however heavy
    files = spark.createDataFrame([("a.wav", b"x")], "object_name string, raw binary")
    for rows in (embed.embed_audio(files), embed.clean_audio(files), files.select(embed.wav_header("raw"))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
