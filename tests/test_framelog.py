"""The log source: whole lines only, each once, over pieces, growth and restarts."""

import io
import random

import pytest
from pyspark.errors import StreamingQueryException

from strandline.sources import framelog
from strandline.sources.framelog import LogReader, Piece, log_frames


def lines_of(data, start, stop, size, segment="s"):
    """(position, value) of all pieces of a range."""
    out = []
    for at in range(start, stop, size):
        for batch in framelog._lines(io.BytesIO(data), Piece(segment, at, min(at + size, stop), stop)):
            out += zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
    return out


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_pieces_yield_each_line_once(monkeypatch, block):
    monkeypatch.setattr(framelog, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(150):
        data = b"".join(rng.choice([b"\n", b"a\n", "é\r\n".encode(), b"\xff\n", b"long" * rng.randint(1, 9) + b"\n"]) for _ in range(rng.randint(0, 12)))
        want, at = [], 0
        for line in data.split(b"\n")[:-1]:
            if line.strip(b"\r"):
                want.append((at, line.removesuffix(b"\r").decode("utf-8", "replace")))
            at += len(line) + 1
        assert lines_of(data, 0, len(data), rng.randint(1, 20)) == want
        starts = [0, *(i + 1 for i, b in enumerate(data) if b == 10)]
        cut = rng.choice(starts)  # a trigger that ended there
        assert lines_of(data, 0, cut, 5) + lines_of(data, cut, len(data), 5) == want


@pytest.mark.parametrize("block", [2, 1 << 20])
def test_offsets_stop_at_the_last_break(tmp_path, monkeypatch, block):
    monkeypatch.setattr(framelog, "BLOCK", block)
    reader = LogReader(str(tmp_path), 4)
    assert reader.initialOffset() == {} and reader.latestOffset() == {}
    (tmp_path / "a").write_bytes(b"one\ntwo\nthr")
    (tmp_path / "_hidden").write_bytes(b"x\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b").write_bytes(b"unfinished")
    first = reader.latestOffset()
    assert first == {"a": 8, "sub/b": 0}
    (tmp_path / "a").write_bytes(b"one\ntwo\nthree\n")
    later = LogReader(str(tmp_path), 4).latestOffset()
    assert later == reader.latestOffset() == {"a": 14, "sub/b": 0}
    assert [(p.start, p.end, p.stop) for p in reader.partitions(first, later)] == [(8, 12, 14), (12, 14, 14)]
    (tmp_path / "a").write_bytes(b"one\n")
    with pytest.raises(ValueError, match="were read"):
        reader.partitions(later, reader.latestOffset())
    (tmp_path / "a").unlink()
    assert reader.partitions(later, reader.latestOffset()) == []


def drain(spark, log, out, checkpoint, piece=7):
    query = log_frames(spark, str(log), piece).writeStream.option("checkpointLocation", str(checkpoint)).format("parquet")
    query.trigger(availableNow=True).start(str(out)).awaitTermination()
    return sorted((r["segment"], r["position"], r["value"]) for r in spark.read.schema(framelog.SCHEMA).parquet(str(out)).collect())


def test_growth_and_restart(spark, tmp_path):
    log, out, checkpoint = tmp_path / "log", tmp_path / "out", tmp_path / "checkpoint"
    log.mkdir()
    (log / "a").write_bytes(b"first\nsecond message\nhal")
    assert drain(spark, log, out, checkpoint) == [("a", 0, "first"), ("a", 6, "second message")]
    with open(log / "a", "ab") as segment:
        segment.write(b"f\n\nlast\n")
    (log / "b").write_bytes(b"other\n")
    want = [("a", 0, "first"), ("a", 6, "second message"), ("a", 21, "half"), ("a", 27, "last"), ("b", 0, "other")]
    assert drain(spark, log, out, checkpoint) == want
    assert drain(spark, log, out, checkpoint) == want  # nothing new


def test_a_lost_batch_is_read_again(spark, tmp_path):
    """A query that dies inside its batch repeats the same range after a restart, though the log has grown."""
    log, checkpoint, got, fail = tmp_path / "log", tmp_path / "checkpoint", {}, [True]
    log.mkdir()
    (log / "a").write_bytes(b"one\ntwo\n")

    def save(batch, batch_id):
        got[batch_id] = sorted(r["value"] for r in batch.collect())
        if fail.pop() if fail else False:
            raise RuntimeError("lost")

    def run():
        log_frames(spark, str(log)).writeStream.option("checkpointLocation", str(checkpoint)).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert got == {0: ["one", "two"]}
    got.clear()
    with open(log / "a", "ab") as segment:
        segment.write(b"three\n")
    run()
    run()
    assert got == {0: ["one", "two"], 1: ["three"]}
