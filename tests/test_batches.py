"""Landing batches that are lost half-way: nothing partial is read, nothing is lost, nothing lands twice."""

import json
import threading

import pytest

from strandline.plans import landing
from strandline.sources import batches

from .wavs import make_wav, tone


def fill(source):
    source.mkdir(exist_ok=True)
    (source / "a.csv").write_text("Id,V\n1,x\n2,y\n")
    (source / "t.txt").write_text("h\nc\n")
    (source / "s.wav").write_bytes(make_wav(tone(800, 16_000)))
    (source / "bad.json").write_text("{")
    (source / "d.mp3").write_bytes(b"x")
    (source / "meta_unstructured_report_Nd_O_153000.json").write_text(json.dumps({"camera_id": "Nd_O", "avg_per_frame": {"Bike": 1.5}}))


@pytest.fixture
def zone(tmp_path):
    fill(tmp_path / "in")
    return tmp_path


def land(spark, zone, **options):
    return landing.land_available(spark, str(zone / "in"), str(zone / "lake"), str(zone / "ck"), archive=str(zone / "old"), **options)


def names(folder):
    return sorted(p.name for p in folder.rglob("*") if p.is_file() and not p.name.startswith(".")) if folder.exists() else []


def landed(spark, zone):
    out = {}
    for kind in landing.TABLES:
        rows = landing.read_landed(spark, str(zone / "lake"), kind)
        if rows is not None:
            out[kind] = rows.count()
    return out


ALL = {"text": 1, "audio": 1, "camera_report": 1, "structured_csv": 2}
MOVED = sorted(["a.csv", "t.txt", "s.wav", "meta_unstructured_report_Nd_O_153000.json"])


def check_done(spark, zone):
    assert landed(spark, zone) == ALL
    assert names(zone / "old") == MOVED and names(zone / "in") == ["bad.json", "d.mp3"]
    files = names(zone / "lake" / "persistent_landing")
    assert files.count("t.txt") == files.count("s.wav") == files.count("metadata_t.json") == 1 and "bad.json" not in files


def test_move_and_archive(spark, zone):
    summary = {r["kind"]: (r["seen"], r["processed"], r["failed"]) for r in land(spark, zone).collect()}
    assert summary["text"] == (1, 1, 0) and summary["semi_structured"] == (1, 0, 1) and summary["skipped"] == (1, 0, 1)
    check_done(spark, zone)
    # a path that has landed does not land again; a new one of the same name replaces no archived file
    (zone / "in" / "t.txt").write_text("h2\nc2\n")
    (zone / "in" / "sub").mkdir()
    (zone / "in" / "sub" / "a.csv").write_text("Id,W\n3,z\n")
    land(spark, zone)
    assert landed(spark, zone) == {**ALL, "structured_csv": 3} and names(zone / "old").count("a.csv") == 2
    assert "t.txt" in names(zone / "in")


def fails(*_, **__):
    raise RuntimeError("lost here")


def test_failure_half_way_takes_all_back(spark, zone, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(landing, "_csv_layouts", fails)  # text, audio and reports are written by then
        with pytest.raises(Exception, match="lost here"):
            land(spark, zone)
    assert landed(spark, zone) == {} and names(zone / "old") == []
    assert len(names(zone / "in")) == 6 and names(zone / "lake" / "persistent_landing") == []
    land(spark, zone)
    check_done(spark, zone)


def test_a_killed_process_leaves_nothing_readable(spark, zone, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(landing, "_csv_layouts", fails)
        plain = batches.BatchLog.roll_back
        broken.setattr(batches.BatchLog, "roll_back", lambda self, n: plain(self, n) if not names(zone / "lake" / "persistent_landing") else None)
        with pytest.raises(Exception, match="lost here"):
            land(spark, zone)
    assert names(zone / "lake" / "persistent_landing")  # partial rows are on disk
    assert landed(spark, zone) == {} and len(names(zone / "in")) == 6
    log = landing.batch_log(spark, str(zone / "lake"))
    assert log.recover(str(zone / "in"), str(zone / "old")) == {"finished": [], "rolled_back": [0]}
    assert names(zone / "lake" / "persistent_landing") == []
    land(spark, zone)
    check_done(spark, zone)


@pytest.mark.parametrize("step", ["move_files", "create_once"])
def test_lost_after_the_commit(spark, zone, monkeypatch, step):
    plain = getattr(batches, step)

    def once_committed(*args):
        if step == "move_files" or str(args[1]).endswith("finished"):
            fails()
        return plain(*args)

    with monkeypatch.context() as broken:
        broken.setattr(batches, step, once_committed)
        with pytest.raises(Exception, match="lost here"):
            land(spark, zone)
    assert landed(spark, zone) == ALL  # committed rows count already
    land(spark, zone)
    check_done(spark, zone)


def test_a_committed_batch_is_not_taken_back(spark, zone):
    land(spark, zone)
    log = landing.batch_log(spark, str(zone / "lake"))
    with pytest.raises(ValueError, match="committed"):
        log.roll_back(0)
    assert log.recover(str(zone / "in"), None) == {"finished": [], "rolled_back": []}


def test_move_of_a_missing_file(spark, tmp_path):
    df = spark.createDataFrame([("b [1]/{c}*.txt",)], "name string")
    folders = (str(tmp_path / "x"), str(tmp_path / "y"))
    with pytest.raises(Exception, match="neither"):
        batches.move_files(df, "name", *folders)
    (tmp_path / "x" / "b [1]").mkdir(parents=True)
    (tmp_path / "x" / "b [1]" / "{c}*.txt").write_text("1")
    batches.move_files(df, "name", *folders)
    batches.move_files(df, "name", *folders)
    assert names(tmp_path / "x") == [] and (tmp_path / "y" / "b [1]" / "{c}*.txt").read_text() == "1"


def test_tasks_share_the_listing_of_a_batch(spark, tmp_path, monkeypatch):
    from strandline.plans import landing as flow

    source, seen = tmp_path / "temporal_landing", []
    source.mkdir()
    (source / "a.txt").write_text("x")
    land = flow.land_batch
    monkeypatch.setattr(flow, "land_batch", lambda batch, *rest: (seen.append(int(batch.sparkSession.conf.get(flow.LISTING))), land(batch, *rest))[1])
    before = spark.conf.get(flow.LISTING)
    flow.land_available(spark, str(source), str(tmp_path / "lake"), str(tmp_path / "check"))
    assert seen == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(flow.LISTING) == before


def test_a_batch_takes_few_jobs(spark, zone):
    for i in range(60):
        (zone / "in" / f"n{i}.txt").write_text(f"h{i}\nc\n")
    for name in ("a.csv", "s.wav", "bad.json", "meta_unstructured_report_Nd_O_153000.json"):
        (zone / "in" / name).unlink()
    count = spark._jsc.sc().dagScheduler().numTotalJobs
    before = count()
    land(spark, zone, max_files=20)
    # 4 batches; each took 15 jobs where every step scanned its files anew
    assert count() - before <= 4 * 13
    assert landed(spark, zone) == {"text": 61} and len(names(zone / "old")) == 61 and names(zone / "in") == ["d.mp3"]
    for i in range(60):
        path = zone / "lake" / "persistent_landing" / "unstructured" / "text"
        assert (path / "data" / f"n{i}.txt").read_text() == f"h{i}\nc\n" and (path / "metadata" / f"metadata_n{i}.json").exists()


def test_files_move_beside_the_next_batch(spark, zone, monkeypatch):
    begun, plain_land, plain_finish = [threading.Event(), threading.Event()], landing._land_files, batches.BatchLog.finish

    def land_files(batch, batch_id, *rest):
        if batch_id < 2:
            begun[batch_id].set()
        return plain_land(batch, batch_id, *rest)

    def finish(self, batch_id, *rest):
        if batch_id == 0 and not begun[1].wait(60):
            raise TimeoutError("the next batch waits for the moves")
        plain_finish(self, batch_id, *rest)

    monkeypatch.setattr(landing, "_land_files", land_files)
    monkeypatch.setattr(batches.BatchLog, "finish", finish)
    land(spark, zone, max_files=3)
    check_done(spark, zone)


@pytest.mark.parametrize("lost", [0, 1])
def test_lost_moves_beside_the_next_batch_end_the_run(spark, zone, monkeypatch, lost):
    plain = batches.BatchLog.finish
    with monkeypatch.context() as broken:
        broken.setattr(batches.BatchLog, "finish", lambda self, n, *rest: fails() if n == lost else plain(self, n, *rest))
        with pytest.raises(Exception, match="lost here"):
            land(spark, zone, max_files=3)
    land(spark, zone, max_files=3)
    check_done(spark, zone)
