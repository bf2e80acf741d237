import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import landing
from strandline.plans.landing import land_available
from strandline.sources import readers, writers
from tests.wavs import make_wav, tone

P = "persistent_landing/"


def test_routes(spark):
    names = {
        "temporal_landing/a.csv": ("structured_csv", None, None),
        "temporal_landing/sub/A.CSV": ("structured_csv", None, None),
        "temporal_landing/x.json": ("semi_structured", P + "semi_structured/data/x.json", P + "semi_structured/metadata/metadata_x.json"),
        "temporal_landing/meta_unstructured_report_Nd_O_153000.json": (
            "camera_report",
            P + "unstructured/images/metadata/Nd_O/meta_unstructured_report_Nd_O_153000.json",
            None,
        ),
        "temporal_landing/b.v2.WAV": ("audio", P + "unstructured/audio/data/b.v2.WAV", P + "unstructured/audio/metadata/metadata_b.v2.json"),
        "temporal_landing/c.txt": ("text", P + "unstructured/text/data/c.txt", P + "unstructured/text/metadata/metadata_c.json"),
        "temporal_landing/sub/c.txt": ("skipped", None, None),
        "temporal_landing/sub\\c.txt": ("skipped", None, None),
        "temporal_landing/d.mp3": ("skipped", None, None),
        "temporal_landing/.txt": ("skipped", None, None),
    }
    listing = spark.createDataFrame([(n,) for n in [*names, "temporal_landing/", "temporal_landing/dir/"]], "object_name string")
    got = {r[0]: tuple(r)[1:] for r in landing.route_objects(listing).collect()}
    assert got == names


def test_land_new_keeps_one_path_per_name(spark):
    listing = spark.createDataFrame([(p,) for p in ("b/x.txt", "a/x.txt", "a/y.txt", "z.txt")], "object_name string")
    landed = spark.createDataFrame([("old/y.txt",), ("older/y.txt",)], "object_name string")
    assert sorted(r[0] for r in landing.land_new(listing, landed).collect()) == ["a/x.txt", "z.txt"]


def test_first_n_files(spark):
    listing = spark.createDataFrame([(p,) for p in ("b.wav", "a.WAV", "c.txt", "d.wav")], "object_name string")
    assert [r[0] for r in landing.first_n_files(listing, [".wav"], 2).collect()] == ["a.WAV", "b.wav"]


def with_routes(spark, name, content):
    df = spark.createDataFrame([(name, content)], "object_name string, content binary")
    return landing.route_objects(df)


def test_weather_file_metadata(spark):
    doc = {
        "metadata": {"endpoint": "forecast", "location": {"name": "q", "lat": 1.5}},
        "data": {"geometry": {"type": "Point"}, "properties": {"validTimes": "a/b/c", "units": "us", "periods": [{}, {}]}},
    }
    raw = json.dumps(doc).encode()
    row = landing.weather_file_metadata(with_routes(spark, "temporal_landing/x.json", bytearray(raw))).first()
    file, about, quality = row["file_metadata"], row["content_metadata"], row["quality_metadata"]
    assert (file["file_name"], file["file_size_bytes"], file["checksum_sha256"]) == ("x.json", len(raw), hashlib.sha256(raw).hexdigest())
    assert (about["granularity"], about["valid_from"], about["valid_duration"], about["periods_count"]) == ("daily", "a", "b/c", 2)
    assert quality["has_required_fields"] and quality["missing_fields"] == [] and quality["has_periods"]
    assert row["source_metadata"]["location"]["lat"] == 1.5 and row["error"] is None


@pytest.mark.parametrize(
    "doc, missing",
    [
        ({}, ["metadata", "data", "data.properties"]),
        ({"metadata": None, "data": {"properties": {}}}, ["metadata", "data.properties"]),
        ({"metadata": {}, "data": {"properties": {"periods": None}}}, ["data.properties.periods"]),
        ({"metadata": {}, "data": {"properties": {"periods": {"a": 1}}}}, ["data.properties.periods"]),
    ],
)
def test_weather_missing_fields(spark, doc, missing):
    df = with_routes(spark, "temporal_landing/x.json", bytearray(json.dumps(doc).encode()))
    assert landing.weather_file_metadata(df).first()["quality_metadata"]["missing_fields"] == missing


def test_broken_weather_file_is_isolated(spark):
    row = landing.weather_file_metadata(with_routes(spark, "temporal_landing/x.json", bytearray(b"{"))).first()
    assert row["error"] == "invalid_json" and row["file_metadata"] is None


def test_text_file_metadata(spark):
    text = "Head\r\n\n cat \nauthors date\n"
    row = landing.text_file_metadata(with_routes(spark, "temporal_landing/000001.txt", bytearray(text.encode()))).first()
    about, quality = row["content_metadata"], row["quality_metadata"]
    assert (about["headline"], about["category"], about["published_date"]) == ("Head", "cat", "date")
    assert (about["line_count"], about["non_empty_line_count"], about["word_count"]) == (5, 4, 4)
    assert about["character_count"] == len(text) and about["headline_length_chars"] == 4
    assert quality["missing_fields"] == ["short_description", "source_url"] and not quality["has_minimum_expected_lines"]
    assert row["source_metadata"]["record_id"] == "000001"
    bad = landing.text_file_metadata(with_routes(spark, "temporal_landing/b.txt", bytearray(b"a\xff"))).first()
    assert bad["quality_metadata"]["is_utf8_decodable"] is False and bad["content_metadata"]["character_count"] == 2
    empty = landing.text_file_metadata(with_routes(spark, "temporal_landing/e.txt", bytearray(b""))).first()
    assert empty["quality_metadata"]["is_empty_file"] and empty["content_metadata"]["line_count"] == 0


def test_flatten(spark):
    df = spark.sql("select struct(struct(1 as b, array('x', 'y') as c) as a, null as n) as p, 2 as q")
    flat = landing.flatten(df)
    assert flat.columns == ["p.a.b", "p.a.c", "p.n", "q"]
    assert tuple(flat.first()) == (1, '["x","y"]', None, 2) and flat.schema["p.n"].dataType.simpleString() == "string"


def test_csv_scan(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir()
    two.mkdir()
    (one / "a.csv").write_text(' CRASH DATE ,Zip\n01/02/2024,NA\n,"a ""q"" b"\n')
    (one / "b.csv").write_text(" CRASH DATE ,Zip\n")
    (two / "c.csv").write_text("Zip,Extra\n10001,x\n")
    rows = readers.read_csv_strings(spark, str(one), str(two))
    assert rows.columns == ["crash_date", "zip", "source_file", "extra"]
    assert set(dict(rows.drop("source_file").dtypes).values()) == {"string"}
    assert {tuple(r) for r in rows.select("crash_date", "zip", "extra").collect()} == {
        ("01/02/2024", None, None), (None, 'a "q" b', None), (None, "10001", "x"),
    }
    assert {r["row_count"] for r in landing.part_counts(rows).collect()} == {1, 2}


def test_json_lines(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"headline": " H "}\n\n{"headline": null, "link": "u"}\n')
    bad.write_text('{"headline": "x"}\n\n{oops\n')
    rows = readers.read_json_lines(spark, str(good))
    assert [(r["line_number"], r["headline"], r["link"]) for r in rows.orderBy("line_number").collect()] == [(1, " H ", None), (3, None, "u")]
    assert readers.read_json_lines(spark, str(good), limit=1).count() == 1
    with pytest.raises(Exception, match=r"invalid JSON in .*bad\.jsonl at line 3"):
        readers.read_json_lines(spark, str(bad)).collect()
    from strandline.functions.text import format_article

    assert rows.orderBy("line_number").select(format_article()).first()[0] == "H\n\n\n\n\n\n"


def test_line_numbers_across_blocks(spark, tmp_path):
    path = tmp_path / "many.jsonl"
    path.write_text("".join(json.dumps({"link": str(i)}) + "\n" for i in range(1, 5001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_json_lines(spark, str(path))
        assert rows.filter(F.col("line_number") != F.col("link").cast("bigint")).isEmpty() and rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_binary_scan_and_listing(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.txt").write_bytes(b"abc")
    (tmp_path / "b.wav").write_bytes(b"x")
    rows = readers.read_binary(spark, str(tmp_path), "*.txt").collect()
    assert [(r["filename"], bytes(r["raw"])) for r in rows] == [("a.txt", b"abc")]
    listing = readers.list_objects(spark, str(tmp_path))
    assert sorted(r["length"] for r in listing.collect()) == [1, 3]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()


def test_sinks(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    writers.write_parts(df, str(tmp_path / "parts"), 50)
    assert max(r["row_count"] for r in landing.part_counts(readers.read_csv_strings(spark, str(tmp_path / "parts"))).collect()) <= 50
    assert writers.write_rejects(df.limit(0), str(tmp_path / "rej")) is None
    assert spark.read.option("header", True).csv(writers.write_rejects(df, str(tmp_path / "rej"))).count() == 1000
    writers.write_split(df, F.col("k") == 0, str(tmp_path / "split"))
    kept, rest = readers.read_split(spark, str(tmp_path / "split"))
    assert (kept.count(), rest.count(), kept.columns) == (334, 666, ["id", "k"])
    writers.write_files(df.limit(3).select(F.concat(F.lit("d/"), F.col("id").cast("string")).alias("n"), F.lit("x").alias("c")), str(tmp_path / "files"), "n", "c")
    assert sorted(p.name for p in (tmp_path / "files" / "d").iterdir()) == ["0", "1", "2"]
    df.write.parquet(str(tmp_path / "t"))
    writers.truncate_table(spark, str(tmp_path / "t"))
    left = spark.read.parquet(str(tmp_path / "t"))
    assert left.count() == 0 and left.columns == ["id", "k"]


def test_vector_upsert_and_dimension_change(spark, tmp_path):
    path = str(tmp_path / "vectors")
    schema = "filename string, embedding array<float>, headline string"
    first = spark.createDataFrame([("a", [1.0, 0.0], "é" * 400), ("b", [0.0, 1.0], "x")], schema)
    writers.upsert_vectors(first, path, 2)
    second = spark.createDataFrame([("b", [1.0, 1.0], "y"), ("c", [0.0, 1.0], None)], schema)
    got = {r["filename"]: r for r in spark.read.parquet(writers.upsert_vectors(second, path, 2)).collect()}
    assert set(got) == {"a", "b", "c"} and got["b"]["embedding"] == [1.0, 1.0]
    assert len(got["a"]["headline"].encode()) == 800 and got["c"]["headline"] is None
    increment = spark.createDataFrame([("c", [9.0, 9.0], "w"), ("d", [0.0, 1.0], "v")], schema)
    assert writers.upsert_vectors(increment, path, 2, compact=False).endswith("d=00000003")
    merged = {r["filename"]: r["embedding"] for r in writers.read_vectors(spark, path).collect()}
    assert set(merged) == {"a", "b", "c", "d"} and merged["c"] == [9.0, 9.0]
    third = spark.createDataFrame([("z", [1.0, 0.0, 0.0], "n")], schema)
    writers.upsert_vectors(third, path, 3)
    assert [r["filename"] for r in writers.read_vectors(spark, path).collect()] == ["z"]


def test_landing_flow(spark, tmp_path):
    source, root = tmp_path / "temporal", tmp_path / "lake"
    (source / "nested").mkdir(parents=True)
    root.mkdir()
    (source / "a.csv").write_text("Id,V\n1,x\n2,y\n")
    (source / "nested" / "b.csv").write_text("Id,W\n3,z\n")
    (source / "w.json").write_text(json.dumps({"metadata": {}, "data": {"properties": {"periods": [1]}}}))
    (source / "bad.json").write_text("{")
    (source / "t [1]{a}*.txt").write_text("h\nc\n")
    (source / "s.wav").write_bytes(make_wav(tone(800, 16_000)))
    (source / "meta_unstructured_report_Nd_O_153000.json").write_text(json.dumps({"camera_id": "Nd_O", "avg_per_frame": {"Bike": 1.5}}))
    (source / "d.mp3").write_bytes(b"x")
    args = (spark, str(source), str(root), str(tmp_path / "ck"))
    summary = {r["kind"]: (r["seen"], r["processed"], r["failed"]) for r in land_available(*args, max_files=5).collect()}
    assert summary == {
        "structured_csv": (2, 2, 0), "semi_structured": (2, 1, 1), "text": (1, 1, 0), "audio": (1, 1, 0),
        "camera_report": (1, 1, 0), "skipped": (1, 0, 1),
    }
    zone = root / "persistent_landing"
    rows = readers.read_table(spark, str(zone / "structured" / "delta")).collect()
    assert sorted((r["id"], r["v"], r["w"]) for r in rows if r["v"]) == [("1", "x", None), ("2", "y", None)] and len(rows) == 3
    assert (zone / "semi_structured" / "data" / "w.json").exists() and not (zone / "semi_structured" / "data" / "bad.json").exists()
    assert (zone / "unstructured" / "images" / "metadata" / "Nd_O" / "meta_unstructured_report_Nd_O_153000.json").exists()
    about = json.loads((zone / "unstructured" / "audio" / "metadata" / "metadata_s.json").read_text())
    assert about["content_metadata"]["frame_count"] == 800
    flat = readers.read_table(spark, str(zone / "unstructured" / "text" / "delta")).first()
    assert flat["content_metadata.headline"] == "h"
    # Nothing new: nothing lands twice. Then one more file.
    assert land_available(*args).count() == 0
    (source / "t2.txt").write_text("again")
    assert [tuple(r) for r in land_available(*args).collect()] == [("text", 1, 1, 0)]
    assert readers.read_table(spark, str(zone / "unstructured" / "text" / "delta")).count() == 2


def test_many_small_files_share_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for i in range(200 * cores):
        (tmp_path / f"{i}.txt").write_bytes(str(i).encode())
    rows = readers.read_binary(spark, str(tmp_path), "*.txt")
    assert rows.rdd.getNumPartitions() <= 4 * cores
    assert sorted(int(bytes(r["raw"])) for r in rows.collect()) == list(range(200 * cores))


def test_the_driver_holds_no_list_of_files(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.txt").write_bytes(str(i).encode())
    rows, listed = readers.read_binary(spark, str(tmp_path), "*.txt"), readers.list_objects(spark, str(tmp_path))
    # the plans read a stored listing, not the files
    assert len(rows.inputFiles()) < 10 and len(listed.inputFiles()) < 10
    assert rows.count() == listed.count() == 300


@pytest.mark.parametrize(("below", "glob"), [("", "*"), ("", "[!a]*.{txt,TXT}"), ("/sub", "?.*"), ("/a.txt", "*"), ("/*", "*.txt"), ("/.hid", "*"), ("/empty", "*")])
def test_files_are_those_of_sparks_scans(spark, tmp_path, below, glob):
    names = ["a.txt", "b c.txt", "t [1]{a}*.txt", "_x.txt", "_k=1.txt", ".h.txt", "e.txt", "u%20.txt", "é日.txt", "_metadata", "c._COPYING_", "#q?.txt", "sub/a.txt",
             "sub/_d/y.txt", "_metadata_dir/z.txt", "p=1/q.txt", ".hid/y.txt", "sub/deep/r.TXT", "n\nl.txt", "back\\s.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "e.txt" else name.encode())
    (tmp_path / "link.txt").symlink_to(tmp_path / "a.txt")
    (tmp_path / "empty").mkdir()
    path = f"{tmp_path}{below}"
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    want = sorted((r.path, r.length, bytes(r.content)) for r in scan.collect())
    assert sorted((r.object_name, r.length) for r in readers.list_objects(spark, path, glob).collect()) == [w[:2] for w in want]
    assert sorted((r.key, bytes(r.raw)) for r in readers.read_binary(spark, path, glob).collect()) == [(w[0], w[2]) for w in want]


def test_contents_are_read_in_bounded_lots(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "LOT_BYTES", 1000)
    for i in range(40):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (i * 20 + 1))
    (tmp_path / "link.bin").symlink_to(tmp_path / "gone.bin")
    rows = readers.read_binary(spark, str(tmp_path), "[0-9]*.bin")
    assert sorted((len(r["raw"]), bytes(r["raw"])[0]) for r in rows.collect()) == [(i * 20 + 1, i) for i in range(40)]
    (tmp_path / "7.bin").unlink()
    with pytest.raises(Exception, match="7.bin"):
        rows.collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_binary(spark, str(tmp_path / "none"))
