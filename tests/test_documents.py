import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import documents as docs
from strandline.operators.cleaning import reason_counts
from strandline.__main__ import STAGES, main, parser
from strandline.plans.documents import trust_weather


def forecast(name="harlem", periods=(), **extra):
    doc = {"metadata": {"location": {"name": name}, "endpoint": "forecast/hourly"}, "data": {"properties": {"periods": list(periods)}}}
    doc.update(extra)
    return json.dumps(doc)


FULL = {
    "startTime": "2024-01-02T03:00:00-05:00", "temperature": -5, "isDaytime": True, "windSpeed": "10 to 15 mph",
    "dewpoint": {"unitCode": "c", "value": 1.5}, "probabilityOfPrecipitation": {"value": 20}, "relativeHumidity": {"value": 55},
    "shortForecast": "Snow",
}


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    return docs.parse_documents(df, docs.WEATHER_SCHEMA)


def test_weather_rows(spark):
    sparse = {"temperature": 30, "windSpeed": "calm", "dewpoint": {"value": None}, "relativeHumidity": 7}
    parsed = parse(spark, [forecast(periods=[FULL, sparse]), forecast("riverdale", [{}]), "{broken", forecast("south_bronx")])
    rows = docs.weather_rows(docs.explode_periods(parsed)).collect()
    assert tuple(rows[0]) == ("MANHATTAN", "HARLEM", "2024-01-02", 5.0, True, 10, 1.5, 20, 55, "Snow")
    assert tuple(rows[1]) == ("MANHATTAN", "HARLEM", "", 30.0, False, None, 0.0, 0, 0, "")
    assert tuple(rows[2]) == ("UNKNOWN", "RIVERDALE", "", None, False, None, 0.0, 0, 0, "")
    assert len(rows) == 3
    assert docs.weather_rows(docs.explode_periods(parsed), signed=True).first()["temperature"] == -5.0
    assert {r["reason"]: r["row_count"] for r in reason_counts(parsed).collect()} == {"accepted": 3, "invalid_json": 1}


def test_camera_rows_and_report_table(spark):
    texts = [
        json.dumps({"camera_id": "Nd_O", "date": "2024-01-01", "avg_per_frame": {"LMV": 2, "e-Rickshaw": 0.5, "boat": 9}, "total_frames_processed": 4}),
        json.dumps({"camera_id": "sw_x"}),
        json.dumps({"avg_per_frame": {}}),
    ]
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "source_file string, content string")
    parsed = docs.parse_documents(df, docs.REPORT_SCHEMA)
    rows = docs.camera_rows(parsed).collect()
    first = rows[0].asDict()
    assert (first["LMV"], first["e-Rickshaw"], first["Bike"], first["borough"], first["camera_id_original"]) == (2.0, 0.5, 0.0, "MANHATTAN", "ND_O")
    assert "boat" not in first and rows[1]["borough"] == "UNKNOWN" and rows[1]["total_frames_processed"] == 0
    table = docs.report_table(parsed)
    assert table.columns == ["camera_id", "timestamp", "total_frames", "source_file", "LMV", "boat", "e-Rickshaw"]
    assert [r["camera_id"] for r in table.collect()] == ["Nd_O", "sw_x", "unknown_camera"]
    with pytest.raises(ValueError, match="labels"):
        docs.report_labels(parsed, "doc.avg_per_frame", max_labels=2)


def test_annotations_and_folders(spark):
    text = json.dumps({"shapes": [{"label": "car"}, {"label": "bus"}, {"label": "car"}]})
    df = spark.createDataFrame([("Nd_O_1", text), ("Nd_O_1", text), ("single", "{}")], "folder string, content string")
    assert sorted(map(tuple, docs.label_counts(df, "folder", "content").collect())) == [("Nd_O_1", "bus", 2), ("Nd_O_1", "car", 4)]
    folders = spark.createDataFrame([(f,) for f in ("Nd_O_725", "Nd_O_1", "single", "a_b")], "folder string")
    got = [tuple(r) for r in docs.camera_folders(folders, "folder").collect()]
    assert got == [("Nd_O", "Nd_O_1"), ("Nd_O", "Nd_O_725"), ("a_b", "a_b"), ("single", "single")]


def test_document_flows(spark, tmp_path):
    weather, cameras = tmp_path / "w", tmp_path / "c" / "Nd_O"
    weather.mkdir()
    cameras.mkdir(parents=True)
    (weather / "a.json").write_text(forecast(periods=[FULL, FULL]))
    (weather / "b.json").write_text("nope")
    (weather / "c.txt").write_text("ignored")
    (cameras / "r.json").write_text(json.dumps({"camera_id": "Nd_O", "avg_per_frame": {"Bike": 1}}))
    counts = trust_weather(spark, str(weather), str(tmp_path / "wt")).collect()
    assert {r["reason"]: r["row_count"] for r in counts} == {"accepted": 1, "invalid_json": 1}
    assert spark.read.parquet(str(tmp_path / "wt")).count() == 2
    main(["trust-cameras", str(tmp_path / "c"), str(tmp_path / "ct")])
    assert spark.read.parquet(str(tmp_path / "ct")).select(F.col("Bike")).first()[0] == 1.0


def test_command_line():
    for name, (arguments, _) in STAGES.items():
        args = parser().parse_args([name, *arguments.split()])
        assert args.stage == name and all(getattr(args, a) == a for a in arguments.split())


def test_each_document_is_parsed_once(spark):
    parsed = parse(spark, [forecast(periods=[FULL])])
    plan = docs.weather_rows(docs.explode_periods(parsed))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_stages_can_run_again(spark, tmp_path):
    source = tmp_path / "w"
    source.mkdir()
    (source / "a.json").write_text(forecast(periods=[FULL, FULL]))
    for _ in range(2):
        trust_weather(spark, str(source), str(tmp_path / "wt")).collect()
        assert spark.read.parquet(str(tmp_path / "wt")).count() == 2


def test_numbers_as_text_and_odd_types_cost_their_field_only(spark):
    odd = json.loads(forecast(periods=[{**FULL, "isDaytime": "yes"}]))
    odd["metadata"]["location"]["lat"] = "40.5"
    rows = docs.weather_rows(docs.explode_periods(parse(spark, [json.dumps(odd)]))).collect()
    assert len(rows) == 1 and rows[0]["is_daytime"] is True
    reports = spark.createDataFrame([(json.dumps({"camera_id": "Nd_O", "avg_per_frame": {"Bike": "1.5", "Auto": "x"}, "total_frames_processed": "3"}),)], "content string")
    row = docs.camera_rows(docs.parse_documents(reports, docs.REPORT_SCHEMA)).first()
    assert (row["Bike"], row["Auto"], row["total_frames_processed"]) == (1.5, 0.0, 3)
