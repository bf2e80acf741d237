"""Inputs in the shape of the real sources, derived from the test tables.

Expressions kept as SQL text use only syntax common to Spark and DuckDB, so both
sides of a check see the same bytes.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for costly per-row work, spread over all cores if its file has few splits."""
    return spread(table(spark, sf_dir, name))


def registry():
    """A dict of name to (function, oracle SQL or None) and the decorator filling it."""
    entries: dict = {}

    def query(sql: str | None = None):
        def add(fn):
            entries[fn.__name__] = (fn, sql)
            return fn

        return add

    return entries, query


# --- collision-shaped records -------------------------------------------------

FACT_JOIN = """
    orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def collision_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string records: repeated and missing ids, five date layouts, blank boroughs."""
    o, c, n, r = wide(spark, sf_dir, "orders"), *(table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    date = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(priority == "2-HIGH", F.concat(day, F.lit("T00:00:00.000")))
        .when(priority == "3-MEDIUM", day)
        .when(priority == "4-NOT SPECIFIED", F.date_format("o_orderdate", "M/d/yyyy"))
        .when(status == "F", F.lit("  "))
        .when(status == "P", F.lit("garbage"))
        .otherwise(day)
    )
    pair = F.floor(F.col("o_orderkey") / 2).cast("bigint").cast("string")
    return joined.select(
        F.when((status == "P") & (priority == "1-URGENT"), F.lit(None))
        .when(priority == "2-HIGH", F.concat(pair, F.lit(".0")))
        .otherwise(pair)
        .alias("collision_id"),
        date.alias("crash_date"),
        F.when(status != "P", F.concat(F.lit("  "), F.lower("r_name"), F.lit(" "))).alias("borough"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("latitude"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("on_street_name"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("number_of_persons_injured"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("x")).otherwise(F.lit("1")).alias("number_of_persons_killed"),
        F.when(status == "O", F.lit("70000")).when(status == "F", F.lit("-1")).alias("number_of_cyclist_injured"),
        F.col("c_mktsegment").alias("vehicle_type_code_1"),
        F.concat(F.lit("part_"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit(".csv")).alias("source_file"),
    )


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_PAIR = "(o_orderkey // 2)::VARCHAR"
FACT_SQL = f"""
    SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
                WHEN o_orderpriority = '2-HIGH' THEN {_PAIR} || '.0' ELSE {_PAIR} END AS collision_id,
           CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%m/%d/%Y')
                WHEN o_orderpriority = '2-HIGH' THEN {_DAY} || 'T00:00:00.000'
                WHEN o_orderpriority = '3-MEDIUM' THEN {_DAY}
                WHEN o_orderpriority = '4-NOT SPECIFIED'
                    THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate)
                WHEN o_orderstatus = 'F' THEN '  '
                WHEN o_orderstatus = 'P' THEN 'garbage' ELSE {_DAY} END AS crash_date,
           CASE WHEN o_orderstatus <> 'P' THEN '  ' || lower(r_name) || ' ' END AS borough,
           c_nationkey::VARCHAR AS zip_code,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE o_totalprice END AS latitude,
           ' ' || lower(c_name) AS on_street_name,
           c_nationkey AS number_of_persons_injured,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE 1 END AS number_of_persons_killed,
           CASE WHEN o_orderstatus = 'O' THEN 70000 WHEN o_orderstatus = 'F' THEN -1 ELSE 0 END AS number_of_cyclist_injured,
           c_mktsegment AS vehicle_type_code_1,
           'part_' || lpad(o_orderkey::VARCHAR, 10, '0') || '.csv' AS source_file,
           o_orderdate
    FROM {FACT_JOIN}
"""
# A date text is good when it matches one of the layouts in full.
VALID_DATE_SQL = """
    (regexp_full_match(crash_date, '[0-9]{2}/[0-9]{2}/[0-9]{4}')
     OR regexp_full_match(crash_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}(T00:00:00.000)?'))
"""
DEDUPED_SQL = f"""
    fact AS ({FACT_SQL}),
    kept AS (SELECT *, {VALID_DATE_SQL} AS ok FROM fact
             QUALIFY row_number() OVER (PARTITION BY collision_id ORDER BY source_file) = 1)
"""


# --- forecast documents --------------------------------------------------------

LOCATION_SQL = """
    CASE o_orderpriority WHEN '1-URGENT' THEN 'lower_manhattan' WHEN '2-HIGH' THEN 'South_Bronx'
         WHEN '3-MEDIUM' THEN 'brooklyn' WHEN '4-NOT SPECIFIED' THEN 'riverdale' ELSE 'staten_island' END
"""
ENDPOINT_SQL = "CASE WHEN o_orderstatus = 'O' THEN 'forecast/hourly' ELSE 'forecast' END"
VALID_TIMES_SQL = """
    CASE WHEN o_orderstatus = 'F' THEN '2024-01-01T00:00:00/P7DT' || CAST(o_custkey % 24 AS STRING) || 'H'
         ELSE 'unknown' END
"""
_KEY = "CAST(o_orderkey AS STRING)"
_CUST = "CAST(o_custkey % 60 - 10 AS STRING)"
WEATHER_JSON_SQL = f"""
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '{{"metadata": ' || {_KEY}
    ELSE '{{"metadata":{{"location":{{"name":"' || {LOCATION_SQL} || '","lat":40.5,"lon":-73.25}},'
      || '"grid":{{"office":"OKX","grid_x":' || CAST(o_custkey % 50 AS STRING) || ',"grid_y":7}},'
      || '"endpoint":"' || {ENDPOINT_SQL} || '","source_url":"u/' || {_KEY} || '"}},'
      || '"data":{{"geometry":{{"type":"Polygon"}},"properties":{{"units":"us","validTimes":"' || {VALID_TIMES_SQL} || '"'
      || CASE WHEN o_orderstatus = 'P' THEN '}}}}}}' ELSE
         ',"periods":[{{"startTime":"1996-02-03T06:00:00-05:00","temperature":' || {_CUST}
      || ',"isDaytime":true,"windSpeed":"' || CAST(o_custkey % 20 AS STRING) || ' to 25 mph","dewpoint":{{"value":'
      || CAST(o_custkey % 30 AS STRING) || '.5}},"probabilityOfPrecipitation":{{"value":null}},"relativeHumidity":{{"value":'
      || CAST(o_custkey % 100 AS STRING) || '}},"shortForecast":"Sunny"}},'
      || '{{"startTime":"1996-02-04","temperature":"' || {_CUST} || ' F","windSpeed":"calm","dewpoint":5,'
      || '"probabilityOfPrecipitation":{{"value":' || CAST(o_custkey % 7 AS STRING) || '}}}},{{}}]}}}}}}' END
    END
"""


def weather_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_orderkey, object_name, content)``: one forecast document text per order."""
    return wide(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("temporal_landing/w_"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("object_name"),
        F.expr(WEATHER_JSON_SQL).alias("content"),
    )


# --- object listings -----------------------------------------------------------

OBJECT_NAME_SQL = """
    'temporal_landing/' ||
    CASE lang WHEN 'en' THEN 'a_' || CAST(doc_id AS STRING) || '.txt'
              WHEN 'de' THEN 'sub/' || CAST(doc_id AS STRING) || '.CSV'
              WHEN 'fr' THEN 'meta_unstructured_report_' || source || '_' || lpad(CAST(doc_id AS STRING), 6, '0') || '.json'
              ELSE 'w.' || CAST(doc_id AS STRING) || '.JSON' END
"""
PAGE_NAME_SQL = """
    'temporal_landing/' ||
    CASE length(url) % 4 WHEN 0 THEN 'p_' || CAST(page_id AS STRING) || '.wav'
                         WHEN 1 THEN 'sub/p_' || CAST(page_id AS STRING) || '.txt'
                         WHEN 2 THEN 'p_' || CAST(page_id AS STRING) || '.mp3'
                         ELSE '.txt' END
"""


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.expr(OBJECT_NAME_SQL).alias("object_name"))
    pages = table(spark, sf_dir, "pages").select(F.expr(PAGE_NAME_SQL).alias("object_name"))
    return docs.unionAll(pages)


LISTING_SQL = f"""
    listing AS (SELECT {OBJECT_NAME_SQL} AS object_name FROM documents
                UNION ALL SELECT {PAGE_NAME_SQL} FROM pages)
"""


# --- camera frames ---------------------------------------------------------------


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(camera_id, frame_id, ts, detections)``: one frame per event."""
    return wide(spark, sf_dir, "events").select(
        F.concat(F.lit("Nd_"), F.col("user_id").cast("string")).alias("camera_id"),
        F.col("event_id").cast("string").alias("frame_id"),
        "ts",
        F.when(F.col("event_type") == "error", F.create_map().cast("map<string,bigint>"))
        .otherwise(F.create_map(F.col("event_type"), F.floor("value").cast("bigint")))
        .alias("detections"),
    )


FRAMES_SQL = """
    frames AS (SELECT 'Nd_' || user_id AS camera_id, event_id::VARCHAR AS frame_id, ts,
                      CASE WHEN event_type <> 'error' THEN event_type END AS label, floor(value)::BIGINT AS n
               FROM events)
"""


# --- WAV files ---------------------------------------------------------------------

WAV_REPEATS = 125


def wav_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, label, raw)``: each stored vector as a PCM wave of 8,000 frames.

    Odd labels are 8 kHz (one second), even ones 16 kHz (half a second); labels
    divisible by three are stereo with the right channel at half the level.
    """
    from strandline.functions.audio import write_wav

    # not in Arrow batches, whose 10,000 rows would be waves of 160 to 320 MB
    @F.udf(returnType="binary", useArrow=False)
    def encode(vector: list | None, label: int | None) -> bytes:
        one = np.floor(np.asarray(vector, dtype=np.float64) * 32767.0)
        left = np.tile(one, WAV_REPEATS)
        label = math.nan if label is None else label
        rate = 8_000 if label % 2 else 16_000
        if label % 3 == 0:
            return _stereo(np.column_stack([left, np.floor(left / 2)]).ravel(), rate)
        return write_wav(left, rate)

    return wide(spark, sf_dir, "embeddings").select("vec_id", "label", encode("embedding", "label").alias("raw"))


def _stereo(interleaved: np.ndarray, rate: int) -> bytes:
    import io
    import wave

    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(interleaved.astype("<i2").tobytes())
    return buffer.getvalue()


# Mono 16-bit samples of the same waves as rows (vec_id, label, i, x), i from 0.
WAV_SQL = f"""
    level AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(e::DOUBLE * 32767.0)::BIGINT) AS v FROM embeddings),
    mono AS (SELECT vec_id, label, CASE WHEN label % 3 = 0
                 THEN list_transform(v, lambda x: floor((x + floor(x / 2.0)) / 2.0)::BIGINT) ELSE v END AS v FROM level),
    samples AS (SELECT vec_id, label, r.i AS i, v[(r.i % 64) + 1] AS x
                FROM mono, range({64 * WAV_REPEATS}) r(i))
"""
