"""Trusted-zone queries: record cleaning, forecast and camera documents, text and audio."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import audio as wav
from strandline.functions.columns import (
    first_int,
    in_unsigned_range,
    normalize_name,
    parse_date,
    rule_map,
    safe_double,
    safe_int,
    safe_long,
)
from strandline.functions.text import WHITESPACE, clean_text as cleaned, skip_reason
from strandline.operators import cleaning
from strandline.operators import documents as docs
from strandline.operators.embed import clean_audio as clean_wavs, per_file
from strandline.plans import increments, unstructured
from strandline.plans.catalog import inputs
from strandline.plans.catalog.inputs import DEDUPED_SQL, FACT_SQL, VALID_DATE_SQL, registry, table, wide
from strandline.session import scratch_path
from strandline.sources import readers, writers

QUERIES, query = registry()


def _day(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax) = 1
""")
def dedupe_by_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.dedupe(table(spark, sf, "lineitem"), ["l_orderkey"])
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


@query(f"""
    WITH fact AS ({FACT_SQL})
    SELECT source_file, crash_date AS raw_date,
           CASE WHEN {VALID_DATE_SQL} THEN strftime(o_orderdate, '%Y-%m-%d') END AS parsed_date
    FROM fact
""")
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    facts = inputs.collision_strings(spark, sf)
    return facts.select("source_file", F.col("crash_date").alias("raw_date"), _day(parse_date("crash_date")).alias("parsed_date"))


@query(f"WITH {DEDUPED_SQL} SELECT collision_id, crash_date, source_file FROM kept WHERE NOT ok")
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = cleaning.clean_collisions(inputs.collision_strings(spark, sf), order_by=["source_file"])
    return rejected.select("collision_id", "crash_date", "source_file")


@query(f"WITH {DEDUPED_SQL} SELECT nullif(collision_id::VARCHAR, '') AS collision_id, nullif(crash_date, '') AS crash_date, source_file, 0 AS runs_without_rejects FROM kept WHERE NOT ok")
def rejects_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected rows read back from their CSV, where an empty text and a null are one; a run without rejects writes nothing."""
    accepted, rejected = cleaning.clean_collisions(inputs.collision_strings(spark, sf), order_by=["source_file"])
    path = scratch_path(spark, "rejects")
    folder = writers.write_rejects(rejected.select("collision_id", "crash_date", "source_file"), path)
    empty = writers.write_rejects(rejected.filter("false").select("collision_id"), path)
    stored = spark.read.option("header", True).option("escape", '"').csv(folder)
    return stored.withColumn("runs_without_rejects", F.lit(0 if empty is None else 1))


@query(f"""
    WITH fact AS ({FACT_SQL}),
    batched AS (SELECT *, regexp_extract(source_file, '[0-9]+')::BIGINT % 3 AS batch FROM fact)
    SELECT source_file, batch, {VALID_DATE_SQL} AND number_of_cyclist_injured BETWEEN 0 AND 65535 AS accepted FROM batched
    QUALIFY row_number() OVER (PARTITION BY collision_id ORDER BY batch, source_file) = 1
""")
def trusted_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Records in three batches with duplicates in and among them: each batch meets the keys of those before."""
    root = scratch_path(spark, "increments")
    records = inputs.collision_strings(spark, sf)
    number = F.regexp_extract("source_file", "[0-9]+", 0).cast("bigint") % 3
    for batch in range(3):
        increments.trust_batch(records.where(number == batch), batch, root, order_by=["source_file"])
    rows = lambda name, ok: increments.read_trusted(spark, root, name).select("source_file", F.col("batch_id").cast("bigint").alias("batch"), F.lit(ok).alias("accepted"))
    return rows("accepted", True).unionAll(rows("rejected", False))


@query(f"""
    WITH {DEDUPED_SQL}
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS crash_date, '' AS crash_time, coalesce(upper(trim(borough)), '') AS borough,
           zip_code, latitude::DOUBLE AS latitude, upper(trim(on_street_name)) AS on_street_name,
           '' AS off_street_name, number_of_persons_injured, number_of_persons_killed, number_of_cyclist_injured,
           0 AS number_of_motorist_killed,
           coalesce(split_part(collision_id, '.', 1)::BIGINT, 0) AS collision_id, vehicle_type_code_1,
           '' AS vehicle_type_code_5, source_file
    FROM kept WHERE ok
""")
def clean_fact(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = cleaning.clean_collisions(inputs.collision_strings(spark, sf), order_by=["source_file"])
    return clean.select(
        _day("crash_date").alias("crash_date"),
        *["crash_time", "borough", "zip_code", "latitude", "on_street_name", "off_street_name"],
        *["number_of_persons_injured", "number_of_persons_killed", "number_of_cyclist_injured", "number_of_motorist_killed"],
        *["collision_id", "vehicle_type_code_1", "vehicle_type_code_5", "source_file"],
    )


@query(f"""
    WITH {DEDUPED_SQL}, n AS (SELECT count(*) AS total_rows FROM fact)
    SELECT total_rows, count(*) FILTER (ok) AS clean_rows, total_rows - count(*) AS duplicate_rows,
           count(*) FILTER (NOT ok) AS rejected_rows, total_rows - count(*) FILTER (ok) AS dropped_rows
    FROM kept, n GROUP BY total_rows
""")
def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_counts(inputs.collision_strings(spark, sf), order_by=["source_file"])


@query(f"""
    WITH fact AS ({FACT_SQL})
    SELECT number_of_cyclist_injured BETWEEN 0 AND 65535 AS fits, count(*) AS row_count FROM fact GROUP BY ALL
""")
def unsigned_range(spark: SparkSession, sf: str) -> DataFrame:
    typed = cleaning.cast_records(inputs.collision_strings(spark, sf))
    return typed.groupBy(cleaning.unsigned_fit(typed).alias("fits")).agg(F.count(F.lit(1)).alias("row_count"))


@query("""
    SELECT l_orderkey, l_linenumber, trunc(l_extendedprice)::INT AS as_int, l_partkey AS as_long,
           l_extendedprice AS as_double, 0 AS bad_int, -1.0::DOUBLE AS bad_double,
           l_extendedprice BETWEEN 0 AND 65535.99 AS fits_uint16
    FROM lineitem
""")
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    price = F.format_string(" %.2f ", "l_extendedprice")
    rows = wide(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        safe_int(price).alias("as_int"),
        safe_long(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("as_long"),
        safe_double(price).alias("as_double"),
        safe_int(F.concat(F.lit("x"), price)).alias("bad_int"),
        safe_double(F.concat(price, F.lit("x")), -1.0).alias("bad_double"),
        in_unsigned_range(safe_int(price), 16).alias("fits_uint16"),
    )


@query("""
    SELECT c_custkey, upper(c_name) AS customer_name, upper(n_name) AS nation_name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE upper(c_mktsegment) END AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def normalized_names(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    padded = lambda c: F.concat(F.lit("  "), F.lower(c), F.lit(" "))
    gaps = F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment"))
    return joined.select(
        "c_custkey",
        normalize_name(padded("c_name")).alias("customer_name"),
        normalize_name(padded("n_name")).alias("nation_name"),
        normalize_name(gaps).alias("segment"),
    )


@query("""
    SELECT p_partkey, (p_size % 25)::INT AS unsigned_int, (CASE WHEN p_size < 25 THEN -1 ELSE 1 END * (p_size % 25))::INT AS signed_int,
           -1 AS no_int
    FROM part
""")
def first_int_extract(spark: SparkSession, sf: str) -> DataFrame:
    size = (F.col("p_size") % 25).cast("string")
    text = F.concat(F.when(F.col("p_size") < 25, F.lit("about -")).otherwise(F.lit("about ")), size, F.lit(" to 99 mph"))
    return table(spark, sf, "part").select(
        "p_partkey",
        first_int(text).alias("unsigned_int"),
        first_int(text, signed=True).alias("signed_int"),
        F.coalesce(first_int("p_name"), F.lit(-1)).alias("no_int"),
    )


@query("""
    SELECT p_partkey, CASE WHEN p_type ILIKE '%economy%' THEN 'CHEAP' WHEN p_type ILIKE '%promo%' OR p_name LIKE 'red%' THEN 'OFFER'
                           ELSE 'UNKNOWN' END AS segment
    FROM part
""")
def regex_rules(spark: SparkSession, sf: str) -> DataFrame:
    both = F.concat_ws("|", "p_type", "p_name")
    rules = (("(?i)^[^|]*economy", "CHEAP"), (r"(?i)^[^|]*promo|\|(?-i:red)", "OFFER"))
    return table(spark, sf, "part").select("p_partkey", rule_map(both, rules).alias("segment"))


_WEATHER_SQL = f"""
    WITH src AS (SELECT *, {inputs.LOCATION_SQL} AS loc, abs(o_custkey % 60 - 10)::DOUBLE AS t FROM orders WHERE o_orderstatus <> 'P'),
    rows AS (
        SELECT o_orderkey, loc, '1996-02-03' AS crash_date, t AS temperature, true AS is_daytime,
               (o_custkey % 20)::INT AS wind_speed_mph, (o_custkey % 30 + 0.5)::DOUBLE AS dewpoint_celsius,
               0 AS precip_prob, (o_custkey % 100)::INT AS humidity, 'Sunny' AS weather_description FROM src
        UNION ALL SELECT o_orderkey, loc, '1996-02-04', t, false, NULL, 0.0, (o_custkey % 7)::INT, 0, '' FROM src
        UNION ALL SELECT o_orderkey, loc, '', NULL, false, NULL, 0.0, 0, 0, '' FROM src)
    SELECT o_orderkey, CASE loc WHEN 'lower_manhattan' THEN 'MANHATTAN' WHEN 'South_Bronx' THEN 'BRONX'
                                WHEN 'brooklyn' THEN 'BROOKLYN' WHEN 'staten_island' THEN 'STATEN ISLAND'
                                ELSE 'UNKNOWN' END AS borough,
           upper(loc) AS station_name, crash_date, temperature, is_daytime, wind_speed_mph, dewpoint_celsius,
           precip_prob, humidity, weather_description
    FROM rows
"""


@query(_WEATHER_SQL)
def weather_periods(spark: SparkSession, sf: str) -> DataFrame:
    parsed = docs.parse_documents(inputs.weather_texts(spark, sf), docs.WEATHER_SCHEMA)
    return docs.weather_rows(docs.explode_periods(parsed, keep=["o_orderkey"]), keep=["o_orderkey"])


@query("""
    SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'invalid_json' ELSE 'accepted' END AS reason,
           count(*) AS row_count
    FROM orders GROUP BY ALL
""")
def weather_skipped(spark: SparkSession, sf: str) -> DataFrame:
    parsed = docs.parse_documents(inputs.weather_texts(spark, sf), docs.WEATHER_SCHEMA)
    return cleaning.reason_counts(parsed)


_CAMERA_TEXT = """
    '{"camera_id":"' || CASE user_id % 5 WHEN 0 THEN 'Nd_' WHEN 1 THEN 'NT2_' WHEN 2 THEN 'NT4_' WHEN 3 THEN 'SW_' ELSE 'zz_' END
    || CAST(user_id AS STRING) || '","date":"2024-01-01","avg_per_frame":{"LMV":' || CAST(event_id % 9 AS STRING)
    || '.25,"e-Rickshaw":2,"unknown":7' || CASE WHEN event_type = 'view' THEN ',"Bike":1.5' ELSE '' END
    || '},"total_frames_processed":' || CAST(event_id % 40 AS STRING) || '}'
"""


@query("""
    SELECT event_id, camera_id, '2024-01-01' AS crash_date, (event_id % 40)::INT AS total_frames_processed,
           0.0::DOUBLE AS "MotorBike", 0.0::DOUBLE AS "Pedestrian", CASE WHEN event_type = 'view' THEN 1.5 ELSE 0 END::DOUBLE AS "Bike",
           (event_id % 9 + 0.25)::DOUBLE AS "LMV", 0.0::DOUBLE AS "Auto", 0.0::DOUBLE AS "LCV", 2.0::DOUBLE AS "e-Rickshaw",
           CASE split_part(camera_id, '_', 1) WHEN 'Nd' THEN 'MANHATTAN' WHEN 'NT2' THEN 'BROOKLYN' WHEN 'NT4' THEN 'QUEENS'
                WHEN 'SW' THEN 'STATEN ISLAND' ELSE 'UNKNOWN' END AS borough,
           upper(camera_id) AS camera_id_original
    FROM (SELECT *, CASE user_id % 5 WHEN 0 THEN 'Nd_' WHEN 1 THEN 'NT2_' WHEN 2 THEN 'NT4_' WHEN 3 THEN 'SW_' ELSE 'zz_' END
                 || user_id AS camera_id FROM events)
""")
def camera_rows(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "events").select("event_id", F.expr(_CAMERA_TEXT).alias("content"))
    return docs.camera_rows(docs.parse_documents(texts, docs.REPORT_SCHEMA), keep=["event_id"])


# Tabs, carriage returns and blank runs, which the raw texts lack; one source blank.
_MESSY_SQL = """
    CASE WHEN source = 'src2' THEN chr(32) || chr(9) || chr(10)
         ELSE chr(9) || replace(replace(text, '. ', '.' || chr(9) || '  ' || chr(13) || chr(10) || chr(10) || chr(10) || ' '),
                                ', ', ',' || chr(9) || ' ' || chr(13)) END
"""
_CLEAN_SQL = f"""
    messy AS (SELECT doc_id, {_MESSY_SQL} AS text FROM documents UNION ALL SELECT -1 - page_id, html FROM pages),
    lined AS (SELECT doc_id, text, list_transform(string_split(regexp_replace(lower(text), '\\r\\n?', chr(10), 'g'), chr(10)),
                                                  lambda l: trim(l, '{WHITESPACE}')) AS lines FROM messy),
    joined AS (SELECT doc_id, trim(text, '{WHITESPACE}') = '' AS blank,
                      regexp_replace(regexp_replace(array_to_string(lines, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'),
                                     '[ \\t]+', ' ', 'g') AS t FROM lined),
    cleaned AS (SELECT doc_id, blank, CASE WHEN NOT blank THEN trim(t, '{WHITESPACE}') || chr(10) END AS t FROM joined)
"""


def _messy(spark: SparkSession, sf: str) -> DataFrame:
    documents = wide(spark, sf, "documents").select("doc_id", F.expr(_MESSY_SQL).alias("text"))
    pages = wide(spark, sf, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    return documents.unionAll(pages)


@query(f"""
    WITH {_CLEAN_SQL} SELECT doc_id, md5(t) AS cleaned_md5, length(t)::INT AS cleaned_chars FROM cleaned WHERE NOT blank
""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    accepted = _messy(spark, sf).filter(skip_reason("text").isNull())
    staged = accepted.select("doc_id", cleaned("text").alias("t"))
    return staged.select("doc_id", F.md5(F.col("t").cast("binary")).alias("cleaned_md5"), F.length("t").alias("cleaned_chars"))


@query(f"""
    WITH {_CLEAN_SQL} SELECT CASE WHEN blank THEN 'empty_file' ELSE 'accepted' END AS reason, count(*) AS row_count
    FROM cleaned GROUP BY ALL
""")
def text_skip_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.reason_counts(_messy(spark, sf).select(skip_reason("text").alias("skip_reason")), "skip_reason")


@query(f"""
    WITH {_CLEAN_SQL} SELECT doc_id, CASE WHEN blank THEN 'skipped' ELSE 'data' END AS folder, CASE WHEN NOT blank THEN md5(t) END AS content_md5
    FROM cleaned
""")
def curated_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Every text as a file, cleaned by the flow: accepted ones as cleaned copies, skipped originals apart."""
    source, out = scratch_path(spark, "texts"), scratch_path(spark, "curated")
    name = F.concat(F.lit("t"), F.col("doc_id").cast("string"), F.lit(".txt"))
    writers.write_files(_messy(spark, sf).select(name.alias("name"), "text"), source, "name", "text")
    unstructured.trust_texts(spark, source, out, files=True)
    folders = []
    for folder in ("data", "skipped"):
        files = readers.read_binary(spark, f"{out}/{folder}")
        found = F.md5("raw") if folder == "data" else F.lit(None).cast("string")
        folders.append(files.select(F.regexp_extract("filename", r"^t(-?\d+)\.txt$", 1).cast("bigint").alias("doc_id"), F.lit(folder).alias("folder"), found.alias("content_md5")))
    return folders[0].union(folders[1])


# Even labels keep their 16 kHz samples; odd ones double their rate: sample 2k is
# x[k] and sample 2k-1 the floored middle of x[k-1] and x[k] (no tail past the last).
CLEANED_WAV_SQL = f"""
    {inputs.WAV_SQL},
    cleaned AS (
        SELECT vec_id, CASE WHEN label % 2 = 1 THEN 2 * i ELSE i END AS k, x FROM samples
        UNION ALL
        SELECT vec_id, 2 * i - 1, floor((x + before) / 2.0)::BIGINT
        FROM (SELECT vec_id, label, i, x, lag(x) OVER (PARTITION BY vec_id ORDER BY i) AS before FROM samples)
        WHERE label % 2 = 1 AND i > 0)
"""


@query(f"""
    WITH {CLEANED_WAV_SQL}
    SELECT vec_id, count(*) AS sample_count, sum(x)::BIGINT AS sample_sum, sum(x * (k % 1000))::BIGINT AS weighted_sum
    FROM cleaned GROUP BY vec_id
""")
def clean_audio(spark: SparkSession, sf: str) -> DataFrame:
    clean = clean_wavs(inputs.wav_table(spark, sf))

    @per_file("sample_count bigint, sample_sum bigint, weighted_sum bigint")
    def digest(content: bytes) -> tuple:
        x = np.frombuffer(wav.read_frames(content)[1], "<i2").astype(np.int64)
        return len(x), int(x.sum()), int((x * (np.arange(len(x)) % 1000)).sum())

    return clean.filter("skip_reason is null").withColumn("d", digest("cleaned")).select("vec_id", "d.*")
