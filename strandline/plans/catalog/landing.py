"""Landing-zone queries: scans, routing, file metadata, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.columns import normalize_columns, safe_double
from strandline.functions.text import LINE_BREAKS, WHITESPACE, format_article
from strandline.operators import documents as docs
from strandline.operators import landing
from strandline.plans import landing as flow
from strandline.plans.catalog import inputs
from strandline.plans.catalog.inputs import registry, table, wide
from strandline.session import scratch_path
from strandline.sources import evolving, readers, writers

QUERIES, query = registry()


@query("SELECT s_suppkey, s_name, s_nationkey AS s_nation_key, s_acctbal AS s_acctbal_ FROM supplier")
def column_names(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_columns(table(spark, sf, "supplier").toDF(" S SuppKey ", "S Name#", "S (Nation) Key", "S AcctBal $"))


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS row_count, round(sum(l_quantity), 2) AS sum_quantity,
           count(*) FILTER (l_tax = 0) AS zero_tax_rows
    FROM lineitem GROUP BY ALL
""")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    writers.write_parts(table(spark, sf, "lineitem"), path, 10_000_000)
    rows = readers.read_csv_strings(spark, path)
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.sum(safe_double("l_quantity")), 2).alias("sum_quantity"),
        F.count_if(safe_double("l_tax") == 0).alias("zero_tax_rows"),
    )


@query("SELECT count(*) AS row_count, 1 AS parts_within_limit FROM orders")
def csv_parts(spark: SparkSession, sf: str) -> DataFrame:
    path, limit = scratch_path(spark, "parts"), 50_000
    writers.write_parts(table(spark, sf, "orders"), path, limit)
    parts = landing.part_counts(readers.read_csv_strings(spark, path))
    return parts.agg(
        F.sum("row_count").alias("row_count"), (F.max("row_count") <= limit).cast("int").alias("parts_within_limit")
    )


@query(f"""
    SELECT doc_id, md5(article) AS article_md5, length(article) AS article_chars
    FROM (SELECT doc_id, trim(source, ws) || chr(10) || lang || chr(10)
                 || CASE WHEN lang = 'de' THEN '' ELSE 'author ' || doc_id END || chr(10) || '2024-01-01' || chr(10)
                 || trim(text, ws) || chr(10) || doc_id || chr(10) AS article
          FROM documents, (SELECT '{WHITESPACE}' AS ws))
""")
def json_line_articles(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    doc_id = F.col("doc_id").cast("string")
    articles = table(spark, sf, "documents").select(
        F.concat(F.lit("  "), F.col("source")).alias("headline"),
        F.col("lang").alias("category"),
        F.when(F.col("lang") != "de", F.concat(F.lit("author "), doc_id)).alias("authors"),
        F.lit("2024-01-01").alias("date"),
        F.col("text").alias("short_description"),
        doc_id.alias("link"),
    )
    writers.write_json_lines(articles, path)
    article = format_article()
    return readers.read_json_lines(spark, path).select(
        F.col("link").cast("bigint").alias("doc_id"),
        F.md5(article.cast("binary")).alias("article_md5"),
        F.length(article).alias("article_chars"),
    )


@query("SELECT count(*) AS row_count, count(*) AS distinct_lines, 1 AS first_line FROM conversations")
def json_line_numbers(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    writers.write_json_lines(table(spark, sf, "conversations"), path)
    rows = readers.read_json_lines(spark, path, "conv_id bigint, turn bigint, role string, text string")
    per_file = rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.max("line_number").alias("last"), F.min("line_number").alias("first")
    )
    return per_file.agg(F.sum("n").alias("row_count"), F.sum("last").alias("distinct_lines"), F.max("first").alias("first_line"))


_FILE_SQL = """
    source || '/' || lang || '_' || lpad(CAST(doc_id AS STRING), 6, '0') ||
    CASE lang WHEN 'en' THEN '.TXT' WHEN 'de' THEN '.wav' WHEN 'fr' THEN '.json' ELSE '.mp3' END
"""


@query(f"""
    SELECT object_name FROM (SELECT {_FILE_SQL} AS object_name FROM documents)
    WHERE regexp_matches(lower(object_name), '[.](txt|wav)$') ORDER BY object_name LIMIT 50
""")
def first_files(spark: SparkSession, sf: str) -> DataFrame:
    listing = table(spark, sf, "documents").select(F.expr(_FILE_SQL).alias("object_name"))
    return landing.first_n_files(listing, [".txt", ".wav"], 50)


@query("""
    SELECT user_id AS folder, event_type AS label, 2 * count(*) AS n FROM events GROUP BY ALL
    UNION ALL SELECT user_id, 'car', count(*) FROM events GROUP BY ALL
""")
def annotation_labels(spark: SparkSession, sf: str) -> DataFrame:
    shape = lambda c: F.concat(F.lit('{"label":"'), c, F.lit('"}'))
    kind = shape(F.col("event_type"))
    content = F.concat(F.lit('{"shapes":['), F.concat_ws(",", kind, shape(F.lit("car")), kind), F.lit("]}"))
    files = table(spark, sf, "events").select(F.col("user_id").alias("folder"), content.alias("content"))
    return docs.label_counts(files, "folder", "content")


@query("""
    SELECT DISTINCT split_part(folder, '_', 1) || CASE WHEN contains(folder, '_') THEN '_' || split_part(folder, '_', 2) ELSE '' END
               AS camera_id, folder
    FROM (SELECT CASE WHEN event_type = 'error' THEN 'single' || user_id ELSE event_type || '_' || user_id || '_' || event_id END
              AS folder FROM events)
""")
def camera_folders(spark: SparkSession, sf: str) -> DataFrame:
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    folder = F.when(F.col("event_type") == "error", F.concat(F.lit("single"), user)).otherwise(
        F.concat_ws("_", "event_type", user, event)
    )
    return docs.camera_folders(table(spark, sf, "events").select(folder.alias("folder")), "folder")


_ROUTE_SQL = f"""
    WITH {inputs.LISTING_SQL},
    named AS (SELECT object_name, substr(object_name, 18) AS f FROM listing),
    kinds AS (SELECT *, CASE WHEN lower(f) LIKE '%.csv' THEN 'structured_csv' WHEN contains(f, '/') THEN 'skipped'
                  WHEN f LIKE 'meta_unstructured_%.json' THEN 'camera_report'
                  WHEN lower(f) LIKE '_%.json' THEN 'semi_structured' WHEN lower(f) LIKE '_%.wav' THEN 'audio'
                  WHEN lower(f) LIKE '_%.txt' THEN 'text' ELSE 'skipped' END AS kind FROM named)
"""


@query(_ROUTE_SQL + """
    SELECT object_name, kind,
           CASE kind WHEN 'camera_report' THEN 'persistent_landing/unstructured/images/metadata/'
                         || substr(replace(f, 'meta_unstructured_report_', ''), 1,
                                   length(replace(f, 'meta_unstructured_report_', '')) - 12) || '/' || f
                     WHEN 'semi_structured' THEN 'persistent_landing/semi_structured/data/' || f
                     WHEN 'audio' THEN 'persistent_landing/unstructured/audio/data/' || f
                     WHEN 'text' THEN 'persistent_landing/unstructured/text/data/' || f END AS destination,
           CASE kind WHEN 'semi_structured' THEN 'persistent_landing/semi_structured/metadata/metadata_' || f
                     WHEN 'audio' THEN 'persistent_landing/unstructured/audio/metadata/metadata_' || replace(f, '.wav', '.json')
                     WHEN 'text' THEN 'persistent_landing/unstructured/text/metadata/metadata_' || replace(f, '.txt', '.json')
                     END AS metadata_destination
    FROM kinds
""")
def route_files(spark: SparkSession, sf: str) -> DataFrame:
    return landing.route_objects(inputs.object_listing(spark, sf))


@query(_ROUTE_SQL + """
    SELECT kind, count(*) AS seen, count(*) FILTER (kind <> 'skipped') AS processed,
           count(*) FILTER (kind = 'skipped') AS failed
    FROM kinds GROUP BY kind
""")
def landing_summary(spark: SparkSession, sf: str) -> DataFrame:
    routed = landing.route_objects(inputs.object_listing(spark, sf))
    error = F.when(F.col("kind") == "skipped", F.lit("unknown type"))
    return landing.landing_summary(routed.withColumn("error", error))


@query("""
    SELECT 'a/doc_' || doc_id || '.txt' AS object_name FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
""")
def land_new_only(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = table(spark, sf, "documents")
    listing = files.select(F.concat(F.lit("a"), name).alias("object_name"))
    listing = listing.unionAll(files.select(F.concat(F.lit("b"), name).alias("object_name")))
    landed = table(spark, sf, "labels").select(F.concat(F.lit("landed"), name).alias("object_name"))
    return landing.land_new(listing, landed)


@query(f"""
    WITH docs AS (SELECT *, {inputs.WEATHER_JSON_SQL} AS content, {inputs.VALID_TIMES_SQL} AS vt,
                         o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS bad FROM orders)
    SELECT o_orderkey, CASE WHEN bad THEN 'invalid_json' END AS error,
           CASE WHEN NOT bad THEN strlen(content) END AS file_size_bytes,
           CASE WHEN NOT bad THEN sha256(content) END AS checksum_sha256,
           CASE WHEN NOT bad THEN CASE WHEN o_orderstatus = 'O' THEN 'hourly' ELSE 'daily' END END AS granularity,
           CASE WHEN NOT bad AND o_orderstatus = 'F' THEN '2024-01-01T00:00:00' END AS valid_from,
           CASE WHEN NOT bad AND o_orderstatus = 'F' THEN 'P7DT' || (o_custkey % 24) || 'H' END AS valid_duration,
           CASE WHEN NOT bad THEN CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 3 END END AS periods_count,
           CASE WHEN NOT bad THEN 'Polygon' END AS geometry_type,
           CASE WHEN NOT bad THEN (o_custkey % 50)::INT END AS grid_x,
           CASE WHEN NOT bad THEN {inputs.LOCATION_SQL} END AS location_name,
           CASE WHEN NOT bad THEN true END AS has_required_fields
    FROM docs
""")
def weather_file_metadata(spark: SparkSession, sf: str) -> DataFrame:
    routed = landing.route_objects(inputs.weather_texts(spark, sf))
    rows = landing.weather_file_metadata(routed)
    return rows.select(
        F.regexp_extract("object_name", r"w_(\d+)", 1).cast("bigint").alias("o_orderkey"),
        "error",
        "file_metadata.file_size_bytes",
        "file_metadata.checksum_sha256",
        *[f"content_metadata.{c}" for c in ("granularity", "valid_from", "valid_duration", "periods_count", "geometry_type")],
        "source_metadata.grid.grid_x",
        F.col("source_metadata.location.name").alias("location_name"),
        "quality_metadata.has_required_fields",
    )


@query(f"""
    WITH parts AS (SELECT *, regexp_split_to_array(text, '\\r\\n|[{LINE_BREAKS}]') AS raw FROM documents),
    lines AS (SELECT *, CASE WHEN raw[-1] = '' THEN raw[1:len(raw) - 1] ELSE raw END AS l FROM parts),
    full_lines AS (SELECT *, list_filter(list_transform(l, lambda x: trim(x, '{WHITESPACE}')), lambda x: x <> '') AS f FROM lines)
    SELECT doc_id, strlen(text) AS file_size_bytes, sha256(text) AS checksum_sha256, f[1] AS headline, f[2] AS category,
           len(l)::INT AS line_count, len(f)::INT AS non_empty_line_count,
           len(regexp_extract_all(text, '[^{WHITESPACE}]+'))::INT AS word_count, length(text)::INT AS character_count,
           coalesce(length(f[1]), 0)::INT AS headline_length_chars, coalesce(length(f[5]), 0)::INT AS summary_length_chars,
           len(f) >= 6 AS has_source_url, (6 - least(len(f), 6))::INT AS missing_count,
           len(f) >= 6 AS has_minimum_expected_lines, len(f) = 0 AS is_empty_file
    FROM full_lines
""")
def text_file_metadata(spark: SparkSession, sf: str) -> DataFrame:
    files = wide(spark, sf, "documents").select(
        F.concat(F.lit("temporal_landing/d_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("object_name"),
        F.col("text").alias("content"),
    )
    rows = landing.text_file_metadata(landing.route_objects(files))
    about, quality = "content_metadata", "quality_metadata"
    return rows.select(
        F.regexp_extract("source_metadata.record_id", r"(\d+)", 1).cast("bigint").alias("doc_id"),
        "file_metadata.file_size_bytes",
        "file_metadata.checksum_sha256",
        *[f"{about}.{c}" for c in ("headline", "category", "line_count", "non_empty_line_count", "word_count", "character_count")],
        *[f"{about}.{c}" for c in ("headline_length_chars", "summary_length_chars", "has_source_url")],
        F.size(f"{quality}.missing_fields").alias("missing_count"),
        f"{quality}.has_minimum_expected_lines",
        f"{quality}.is_empty_file",
    )


@query("""
    SELECT vec_id, CASE WHEN label % 2 = 1 THEN 8000 ELSE 16000 END::BIGINT AS sample_rate_hz,
           CASE WHEN label % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS channels, 2::BIGINT AS sample_width_bytes,
           8000::BIGINT AS frame_count, CASE WHEN label % 2 = 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS duration_seconds,
           true AS is_valid_wav, CASE WHEN label % 3 = 0 THEN 32044 ELSE 16044 END::BIGINT AS file_size_bytes
    FROM embeddings
""")
def wav_file_metadata(spark: SparkSession, sf: str) -> DataFrame:
    files = inputs.wav_table(spark, sf).select(
        F.concat(F.lit("temporal_landing/v_"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("object_name"),
        F.col("raw").alias("content"),
    )
    rows = landing.wav_file_metadata(landing.route_objects(files))
    return rows.select(
        F.regexp_extract("source_metadata.record_id", r"(\d+)", 1).cast("bigint").alias("vec_id"),
        *[f"content_metadata.{c}" for c in ("sample_rate_hz", "channels", "sample_width_bytes", "frame_count", "duration_seconds")],
        "quality_metadata.is_valid_wav",
        "file_metadata.file_size_bytes",
    )


@query("""
    SELECT doc_id, source AS "file.name", n_chars AS "file.size", quality AS "flags.quality", toxic AS "flags.toxic",
           '["' || lang || '","' || source || '"]' AS "flags.tags", 'none' AS "flags.note"
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def flatten_payload(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    nested = joined.select(
        "doc_id",
        F.struct(F.col("source").alias("name"), F.col("n_chars").alias("size")).alias("file"),
        F.struct("quality", "toxic", F.array("lang", "source").alias("tags"), F.lit(None).alias("note")).alias("flags"),
    )
    # A null of no type has become a string column.
    return landing.flatten(nested).fillna("none", ["`flags.note`"])


_REPORT_TEXT = """
    '{"camera_id":"Nd_' || CAST(user_id AS STRING) || '","date":"2024-01-01","avg_per_frame":{"' || event_type || '":'
    || CAST(event_id % 9 AS STRING) || '.5},"total_frames_processed":' || CAST(event_id % 40 AS STRING) || '}'
"""


@query("""
    SELECT 'Nd_' || user_id AS camera_id, '2024-01-01' AS "timestamp", event_id % 40 AS total_frames, event_id::VARCHAR AS source_file,
           CASE WHEN event_type = 'click' THEN event_id % 9 + 0.5 END::DOUBLE AS click,
           CASE WHEN event_type = 'error' THEN event_id % 9 + 0.5 END::DOUBLE AS error,
           CASE WHEN event_type = 'purchase' THEN event_id % 9 + 0.5 END::DOUBLE AS purchase,
           CASE WHEN event_type = 'signup' THEN event_id % 9 + 0.5 END::DOUBLE AS signup,
           CASE WHEN event_type = 'view' THEN event_id % 9 + 0.5 END::DOUBLE AS view
    FROM events
""")
def camera_report_table(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("source_file"), F.expr(_REPORT_TEXT).alias("content")
    )
    return docs.report_table(docs.parse_documents(texts, docs.REPORT_SCHEMA))


@query("""
    SELECT event_id, user_id, event_type, NULL::DOUBLE AS value FROM events
    UNION ALL BY NAME SELECT event_id, value, props FROM events
""")
def append_evolve(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "evolve")
    events = table(spark, sf, "events")
    writers.write_documents(events.select("event_id", "user_id", "event_type"), path)
    writers.write_documents(events.select("event_id", "value", "props"), path)
    return readers.read_table(spark, path).select("event_id", "user_id", "event_type", "value", "props")


@query("""
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber % 3 WHEN 0 THEN (l_linenumber * 10)::VARCHAR WHEN 1 THEN l_quantity::VARCHAR ELSE l_returnflag END AS amount,
           CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate::DATE::TIMESTAMP ELSE l_shipdate END AS shipped,
           CASE l_linenumber % 3 WHEN 0 THEN (l_suppkey % 7)::DOUBLE WHEN 1 THEN l_tax END AS tax
    FROM lineitem
""")
def evolving_types(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches in which a column is an int, a double and a string, another a date and a timestamp; one lacks a column."""
    path = scratch_path(spark, "evolving")
    rows = table(spark, sf, "lineitem")
    batches = [
        [F.col("l_orderkey").cast("int"), "l_linenumber", F.expr("l_linenumber * 10 AS amount"), F.expr("cast(l_shipdate AS date) AS shipped"), F.expr("cast(l_suppkey % 7 AS int) AS tax")],
        ["l_orderkey", "l_linenumber", F.col("l_quantity").alias("amount"), F.col("l_shipdate").alias("shipped"), F.col("l_tax").alias("tax")],
        ["l_orderkey", "l_linenumber", F.col("l_returnflag").alias("amount"), F.col("l_shipdate").alias("shipped")],
    ]
    for number, columns in enumerate(batches):
        evolving.append_batch(rows.where(F.col("l_linenumber") % 3 == number).select(*columns), path, number)
    return evolving.read_evolving(spark, path)


@query("""
    SELECT count(*) FILTER (page_id % 10 <> 0) AS landed_rows, count(*) FILTER (page_id % 10 <> 0) AS copies,
           count(*) FILTER (page_id % 10 <> 0) AS archived_files, count(*) FILTER (page_id % 10 = 0) AS files_left
    FROM pages
""")
def landed_and_archived(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a text file, each tenth with an unknown suffix: landed ones move to the archive, the others stay."""
    base = scratch_path(spark, "archive")
    source, root, archive = (f"{base}/{x}" for x in ("temporal", "lake", "old"))
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 10 == 0, ".bin").otherwise(".txt"))
    writers.write_files(wide(spark, sf, "pages").select(name.alias("name"), "html"), source, "name", "html")
    flow.land_available(spark, source, root, f"{base}/checkpoint", archive=archive)
    counts = {
        "landed_rows": flow.read_landed(spark, root, "text"),
        "copies": readers.list_objects(spark, f"{root}/{landing.PERSISTENT_PREFIX}unstructured/text/data"),
        "archived_files": readers.list_objects(spark, archive),
        "files_left": readers.list_objects(spark, source),
    }
    return spark.createDataFrame([tuple(df.count() for df in counts.values())], ", ".join(f"{c} bigint" for c in counts))


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, 's' || s_nationkey || '.csv' AS file FROM supplier WHERE s_nationkey % 5 <> 0")
def empty_csv_files(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV file per nation; each fifth nation's file has its header alone and adds no row."""
    path = scratch_path(spark, "empty-csv")
    line = F.when(F.col("s_nationkey") % 5 != 0, F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name"))
    lines = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.array_join(F.collect_list(line), "\n").alias("body"))
    name = F.concat(F.lit("s"), F.col("s_nationkey").cast("string"), F.lit(".csv"))
    writers.write_files(lines.select(name.alias("name"), F.concat(F.lit("s_suppkey,s_name\n"), "body").alias("body")), path, "name", "body")
    rows = readers.read_csv_strings(spark, path)
    return rows.select("s_suppkey", "s_name", F.element_at(F.split("source_file", "/"), -1).alias("file"))
