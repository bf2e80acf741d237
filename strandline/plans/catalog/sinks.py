"""Sink and serving-table queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import tables
from strandline.plans.catalog.inputs import registry, table
from strandline.session import scratch_path
from strandline.sources import readers, writers

QUERIES, query = registry()


@query("""
    SELECT 'f' || page_id || '.html' AS filename, strlen(html)::INT AS byte_count, sha256(html) AS checksum FROM pages
""")
def binary_files(spark: SparkSession, sf: str) -> DataFrame:
    """One file per page, written by the tasks, then scanned back recursively as bytes."""
    path = scratch_path(spark, "files")
    name = F.concat(F.lit("html/f"), F.col("page_id").cast("string"), F.lit(".html"))
    writers.write_files(table(spark, sf, "pages").select(name.alias("name"), "html"), path, "name", "html")
    files = readers.read_binary(spark, path, "*.html")
    return files.select("filename", F.octet_length("raw").alias("byte_count"), F.sha2("raw", 256).alias("checksum"))


@query("""
    SELECT doc_id, quality, toxic FROM labels WHERE toxic = 0 OR toxic IS NULL
    UNION ALL SELECT doc_id, quality + 10, toxic FROM labels WHERE toxic = 1
""")
def vector_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot of all rows, then an increment replacing the toxic ones, merged on read."""
    path = scratch_path(spark, "vectors")
    rows = table(spark, sf, "labels").withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    writers.upsert_vectors(rows.withColumn("embedded_at", F.lit(1)), path, 1, key="doc_id")
    newer = rows.filter("toxic = 1").withColumns({"quality": F.col("quality") + 10, "embedded_at": F.lit(2)})
    writers.upsert_vectors(newer, path, 1, key="doc_id", compact=False)
    return writers.read_vectors(spark, path, key="doc_id").select("doc_id", "quality", "toxic")


@query("""
    SELECT doc_id, quality + 10 * (doc_id % 3) AS quality, toxic FROM labels
""")
def concurrent_vector_writers(spark: SparkSession, sf: str) -> DataFrame:
    """A stored set, then two increments and a new snapshot written at the same time; all three are read back."""
    path = scratch_path(spark, "vectors")
    rows = table(spark, sf, "labels").withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    writers.upsert_vectors(rows.withColumn("embedded_at", F.lit(1)), path, 1, key="doc_id")

    def write(part: int) -> None:
        mine = rows.filter(F.col("doc_id") % 3 == part).withColumns({"quality": F.col("quality") + 10 * part, "embedded_at": F.lit(2)})
        writers.upsert_vectors(mine, path, 1, key="doc_id", compact=part == 0)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    return writers.read_vectors(spark, path, key="doc_id").select("doc_id", "quality", "toxic")


@query("SELECT count(*) AS row_count, true AS ranges_disjoint FROM orders")
def sorted_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Write range-ordered, then check that file ranges of the sort key do not overlap."""
    path = scratch_path(spark, "sorted")
    writers.write_sorted(table(spark, sf, "orders"), path, ["o_orderdate", "o_orderkey"])
    key = F.struct("o_orderdate", "o_orderkey")
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))
    )
    # Part numbers follow the ranges: compare each file with the next one.
    files = files.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("int"))
    following = files.select((F.col("part") - 1).alias("part"), F.col("low").alias("next_low"))
    checked = files.join(following, "part", "left")
    apart = F.coalesce(F.col("high") < F.col("next_low"), F.lit(True))
    return checked.agg(F.sum("n").alias("row_count"), F.min(apart).alias("ranges_disjoint"))


@query("SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 2 ELSE 1 END AS version FROM labels")
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Stored labels plus a newer copy of the toxic ones: the newer version wins."""
    labels = table(spark, sf, "labels")
    stored = labels.select("doc_id", "quality", F.lit(1).alias("version"))
    incoming = labels.filter("toxic = 1").select("doc_id", "quality", F.lit(2).alias("version"))
    return tables.upsert_latest(stored, incoming, "doc_id", "version")


@query("""
    SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS metadata
    FROM documents
""")
def metadata_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "metadata")
    writers.write_json_lines(table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), path)
    lines = spark.read.text(path)
    key = F.get_json_object("value", "$.doc_id").cast("bigint")
    return lines.select(key.alias("doc_id"), F.col("value").alias("metadata"))


@query("SELECT count(*) AS row_count, count(DISTINCT conv_id) AS conversations FROM conversations")
def document_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    rows = table(spark, sf, "conversations")
    writers.write_documents(rows.filter("role = 'user'"), path)
    writers.write_documents(rows.filter("role <> 'user' or role is null"), path)
    stored = spark.read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("conv_id").alias("conversations"))


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return tables.row_count(table(spark, sf, "lineitem"))


@query("SELECT * FROM (SELECT o_orderkey, o_custkey, o_totalprice FROM orders) ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return tables.preview(rows, 100, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("SELECT md5(text) AS text_md5, count(*) AS cnt FROM documents GROUP BY ALL HAVING count(*) > 1")
def find_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    hashed = table(spark, sf, "documents").select(F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return tables.duplicate_keys(hashed, "text_md5")


@query("SELECT 0::BIGINT AS row_count FROM (SELECT count(*) FROM supplier)")
def truncate_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "truncate")
    table(spark, sf, "supplier").write.parquet(path)
    writers.truncate_table(spark, path)
    return tables.row_count(spark.read.parquet(path))


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN month(o_orderdate) = 3 THEN 2 ELSE 1 END AS run
    FROM orders WHERE month(o_orderdate) <> 3 OR o_orderkey % 2 = 0
""")
def replaced_days(spark: SparkSession, sf: str) -> DataFrame:
    """All months, then a second run with half of the rows of every March, twice: only these months are replaced."""
    path = scratch_path(spark, "days")
    rows = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    writers.replace_days(rows.withColumn("run", F.lit(1)), path, "month", ["o_orderkey"])
    march = rows.filter((F.substring("month", 6, 2) == "03") & (F.col("o_orderkey") % 2 == 0)).withColumn("run", F.lit(2))
    for _ in range(2):
        writers.replace_days(march, path, "month", ["o_orderkey"])
    return spark.read.schema("o_orderkey bigint, run int, month string").parquet(path).select("o_orderkey", "month", "run")
