"""Exploitation-zone queries: averages, enrichment, embeddings, similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.hashing import dense_hash, l2_norm
from strandline.functions.text import PREVIEW_CHARS, WHITESPACE, truncate_bytes as clip
from strandline.operators import cellindex, embed, enrich, pivots, similarity
from strandline.plans import collisions
from strandline.plans.catalog import inputs
from strandline.plans.catalog.inputs import DEDUPED_SQL, registry, table, wide
from strandline.plans.catalog.trusted import CLEANED_WAV_SQL
from strandline.session import materialize, scratch_path

QUERIES, query = registry()

_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("""
    SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_l_quantity, round(avg(l_extendedprice), 4) AS avg_l_extendedprice,
           round(avg(l_discount), 6) AS avg_l_discount, round(avg(l_tax), 6) AS avg_l_tax
    FROM lineitem GROUP BY l_returnflag
""")
def avg_by_group(spark: SparkSession, sf: str) -> DataFrame:
    means = enrich.mean_by(table(spark, sf, "lineitem"), "l_returnflag", (*_MEASURES, "absent"))
    digits = {"avg_l_extendedprice": 4}
    return means.select("l_returnflag", *[F.round(c, digits.get(c, 6)).alias(c) for c in means.columns[1:]])


def _keyed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by segment and nation; one segment has no key."""
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string"))
    )
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", key.alias("borough"))


def _segment_means(spark: SparkSession, sf: str) -> DataFrame:
    """Mean order price per key, of all orders; the keys of one segment are renamed, so they stay unmatched."""
    orders, customers = table(spark, sf, "orders"), _keyed_customers(spark, sf)
    renamed = F.when(F.col("borough").startswith("MACHINERY"), F.concat(F.col("borough"), F.lit("-x"))).otherwise(F.col("borough"))
    rows = orders.join(customers.withColumn("borough", renamed), F.col("o_custkey") == F.col("c_custkey"))
    return enrich.mean_by(rows.withColumnRenamed("o_totalprice", "temperature"), "borough")


_KEYED_SQL = """
    keyed AS (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment || '-' || c_nationkey END AS borough FROM customer),
    means AS (SELECT CASE WHEN borough LIKE 'MACHINERY%' THEN borough || '-x' ELSE borough END AS borough, avg(o_totalprice) AS avg_temperature
              FROM orders JOIN keyed ON o_custkey = c_custkey GROUP BY 1),
    joined AS (SELECT keyed.c_custkey, keyed.borough, avg_temperature FROM keyed LEFT JOIN means USING (borough)
               WHERE keyed.borough <> '')
"""


@query("""
    SELECT count(*) FILTER (c_mktsegment <> 'BUILDING') AS kept_rows, count(*) FILTER (c_mktsegment = 'BUILDING') AS dropped_rows
    FROM customer
""")
def blank_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.blank_key_counts(_keyed_customers(spark, sf), "borough")


@query(f"WITH {_KEYED_SQL} SELECT c_custkey, borough, round(avg_temperature, 4) AS avg_temperature FROM joined")
def enrich_left_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = enrich.enrich(_keyed_customers(spark, sf), _segment_means(spark, sf), "borough")
    return joined.select("c_custkey", "borough", F.round("avg_temperature", 4).alias("avg_temperature"))


@query(f"WITH {_KEYED_SQL} SELECT c_custkey, borough, round(avg_temperature, 4) AS avg_temperature FROM joined")
def enrich_large_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The same join with the broadcast bound forced to zero: hot keys apart, the rest shuffled."""
    joined = enrich.enrich(_keyed_customers(spark, sf), _segment_means(spark, sf), "borough", max_rows=0)
    return joined.select("c_custkey", "borough", F.round("avg_temperature", 4).alias("avg_temperature"))


@query(f"""
    WITH {_KEYED_SQL} SELECT count(*) AS total_rows, count(avg_temperature) AS matched_rows,
                             count(*) - count(avg_temperature) AS unmatched_rows FROM joined
""")
def match_counts(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.match_counts(enrich.enrich(_keyed_customers(spark, sf), _segment_means(spark, sf), "borough"))


@query("SELECT source, count(*) AS row_count FROM documents GROUP BY source ORDER BY row_count DESC, source LIMIT 10")
def top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.top_counts(table(spark, sf, "documents"), "source", 10)


@query(f"""
    WITH {DEDUPED_SQL},
    clean AS (SELECT upper(trim(borough)) AS borough, strftime(o_orderdate, '%Y-%m-%d') AS crash_date,
                     coalesce(split_part(collision_id, '.', 1)::BIGINT, 0) AS collision_id, number_of_persons_injured, source_file
              FROM kept WHERE ok AND borough IS NOT NULL),
    weather AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'AFRICA' WHEN '2-HIGH' THEN 'ASIA' WHEN '3-MEDIUM' THEN 'EUROPE' ELSE 'UNKNOWN' END AS borough,
                       abs(o_custkey % 60 - 10)::DOUBLE AS t, (o_custkey % 20)::DOUBLE AS w, (o_custkey % 30 + 0.5)::DOUBLE AS d,
                       (o_custkey % 7)::DOUBLE AS p, (o_custkey % 100)::DOUBLE AS h
                FROM orders WHERE o_orderstatus <> 'P'),
    means AS (SELECT borough, sum(2 * t) / count(*) / 2 AS avg_temperature, avg(w) AS avg_wind_speed_mph, sum(d) / (3 * count(*)) AS avg_dewpoint_celsius,
                     sum(p) / (3 * count(*)) AS avg_precip_prob, sum(h) / (3 * count(*)) AS avg_humidity FROM weather GROUP BY borough)
    SELECT collision_id, crash_date, borough, number_of_persons_injured, source_file,
           round(avg_temperature, 6) AS avg_temperature, round(avg_wind_speed_mph, 6) AS avg_wind_speed_mph,
           round(avg_dewpoint_celsius, 6) AS avg_dewpoint_celsius, round(avg_precip_prob, 6) AS avg_precip_prob,
           round(avg_humidity, 6) AS avg_humidity
    FROM clean LEFT JOIN means USING (borough)
""")
def enriched_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole structured flow: strings to clean facts, forecasts to averages, left join."""
    from strandline.operators import documents as docs

    rules = (("(?i)manhattan", "AFRICA"), ("(?i)bronx", "ASIA"), ("(?i)brooklyn", "EUROPE"))
    parsed = docs.parse_documents(inputs.weather_texts(spark, sf), docs.WEATHER_SCHEMA)
    weather = docs.weather_rows(docs.explode_periods(parsed), rules)
    enriched = collisions.enrich_collisions(inputs.collision_strings(spark, sf), weather, order_by=["source_file"])
    means = [c for c in enriched.columns if c.startswith("avg_")]
    return enriched.select(
        "collision_id",
        F.date_format("crash_date", "yyyy-MM-dd").alias("crash_date"),
        "borough",
        "number_of_persons_injured",
        "source_file",
        *[F.round(c, 6).alias(c) for c in means],
    )


# --- text embeddings -----------------------------------------------------------

_FIELDS_SQL = f"""
    body AS (SELECT doc_id, trim(text, '{WHITESPACE}') AS body FROM documents),
    lines AS (SELECT doc_id, body, list_filter(list_transform(string_split(body, chr(10)), lambda l: trim(l, '{WHITESPACE}')),
                                               lambda l: l <> '') AS f FROM body),
    -- DuckDB keeps a sharp s when upper-casing; full case mapping gives SS.
    fields AS (SELECT doc_id, body, coalesce(f[1], '') AS headline,
                      CASE WHEN coalesce(f[2], '') = '' THEN 'UNKNOWN' ELSE upper(replace(f[2], 'ß', 'ss')) END AS category,
                      coalesce(f[3], '') AS authors, coalesce(f[4], '') AS pub_date,
                      substr(trim(coalesce(f[1], '') || ' ' || coalesce(f[5], ''), '{WHITESPACE}'), 1, 500) AS content_preview
               FROM lines)
"""


def _hash_sql(source: str, text: str) -> str:
    return f"""
    tokens AS (SELECT doc_id, regexp_extract_all(lower({text}), '[a-z0-9]+') AS t FROM {source}),
    grams AS (SELECT doc_id, unnest(t) AS g, 1.0::DOUBLE AS w FROM tokens
              UNION ALL SELECT doc_id, p[1] || '_' || p[2], 0.5
              FROM (SELECT doc_id, unnest(list_transform(list_zip(t[1:len(t) - 1], t[2:len(t)]), lambda z: [z[1], z[2]])) AS p FROM tokens)),
    placed AS (SELECT doc_id, w, md5(g) AS d FROM grams),
    vec AS (SELECT doc_id, ('0x' || substr(d, 15, 2))::INT & 127 AS bucket,
                   sum(CASE WHEN ('0x' || substr(d, 8, 1))::INT & 1 = 1 THEN w ELSE -w END) AS weight
            FROM placed GROUP BY ALL)
    """


@query(f"""
    WITH {_FIELDS_SQL}
    SELECT doc_id, md5(headline) AS headline_md5, md5(category) AS category_md5, authors, pub_date, md5(content_preview) AS preview_md5,
           length(body) AS char_count, len(regexp_extract_all(body, '[^{WHITESPACE}]+')) AS word_count
    FROM fields
""")
def article_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = embed.article_fields(wide(spark, sf, "documents"), "text", preview_chars=PREVIEW_CHARS)
    digest = lambda c: F.md5(F.col(c).cast("binary"))
    return rows.select(
        "doc_id",
        digest("headline").alias("headline_md5"),
        digest("category").alias("category_md5"),
        "authors",
        "pub_date",
        digest("content_preview").alias("preview_md5"),
        "char_count",
        "word_count",
    )


@query(f"WITH {_hash_sql('documents', 'text')} SELECT doc_id, bucket, weight FROM vec WHERE weight <> 0")
def hash_embedding_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return embed.hash_embedding(wide(spark, sf, "documents"), "doc_id", "text", sparse=True)


@query(f"""
    WITH {_hash_sql('documents', 'text')},
    norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM vec GROUP BY doc_id)
    SELECT doc_id, bucket, (weight / norm)::FLOAT::DOUBLE AS value FROM vec JOIN norms USING (doc_id) WHERE weight <> 0
""")
def hash_embedding_dense(spark: SparkSession, sf: str) -> DataFrame:
    rows = embed.hash_embedding(wide(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    long = rows.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "value")).filter("value <> 0")
    return long.select("doc_id", "bucket", F.col("value").cast("double").alias("value"))


@query(f"""
    WITH {_hash_sql('documents', 'text')} SELECT doc_id, round(sqrt(sum(weight * weight)), 6) AS norm FROM vec GROUP BY doc_id
""")
def hash_embedding_norm(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide(spark, sf, "documents").select("doc_id", dense_hash(embed.TEXT_DIM, normalize=False)("text").alias("v"))
    # a generator, since the filter would go below a projection and hash every text a second time, before the rows are spread
    return rows.select("doc_id", F.explode_outer(F.array(F.round(l2_norm("v"), 6))).alias("norm")).filter("norm > 0")


@query(f"""
    WITH {_FIELDS_SQL},
    chosen AS (SELECT doc_id, CASE WHEN content_preview = '' THEN body ELSE content_preview END AS e FROM fields),
    {_hash_sql('chosen', 'e')},
    norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM vec GROUP BY doc_id)
    SELECT doc_id, bucket, (weight / norm)::FLOAT::DOUBLE AS value FROM vec JOIN norms USING (doc_id) WHERE weight <> 0
""")
def article_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    rows = embed.embed_articles(wide(spark, sf, "documents").select("doc_id", "text"), preview_chars=PREVIEW_CHARS)
    long = rows.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "value")).filter("value <> 0")
    return long.select("doc_id", "bucket", F.col("value").cast("double").alias("value"))


@query(f"""
    WITH {_FIELDS_SQL}, {_hash_sql('fields', 'body')},
    norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM vec GROUP BY doc_id)
    SELECT doc_id, bucket, (weight / norm)::FLOAT::DOUBLE AS value FROM vec JOIN norms USING (doc_id) WHERE weight <> 0
""")
def article_embeddings_full(spark: SparkSession, sf: str) -> DataFrame:
    """The default: every text embedded as a whole."""
    rows = embed.embed_articles(wide(spark, sf, "documents").select("doc_id", "text"))
    long = rows.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "value")).filter("value <> 0")
    return long.select("doc_id", "bucket", F.col("value").cast("double").alias("value"))


@query("""
    WITH raw AS (SELECT doc_id, text, hex(encode(text)) AS h, strlen(text) AS n FROM documents),
    -- A continuation byte starts with hex 8, 9, A or B; step back from the cut while the next byte is one.
    cut AS (SELECT *, 512 - CASE WHEN substr(h, 1025, 1) NOT IN ('8', '9', 'A', 'B') THEN 0
                                 WHEN substr(h, 1023, 1) NOT IN ('8', '9', 'A', 'B') THEN 1
                                 WHEN substr(h, 1021, 1) NOT IN ('8', '9', 'A', 'B') THEN 2 ELSE 3 END AS keep FROM raw)
    SELECT doc_id, md5(decode(unhex(CASE WHEN n <= 512 THEN h ELSE substr(h, 1, 2 * keep) END))) AS clipped_md5,
           CASE WHEN n <= 512 THEN n ELSE keep END::INT AS clipped_bytes
    FROM cut
""")
def truncate_bytes(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide(spark, sf, "documents").select("doc_id", clip("text", 512).alias("t"))
    return rows.select("doc_id", F.md5(F.col("t").cast("binary")).alias("clipped_md5"), F.octet_length("t").alias("clipped_bytes"))


# --- audio and vectors -----------------------------------------------------------


def _features_sql(source: str, width: str) -> str:
    """Windowed statistics of rows (vec_id, k, x); ``width`` samples per window, tail already cut."""
    return f"""
    stepped AS (SELECT vec_id, k // {width} AS win, x,
                       sign(x) <> sign(lag(x) OVER (PARTITION BY vec_id, k // {width} ORDER BY k)) AS crossed FROM {source}),
    stats AS (SELECT vec_id, win, sqrt(avg(x * x)) AS rms, avg(abs(x)) AS mag, stddev_pop(x) AS dev,
                     count(*) FILTER (crossed) / (count(*) - 1)::DOUBLE AS zcr FROM stepped GROUP BY ALL),
    feats AS (SELECT vec_id, win AS pos, rms AS v FROM stats UNION ALL SELECT vec_id, 16 + win, mag FROM stats
              UNION ALL SELECT vec_id, 32 + win, dev FROM stats UNION ALL SELECT vec_id, 48 + win, zcr FROM stats),
    norms AS (SELECT vec_id, sqrt(sum(v * v)) AS norm FROM feats GROUP BY vec_id)
    """


@query(f"""
    WITH sig AS (SELECT vec_id, r.i AS k, embedding[r.i + 1]::DOUBLE AS x FROM embeddings, range(64) r(i)),
    {_features_sql('sig', '4')}
    SELECT vec_id, pos::INT AS pos, round(v / norm, 6) AS value FROM feats JOIN norms USING (vec_id)
""")
def window_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = embed.window_features(wide(spark, sf, "embeddings"), "embedding")
    return rows.select("vec_id", F.posexplode_outer("features").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(f"""
    WITH {CLEANED_WAV_SQL},
    sizes AS (SELECT vec_id, count(*) AS n FROM cleaned GROUP BY vec_id),
    sig AS (SELECT vec_id, k * 16 // (n - n % 16) AS win, k, x / 32768.0 AS x
            FROM cleaned JOIN sizes USING (vec_id) WHERE k < n - n % 16),
    stepped AS (SELECT vec_id, win, x, sign(x) <> sign(lag(x) OVER (PARTITION BY vec_id, win ORDER BY k)) AS crossed FROM sig),
    stats AS (SELECT vec_id, win, sqrt(avg(x * x)) AS rms, avg(abs(x)) AS mag, count(*) FILTER (crossed) / (count(*) - 1)::DOUBLE AS zcr,
                     stddev_pop(x) AS dev FROM stepped GROUP BY ALL),
    feats AS (SELECT vec_id, win AS pos, rms AS v FROM stats UNION ALL SELECT vec_id, 16 + win, mag FROM stats
              UNION ALL SELECT vec_id, 32 + win, dev FROM stats UNION ALL SELECT vec_id, 48 + win, zcr FROM stats),
    norms AS (SELECT vec_id, sqrt(sum(v * v)) AS norm FROM feats GROUP BY vec_id)
    SELECT vec_id, pos::INT AS pos, round((v / norm)::FLOAT::DOUBLE, 4) AS value, round((n / 16000.0)::FLOAT::DOUBLE, 4) AS duration_s,
           16000::BIGINT AS sample_rate, 1::BIGINT AS num_channels
    FROM feats JOIN norms USING (vec_id) JOIN sizes USING (vec_id)
""")
def audio_embedding(spark: SparkSession, sf: str) -> DataFrame:
    clean = embed.clean_audio(inputs.wav_table(spark, sf)).filter("skip_reason is null").select("vec_id", "cleaned")
    rows = embed.embed_audio(clean, "cleaned")
    long = rows.select("vec_id", "duration_s", "sample_rate", "num_channels", F.posexplode_outer("embedding").alias("pos", "value"))
    return long.withColumns(
        {c: F.round(F.col(c).cast("double"), 4) for c in ("value", "duration_s")}
    )


@query("SELECT count(*) AS vector_count, count(*) FILTER (len(embedding) <> 64) AS wrong_dim_count FROM embeddings")
def vector_guard(spark: SparkSession, sf: str) -> DataFrame:
    return embed.check_dimension(table(spark, sf, "embeddings"), 64)


_COSINE_SQL = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
    u AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN norm > 0 THEN x / norm ELSE 0 END) AS e FROM n),
    s AS (SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.e, b.e), 12) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id)
    SELECT query_id, vec_id, round(score, 6) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM s QUALIFY rank <= 10
"""


@query(_COSINE_SQL)
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    found = similarity.cosine_topk(vectors, vectors, 10, skip_self=True)
    return found.withColumn("score", F.round("score", 6))


@query(_COSINE_SQL)
def cosine_topk_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The same result through the block grid used for query sets too large to broadcast."""
    vectors = table(spark, sf, "embeddings")
    found = similarity.cosine_topk(vectors, vectors, 10, skip_self=True, max_values=64, block_rows=400)
    return found.withColumn("score", F.round("score", 6))


@query("""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
    n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
    u AS (SELECT vec_id, list_transform(e, lambda x: CASE WHEN norm > 0 THEN x / norm ELSE 0 END) AS e FROM n),
    c AS (SELECT row_number() OVER (ORDER BY vec_id) AS cell, e FROM u QUALIFY cell <= 32),
    near AS (SELECT vec_id, cell, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_dot_product(u.e, c.e), 12) DESC, cell) AS place FROM u, c),
    s AS (SELECT q.vec_id AS query_id, t.vec_id, round(list_dot_product(a.e, b.e), 12) AS score
          FROM near q JOIN near t ON q.cell = t.cell AND q.place <= 8 AND t.place = 1 AND q.vec_id <> t.vec_id
          JOIN u a ON a.vec_id = q.vec_id JOIN u b ON b.vec_id = t.vec_id)
    SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM s QUALIFY rank <= 10
""")
def ivf_topk(spark: SparkSession, sf: str) -> DataFrame:
    """8 of 32 given cells probed: the vectors of the least ids are the cells, so the answer is fixed. Trained cells are tested for recall."""
    vectors = table(spark, sf, "embeddings")
    first = vectors.orderBy("vec_id").limit(32).orderBy("vec_id").select("embedding").collect()
    cells = similarity.unit_rows([r[0] for r in first])
    found = similarity.ivf_topk(vectors, vectors, cells, 10, nprobe=8, skip_self=True)
    return found.withColumn("score", F.round("score", 6))


@query(_COSINE_SQL)
def ivf_topk_all_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Probing every cell must give the exact answer."""
    vectors = table(spark, sf, "embeddings")
    cells = similarity.train_cells(vectors, 8)
    found = similarity.ivf_topk(vectors, vectors, cells, 10, nprobe=8, skip_self=True)
    return found.withColumn("score", F.round("score", 6))


@query(_COSINE_SQL)
def cell_index_additions(spark: SparkSession, sf: str) -> DataFrame:
    """A stored index of half of the rows, the rest added in two steps; with all cells probed the answer is exact."""
    path = scratch_path(spark, "cell-index")
    vectors = table(spark, sf, "embeddings")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(4))
    cellindex.build_index(vectors.filter(part < 2), path, 8)
    for step in (2, 3):
        cellindex.add_vectors(vectors.filter(part == step), path)
    return cellindex.search_index(vectors, path, 10, nprobe=8, skip_self=True).withColumn("score", F.round("score", 6))


@query("""
    SELECT count(*) AS queries, sum(least(10, total - 1))::BIGINT AS returned_rows, true AS recall_reached
    FROM (SELECT (SELECT count(*) FROM embeddings) AS total FROM embeddings)
""")
def cell_index_recall(spark: SparkSession, sf: str) -> DataFrame:
    """All rows searched at the calibrated number of probes: at least 0.9 of the exact neighbours are found."""
    path = scratch_path(spark, "cell-index")
    vectors = table(spark, sf, "embeddings")
    cellindex.build_index(vectors, path, 32)
    cellindex.calibrate(spark, path, 10, target=0.9)
    found = materialize(cellindex.search_index(vectors, path, 10, skip_self=True), "found")
    recall = similarity.recall_at_k(found, similarity.cosine_topk(vectors, vectors, 10, skip_self=True))
    counted = found.agg(F.countDistinct("query_id").alias("queries"), F.count(F.lit(1)).alias("returned_rows"))
    return counted.crossJoin(F.broadcast(recall.select((F.col("recall") >= 0.9).alias("recall_reached"))))


@query("SELECT o_orderkey, o_totalprice, 'o_orderkey,o_totalprice,exploited_at' AS columns, true AS fresh FROM orders")
def restamped(spark: SparkSession, sf: str) -> DataFrame:
    """Both old load times go, one new one comes."""
    old = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("trusted_at"), F.col("o_orderdate").alias("exploited_at"))
    rows = enrich.restamp(old)
    fresh = F.col("exploited_at") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return rows.select("o_orderkey", "o_totalprice", F.lit(",".join(rows.columns)).alias("columns"), fresh.alias("fresh"))


@query("""
    SELECT vec_id, vec_id % 5 < 3 AS failed, vec_id % 5 >= 3 AS filled, false AS mixed FROM embeddings
""")
def audio_embedding_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Cut, foreign and missing bytes: such rows hold an error and nulls, all others a full result; the job goes on."""
    raw = F.expr("CASE vec_id % 5 WHEN 0 THEN substring(raw, 1, 20) WHEN 1 THEN cast('no sound at all' AS binary) WHEN 2 THEN NULL ELSE raw END")
    rows = embed.embed_audio(inputs.wav_table(spark, sf).select("vec_id", raw.alias("raw")))
    fields = [F.col(c).isNotNull() for c in ("embedding", "duration_s", "sample_rate", "num_channels")]
    any_, all_ = fields[0], fields[0]
    for f in fields[1:]:
        any_, all_ = any_ | f, all_ & f
    failed = F.col("error").isNotNull()
    return rows.select("vec_id", failed.alias("failed"), all_.alias("filled"), ((any_ != all_) | (failed == any_)).alias("mixed"))


@query(_COSINE_SQL)
def cosine_topk_pivots(spark: SparkSession, sf: str) -> DataFrame:
    """The same result by rings around pivots; rings that cannot hold a neighbour are left out."""
    vectors = table(spark, sf, "embeddings")
    found, _ = pivots.pivot_topk(vectors, vectors, similarity.train_cells(vectors, 16), 10, skip_self=True)
    return found.withColumn("score", F.round("score", 6))
