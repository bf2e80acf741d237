"""Landing zone: routing, file metadata, flattening, schema-evolving append, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions.columns import as_col
from strandline.functions.text import non_empty_lines, split_lines, strip, word_count
from strandline.operators.cleaning import dedupe
from strandline.operators.embed import wav_header
from strandline.operators.enrich import fits_broadcast
from strandline.operators.membership import key_filter, might_hold
from strandline.operators.widening import common_schema, conform

# The landing layout.
TEMPORAL_PREFIX = "temporal_landing/"
PERSISTENT_PREFIX = "persistent_landing/"
REPORT_PREFIX = "meta_unstructured_"
REPORT_NAME_PREFIX = "meta_unstructured_report_"
REPORT_SUFFIX_CHARS = 12


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(as_col(path), "/"), -1)


def extension(name: Column | str) -> Column:
    """Lower-case suffix with its dot; a leading dot alone is not a suffix."""
    return F.lower(F.regexp_extract(as_col(name), r"^.+(\.[^./]+)$", 1))


def stem(name: Column | str) -> Column:
    return F.regexp_replace(as_col(name), r"^(.+)\.[^./]+$", "$1")


def route_objects(
    listing: DataFrame, name: str = "object_name", temporal: str = TEMPORAL_PREFIX, persistent: str = PERSISTENT_PREFIX
) -> DataFrame:
    """Add ``kind``, ``destination`` and ``metadata_destination`` to an object listing.

    CSV files go to the table at any depth; other known types only from the top
    folder. Everything else is ``skipped``. Folder entries are dropped.
    """
    path = F.col(name)
    listing = listing.filter((path != "") & (path != temporal) & ~path.endswith("/"))
    relative = F.when(path.startswith(temporal), F.substr(path, F.lit(len(temporal) + 1))).otherwise(path)
    relative = F.translate(F.btrim(relative, F.lit("/")), "\\", "/")
    file, top_level = base_name(relative), ~F.contains(relative, F.lit("/"))
    ext = extension(file)
    is_report = file.startswith(REPORT_PREFIX)
    kind = (
        F.when(F.lower(path).endswith(".csv"), "structured_csv")
        .when(~top_level, "skipped")
        .when((ext == ".json") & is_report, "camera_report")
        .when(ext == ".json", "semi_structured")
        .when(ext == ".wav", "audio")
        .when(ext == ".txt", "text")
        .otherwise("skipped")
    )
    bare = F.replace(file, F.lit(REPORT_NAME_PREFIX), F.lit(""))
    camera = F.substr(bare, F.lit(1), F.greatest(F.length(bare) - REPORT_SUFFIX_CHARS, F.lit(0)))
    root = F.lit(persistent)
    destination = (
        F.when(F.col("kind") == "camera_report", F.concat(root, F.lit("unstructured/images/metadata/"), camera, F.lit("/"), file))
        .when(F.col("kind") == "semi_structured", F.concat(root, F.lit("semi_structured/data/"), file))
        .when(F.col("kind") == "audio", F.concat(root, F.lit("unstructured/audio/data/"), file))
        .when(F.col("kind") == "text", F.concat(root, F.lit("unstructured/text/data/"), file))
    )
    about = (
        F.when(F.col("kind") == "semi_structured", F.concat(root, F.lit("semi_structured/metadata/metadata_"), file))
        .when(F.col("kind") == "text", F.concat(root, F.lit("unstructured/text/metadata/metadata_"), stem(file), F.lit(".json")))
        .when(F.col("kind") == "audio", F.concat(root, F.lit("unstructured/audio/metadata/metadata_"), stem(file), F.lit(".json")))
    )
    return listing.withColumn("kind", kind).withColumns({"destination": destination, "metadata_destination": about})


def land_new(listing: DataFrame, landed: DataFrame, name: str = "object_name") -> DataFrame:
    """Objects whose base name has not landed yet, one per base name (first path wins).

    The listing is reduced to one row per name before the anti join, so neither
    side of it can carry a hot key. Of the manifest only names that pass a filter over
    the listing's names are shuffled: it follows the new files, however many have landed. The
    listing is read twice.
    """
    listing = listing.withColumn("__base", base_name(name))
    candidates = dedupe(listing, ["__base"], [name])
    done = landed.select(base_name(name).alias("__base"))
    done = might_hold(done, ["__base"], key_filter(listing, ["__base"])).distinct()
    return candidates.join(done, "__base", "left_anti").drop("__base")


def first_n_files(listing: DataFrame, extensions: Sequence[str], n: int | None, name: str = "object_name") -> DataFrame:
    """Files with one of the extensions, the first ``n`` in name order."""
    wanted = listing.filter(extension(base_name(name)).isin([e.lower() for e in extensions])).orderBy(name)
    return wanted if n is None else wanted.limit(n)


def _file_metadata(name: str, content: Column, content_type: str, encoding: str | None = None) -> Column:
    fields = [
        base_name(name).alias("file_name"),
        F.col(name).alias("source_object_path"),
        F.col("destination").alias("persistent_data_path"),
        F.col("metadata_destination").alias("persistent_metadata_path"),
        F.octet_length(content).cast("bigint").alias("file_size_bytes"),
        F.sha2(content.cast("binary"), 256).alias("checksum_sha256"),
        F.lit(content_type).alias("content_type"),
    ]
    if encoding:
        fields.append(F.lit(encoding).alias("encoding"))
    # Spark prints timestamps in the session zone; the stamp is in UTC.
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.struct(*fields, stamp.alias("ingested_at_utc"))


def _missing(checks: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(absent, F.lit(n)) for n, absent in checks.items()]))


def weather_file_metadata(df: DataFrame, name: str = "object_name", content: str = "content") -> DataFrame:
    """Metadata of weather JSON files; the four sections as structs plus ``error``.

    Documents are parsed once into a VARIANT, which tells a JSON null from an
    absent field and accepts any nesting.
    """
    text = F.col(content).cast("string")
    staged = df.withColumn("__v", F.try_parse_json(text))
    doc = F.col("__v")

    def at(path: str, to: str = "string") -> Column:
        return F.try_variant_get(doc, path, to)

    def absent(path: str) -> Column:
        found = at(path, "variant")
        return found.isNull() | F.coalesce(F.is_variant_null(found), F.lit(False))

    # Null for anything but an object; only the top-level keys are read.
    properties = at("$.data.properties", "map<string,variant>")
    no_properties = F.coalesce(F.size(properties) < 1, F.lit(True))
    periods = at("$.data.properties.periods", "array<variant>")
    wrong_periods = at("$.data.properties.periods", "variant").isNotNull() & periods.isNull()
    valid_times = at("$.data.properties.validTimes")
    has_slash = F.contains(valid_times, F.lit("/"))
    endpoint = F.coalesce(at("$.metadata.endpoint"), F.lit(""))
    missing = _missing(
        {
            "metadata": absent("$.metadata"),
            "data": absent("$.data"),
            "data.properties": no_properties,
            "data.properties.periods": wrong_periods,
        }
    )
    source = F.struct(
        F.struct(
            at("$.metadata.location.name").alias("name"),
            at("$.metadata.location.lat", "double").alias("lat"),
            at("$.metadata.location.lon", "double").alias("lon"),
        ).alias("location"),
        F.struct(
            at("$.metadata.grid.office").alias("office"),
            at("$.metadata.grid.grid_x", "int").alias("grid_x"),
            at("$.metadata.grid.grid_y", "int").alias("grid_y"),
        ).alias("grid"),
        *[at(f"$.metadata.{n}").alias(n) for n in ("endpoint", "requested_at_utc", "source_url")],
    )
    about = F.struct(
        F.lit("weather_forecast").alias("schema_type"),
        F.when(F.contains(endpoint, F.lit("hourly")), "hourly").otherwise("daily").alias("granularity"),
        at("$.data.properties.generatedAt").alias("generated_at"),
        at("$.data.properties.updateTime").alias("update_time"),
        valid_times.alias("valid_times"),
        F.when(has_slash, F.split(valid_times, "/", 2)[0]).alias("valid_from"),
        F.when(has_slash, F.split(valid_times, "/", 2)[1]).alias("valid_duration"),
        F.coalesce(F.size(periods), F.lit(0)).alias("periods_count"),
        at("$.data.geometry.type").alias("geometry_type"),
        at("$.data.properties.units").alias("units"),
    )
    quality = F.struct(
        F.lit(True).alias("is_valid_json"),
        (F.size("__missing") == 0).alias("has_required_fields"),
        F.col("__missing").alias("missing_fields"),
        F.coalesce(F.size(periods) > 0, F.lit(False)).alias("has_periods"),
    )
    invalid = doc.isNull()
    return staged.withColumn("__missing", missing).select(
        F.col(name),
        F.when(~invalid, _file_metadata(name, text, "application/json")).alias("file_metadata"),
        F.when(~invalid, source).alias("source_metadata"),
        F.when(~invalid, about).alias("content_metadata"),
        F.when(~invalid, quality).alias("quality_metadata"),
        F.when(invalid, F.lit("invalid_json")).alias("error"),
    )


def text_file_metadata(
    df: DataFrame, name: str = "object_name", content: str = "content", dataset: str | None = None
) -> DataFrame:
    """Metadata of article text files: first six non-empty lines, counts and flags."""
    raw = F.col(content).cast("binary")
    staged = df.withColumn("__text", F.make_valid_utf8(raw.cast("string")))
    staged = staged.withColumn("__lines", split_lines("__text")).withColumn("__full", non_empty_lines(F.col("__lines")))
    names = ("headline", "category", "authors", "published_date", "short_description", "source_url")
    part = {n: F.get("__full", F.lit(i)) for i, n in enumerate(names)}
    staged = staged.withColumn("__missing", _missing({n: c.isNull() for n, c in part.items()}))
    about = F.struct(
        F.lit("news_article_text").alias("schema_type"),
        *[part[n].alias(n) for n in names[:4]],
        F.size("__lines").alias("line_count"),
        F.size("__full").alias("non_empty_line_count"),
        word_count("__text").alias("word_count"),
        F.length("__text").alias("character_count"),
        F.coalesce(F.length(part["headline"]), F.lit(0)).alias("headline_length_chars"),
        F.coalesce(F.length(part["short_description"]), F.lit(0)).alias("summary_length_chars"),
        part["source_url"].isNotNull().alias("has_source_url"),
    )
    quality = F.struct(
        F.is_valid_utf8(raw.cast("string")).alias("is_utf8_decodable"),
        (F.size("__missing") == 0).alias("has_expected_article_fields"),
        F.col("__missing").alias("missing_fields"),
        (F.size("__full") >= 6).alias("has_minimum_expected_lines"),
        (strip("__text") == "").alias("is_empty_file"),
    )
    source = F.struct(
        F.lit(dataset).cast("string").alias("source_dataset"),
        part["source_url"].alias("source_url"),
        stem(base_name(name)).alias("record_id"),
    )
    return staged.select(
        F.col(name),
        _file_metadata(name, raw, "text/plain", "utf-8").alias("file_metadata"),
        source.alias("source_metadata"),
        about.alias("content_metadata"),
        quality.alias("quality_metadata"),
    )


def wav_file_metadata(
    df: DataFrame, name: str = "object_name", content: str = "content", dataset: str | None = None
) -> DataFrame:
    """Metadata of WAV files; nulls and ``is_valid_wav = false`` for anything else."""
    raw = F.col(content)
    staged = df.withColumn("__h", wav_header(raw))
    header = {
        n: F.col(f"__h.{n}")
        for n in ("duration_seconds", "sample_rate_hz", "channels", "sample_width_bytes", "frame_count")
    }
    return staged.select(
        F.col(name),
        _file_metadata(name, raw, "audio/wav").alias("file_metadata"),
        F.struct(F.lit(dataset).cast("string").alias("source_dataset"), stem(base_name(name)).alias("record_id")).alias("source_metadata"),
        F.struct(
            F.lit("audio_recording").alias("schema_type"),
            F.lit("wav").alias("audio_format"),
            *[c.alias(n) for n, c in header.items()],
        ).alias("content_metadata"),
        F.struct(F.col("__h.is_valid_wav").alias("is_valid_wav"), (F.octet_length(raw) == 0).alias("is_empty_file")).alias("quality_metadata"),
    )


def flatten(df: DataFrame, json_arrays: bool = True) -> DataFrame:
    """Nested structs to dotted columns; arrays and maps as JSON text, untyped nulls as strings."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            source = F.col(".".join(f"`{p}`" for p in here))
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
                continue
            if json_arrays and isinstance(f.dataType, (T.ArrayType, T.MapType)):
                source = F.to_json(source)
            elif isinstance(f.dataType, T.NullType):
                source = source.cast("string")
            out.append(source.alias(".".join(here)))
        return out

    return df.select(*leaves(df.schema))


def evolve_append(*frames: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there, one of unlike types has the widest of them (``widening``)."""
    schema = common_schema(f.schema for f in frames)
    return reduce(DataFrame.unionByName, [conform(f, schema) for f in frames])


def landing_summary(df: DataFrame, kind: str = "kind", error: str = "error") -> DataFrame:
    """Objects seen, processed and failed per kind."""
    failed = F.col(error).isNotNull()
    return df.groupBy(kind).agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(~failed).alias("processed"),
        F.count_if(failed).alias("failed"),
    )


def part_counts(df: DataFrame, file: str = "source_file") -> DataFrame:
    """Rows per source file."""
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("row_count"))


def number_lines(lines: DataFrame) -> DataFrame:
    """1-based line numbers for ``(source_file, block_start, row_id, value)`` rows.

    ``row_id`` must rise in file order within a block (as
    ``monotonically_increasing_id`` over a text scan does). Only one row per file
    block is combined; the lines are neither sorted nor, while the block table is
    of broadcast size, shuffled.
    """
    block = ["source_file", "block_start"]
    sizes = lines.groupBy(*block).agg(F.count(F.lit(1)).alias("__n"), F.min("row_id").alias("__first"))
    before = Window.partitionBy("source_file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n").persist()
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    numbered = lines.join(offsets, block)
    line = F.col("row_id") - F.col("__first") + F.col("__before") + 1
    return numbered.withColumn("line_number", line).drop("__first", "__before")
