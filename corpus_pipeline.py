"""Documents to training batches: five stages, each written and read again by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import jaccard, packing, quality, secrets, toxicity
from strandline.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The classifier's rows have no SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and every certified cutoff."""
    measured = materialize(quality.measure(docs, keep=COLUMNS), "pipeline-quality")
    cutoffs = quality.certify(measured.drop("text"), _labels(spark, sf_dir))
    return quality.verdicts(measured, cutoffs).where("kept").select(*COLUMNS)


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold."""
    model = toxicity.fit(docs, _labels(spark, sf_dir), lambda df: materialize(df, "pipeline-toxicity"))
    return docs.select(*COLUMNS).mapInArrow(toxicity.keeper(model), docs.select(*COLUMNS).schema)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least doc_id."""
    return jaccard.keep_one(docs.select(*COLUMNS), lambda df: materialize(df, "pipeline-jaccard"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found replaced by a mark; n_chars follows the new text."""
    found = secrets.find(docs, lambda df: materialize(df, "pipeline-secrets"), keep=("doc_id", "lang", "source"), body=True)
    text = F.when(F.size("spans") > 0, secrets.redacted()).otherwise(F.col("body"))
    out = found.select("doc_id", text.alias("text"), "lang", "source")
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in buckets of length and batches of a token budget."""
    return packing.pack(docs, lambda df: materialize(df, "pipeline-packing"))


STAGES = [
    ("quality rules", keep_quality),
    ("toxicity", keep_harmless),
    ("n-gram Jaccard join", keep_distinct),
    ("secret scan", hide_secrets),
    ("packing", pack_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
