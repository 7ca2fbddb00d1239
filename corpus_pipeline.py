"""A corpus pipeline: each stage calls one operator on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almenara.llm.decontaminate import decontaminate
from almenara.llm.line_dedup import line_dedup
from almenara.llm.mixing import mix_sources
from almenara.llm.near_dup import drop_near_duplicates
from almenara.llm.quality_rules import quality_rules
from almenara.llm.tables import release, stored

#: latent semantic retrieval has no SQL form
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules(docs).where("_kept").select(docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller id holds too."""
    fewer = line_dedup(docs).select(docs.columns)
    return fewer.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by 5-word shingles and a similarity of 0.8."""
    return drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    mixed = mix_sources(docs)
    return mixed.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_shared_lines),
    ("MinHash near-dedup", one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
