"""A corpus pipeline: each stage works on all that the one before kept, and its decisions take effect.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; the mix adds copy, shard and place.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, mixing, pii, quality_rules


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and n_chars to match."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources to their target weights, a row for each draw."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("source_mixing", mixed),
]

#: Learned and sketched stages have no SQL counterpart; tests hold run() against a brute-force version.
ORACLE_SQL = None


def _folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place the session names; a temporary one only where it names none in local mode, as in tests."""
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    shared = shared or tempfile.mkdtemp(prefix="tessera-pipeline-")
    return f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), _folder(spark)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
