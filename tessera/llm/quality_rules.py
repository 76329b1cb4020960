"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over more of them.

The trees are fitted to `labels.quality` on at most `sample` labelled documents, those whose ids hash lowest; every
document is then scored. A document can only lose by more symbols, repeated words or repeated lines (monotonic
constraints). It is kept if it passes the limits and the trees give it a chance of `keep` or more to be good.

Defined results. Null or empty text: no words, so it fails the limits. Null id: scored like any other. Repeated rows:
each is scored. No labels, or labels of one kind: the trees keep everything. A document labelled twice counts by its
highest label; null labels don't count. Ids of labelled rows are integers; others are an error. Very long texts are read
whole. Empty table: no rows. Other columns pass through; one named as `into` (judged) is replaced by `judge_quality`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import boosting
from tessera.llm.statistics import COUNTS, FEATURES, of_texts

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
#: Labelled documents that the trees see at most, and the chance from which they keep a document.
SAMPLE, KEEP = 12_000, 0.35
MONOTONE = {FEATURES.index(f): -1 for f in ("symbol_share", "dup_line_share", "repeat_share", "echo_share")}

VERDICT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,score:double,kept:boolean>"


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most `sample` labelled documents: those whose ids hash lowest."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, features = of_texts(batch.column("text"))
        rows = pa.FixedSizeListArray.from_arrays(pa.array(features.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), rows], names=["id", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> boosting.Trees:
    seen = labelled_sample(docs, labels, "quality", sample, id_col, text_col)
    seen = seen.select(F.col("id").cast("long").alias("id"), "label", "text").mapInArrow(_features, "id long, label int, features array<double>")
    one = seen.groupBy("id").agg(F.min(F.struct("features", "label")).alias("r"))  # rows that repeat an id count once
    rows = sorted((r.id, r.r.features, r.r.label) for r in one.collect())
    x = np.array([r[1] for r in rows]).reshape(-1, len(FEATURES))
    return boosting.fit(x, np.array([r[2] for r in rows], dtype=float), MONOTONE)


def scorer(trees: boosting.Trees, keep: float = KEEP) -> Callable:
    @F.arrow_udf(VERDICT)
    def judge(texts: pa.Array) -> pa.Array:
        counts, features = of_texts(texts)
        n, repeats = counts[:, 0], counts[:, 4]
        failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n)
        score = trees.probability(features)
        kept = ~failed & ((score >= keep) | (len(trees.roots) == 0))
        columns = [*(pa.array(counts[:, i].astype(np.int64)) for i in range(len(COUNTS))), pa.array(failed), pa.array(score), pa.array(kept)]
        return pa.StructArray.from_arrays(columns, names=[*COUNTS, "base_failed", "score", "kept"])

    return judge


def judge_quality(docs: DataFrame, labels: DataFrame, into: str = "judged", text_col: str = "text", id_col: str = "doc_id", keep: float = KEEP, sample: int = SAMPLE) -> DataFrame:
    """`docs` with a struct column `into`: the statistics, base_failed, score and kept."""
    trees = fit(docs, labels, sample, id_col, text_col)
    return docs.withColumn(into, scorer(trees, keep)(F.col(text_col)))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their columns as they were."""
    into = "__judged"
    return judge_quality(docs, labels, into=into, **options).where(F.col(into)["kept"]).drop(into)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: statistics and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select("doc_id", *(F.col(f"judged.{c}").alias(c) for c in (*COUNTS, "base_failed", "kept", "score")))
