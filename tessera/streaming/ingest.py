"""Structured Streaming ingestion: an extension beyond the batch operators.

Documents arrive as files or any stream of (document_id, text, arrived_at); exact duplicates within the watermark are
dropped by content, units are parsed by the batch parsers, and each micro-batch is committed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import content_hash
from tessera.operators import parsers


def watch_folder(spark: SparkSession, path: str, schema: str = "document_id string, text string, arrived_at timestamp", max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def deduplicated(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Without documents whose content came before within `delay`."""
    hashed = stream.withColumn("content_hash", content_hash(F.col("text")))
    return hashed.withWatermark("arrived_at", delay).dropDuplicatesWithinWatermark(["content_hash"])


def paragraphs(stream: DataFrame) -> DataFrame:
    return parsers.parse_plain_text(stream)


def arrivals(stream: DataFrame, window: str = "5 minutes", delay: str = "1 hour") -> DataFrame:
    """Documents and characters by window of arrival."""
    windowed = stream.withWatermark("arrived_at", delay).groupBy(F.window("arrived_at", window))
    return windowed.agg(F.count("*").alias("n_documents"), F.sum(F.length("text")).alias("n_chars")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n_documents", "n_chars")


def start_ingest(stream: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Writes units under `out`, a folder for each batch number: a batch that runs again replaces its own folder."""

    def commit(batch: DataFrame, number: int) -> None:
        parsers.parse_plain_text(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = deduplicated(stream).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
