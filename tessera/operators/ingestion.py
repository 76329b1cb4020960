"""Planning and persisting documents, sources and runs (survey F12-F17, G12, H7, N6-N9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import content_unit_id, document_id, sha256

#: What to do with a document that is there already. Fixed values.
STRATEGIES = ("reuse", "reject", "new_version")


def plan_documents(incoming: DataFrame, existing: DataFrame, strategy: str = "reuse") -> DataFrame:
    """Each incoming document (input_no, dedupe_key, series_key) with action, version_no,
    document_id and parent_document_id. `existing`: document_id, dedupe_key, series_key, version_no.

    An exact duplicate is REUSED (its newest version), REJECTED, or a NEW_VERSION, by the strategy; anything else is
    CREATED. Versions go on from the series' newest, in the order of input_no."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {', '.join(STRATEGIES)}")
    same = existing.groupBy("dedupe_key").agg(F.max_by("document_id", F.struct("version_no", "document_id")).alias("same_id"), F.max("version_no").alias("same_version"))
    series = existing.groupBy("series_key").agg(F.max("version_no").alias("last_version"), F.max_by("document_id", F.struct("version_no", "document_id")).alias("last_id"))
    # Copies within the batch count as duplicates of the first.
    copies = Window.partitionBy("dedupe_key").orderBy("input_no")
    rows = incoming.withColumn("copy_no", F.row_number().over(copies)).join(same, "dedupe_key", "left").join(series, "series_key", "left")
    known = F.col("same_id").isNotNull() | (F.col("copy_no") > 1)
    action = F.when(~known, "CREATED").otherwise({"reuse": "REUSED", "reject": "REJECTED", "new_version": "NEW_VERSION"}[strategy])
    in_series = Window.partitionBy("series_key").orderBy("input_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("action", action).withColumn("writes", F.col("action").isin("CREATED", "NEW_VERSION"))
    rows = rows.withColumn("version_no", F.coalesce("last_version", F.lit(0)) + F.sum(F.col("writes").cast("int")).over(in_series))
    new_id = document_id(F.col("dedupe_key"), F.col("series_key"), F.col("version_no"))
    rows = rows.withColumn("document_id", F.when(F.col("writes"), new_id).when(F.col("action") == "REUSED", F.col("same_id")))
    first = F.first("document_id").over(Window.partitionBy("dedupe_key").orderBy("input_no"))
    rows = rows.withColumn("document_id", F.when((F.col("action") == "REUSED") & F.col("document_id").isNull(), first).otherwise(F.col("document_id")))
    before = F.last(F.when(F.col("writes"), F.col("document_id")), ignorenulls=True).over(Window.partitionBy("series_key").orderBy("input_no").rowsBetween(Window.unboundedPreceding, -1))
    parent = F.when(F.col("writes"), F.coalesce(before, F.col("last_id")))
    version = F.when(F.col("action") == "REUSED", F.coalesce("same_version", "version_no")).otherwise(F.col("version_no"))
    return rows.select("input_no", "dedupe_key", "series_key", "action", version.cast("int").alias("version_no"), "document_id", parent.alias("parent_document_id"))


def with_unit_ids(units: DataFrame) -> DataFrame:
    """unit_id from document, type, place and text, and parent_unit_id from parent_sequence_no."""
    own = units.withColumn("unit_id", content_unit_id(F.col("document_id"), F.col("unit_type"), F.col("sequence_no"), sha256(F.col("text"))))
    if "parent_sequence_no" not in units.columns:
        return own
    parents = own.select("document_id", F.col("sequence_no").alias("parent_sequence_no"), F.col("unit_id").alias("parent_unit_id"))
    return own.join(parents, ["document_id", "parent_sequence_no"], "left")


def units_of(documents: DataFrame, units: DataFrame) -> DataFrame:
    """the units of some documents, in order."""
    return units.join(documents.select("document_id"), "document_id", "left_semi").orderBy("document_id", "sequence_no", "unit_id")


def plan_sources(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """For each incoming source (source_id, source_type, canonical_key, name): CREATE, TOUCH, or AMBIGUOUS if
    more than one is there; `warning` where a known source comes under another name."""
    there = existing.groupBy("source_type", "canonical_key").agg(F.count("*").alias("n"), F.min("source_id").alias("existing_id"), F.min_by("name", "source_id").alias("existing_name"))
    joined = incoming.dropDuplicates(["source_type", "canonical_key"]).join(there, ["source_type", "canonical_key"], "left")
    action = F.when(F.col("n").isNull(), "CREATE").when(F.col("n") > 1, "AMBIGUOUS").otherwise("TOUCH")
    other = F.when(F.col("existing_name") != F.col("name"), "SOURCE_NAME_DIFFERS")
    return joined.select(F.coalesce("existing_id", "source_id").alias("source_id"), "source_type", "canonical_key", "name", action.alias("action"), other.alias("warning"))


def operation_status(runs: DataFrame, operations: DataFrame) -> DataFrame:
    """the last run's status of each operation key, from either of its places. `runs`: run_id, created_at,
    run_status, external_key, input_object_ids."""
    keys = F.array_distinct(F.array_compact(F.concat(F.array("external_key"), F.coalesce("input_object_ids", F.array().cast("array<string>")))))
    by_key = runs.select(F.explode(keys).alias("operation_key"), "run_id", "created_at", "run_status")
    last = by_key.groupBy("operation_key").agg(F.max_by(F.struct("run_id", "run_status"), F.struct("created_at", "run_id")).alias("r"))
    return operations.select("operation_key").join(last, "operation_key", "left").select("operation_key", F.col("r.run_id").alias("run_id"), F.col("r.run_status").alias("run_status"))


def latest_runs(log: DataFrame) -> DataFrame:
    """The newest state of each run of an append-only log (run_id, at, run_status, ...)."""
    order = F.struct("at", F.array_position(F.array(*map(F.lit, ("pending", "running", "success", "partial_success", "failed", "cancelled"))), F.col("run_status")))
    return log.groupBy("run_id").agg(F.max_by(F.struct(*[c for c in log.columns if c != "run_id"]), order).alias("s")).select("run_id", "s.*")


def next_step(status: str | None) -> str:
    """What an operation key's last run allows: a success is done, a running one conflicts, a failed one retries."""
    return {None: "start", "success": "done", "partial_success": "done", "running": "conflict", "pending": "conflict"}.get(status, "retry")
