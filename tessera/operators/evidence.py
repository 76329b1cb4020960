"""Evidence grouping and independence counts (survey G2-G5, E8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def effective_group(evidence_id: Column, group: Column) -> Column:
    """The independence group, or a key of its own for evidence whose group is blank."""
    blank = group.isNull() | (F.regexp_replace(group, r"(?U)\s+", "") == "")
    return F.when(blank, F.concat(F.lit("__evidence__:"), evidence_id.cast("string"))).otherwise(group)


def with_effective_group(evidence: DataFrame) -> DataFrame:
    return evidence.withColumn("effective_group", effective_group(F.col("evidence_id"), F.col("independence_group")))


def subset(evidence: DataFrame, target: object = None, role: str | None = None) -> DataFrame:
    """Evidence of one target and one role, where they are given."""
    if target is not None:
        evidence = evidence.where(F.col("target_object_id") == target)
    return evidence if role is None else evidence.where(F.col("evidence_role") == role)


def group_evidence(evidence: DataFrame) -> DataFrame:
    """One row for each target, role and effective group, with the number of items and the first id."""
    return with_effective_group(evidence).groupBy("target_object_id", "evidence_role", "effective_group").agg(
        F.count("*").alias("n_evidence"), F.min("evidence_id").alias("first_evidence_id")
    )


def count_independent(evidence: DataFrame, *keys: str) -> DataFrame:
    """The number of distinct (target, role, effective group) keys, in all or for each of `keys`.

    Two plain aggregations, so that a hot target is summed on the map side first."""
    distinct = with_effective_group(evidence).select("target_object_id", "evidence_role", "effective_group").distinct()
    return distinct.groupBy(*keys).agg(F.count("*").alias("n_independent"))


def group_by_label(evidence: DataFrame) -> DataFrame:
    """The older grouping: by the raw label alone."""
    return evidence.groupBy("independence_group").agg(F.count("*").alias("n_evidence"))


def blank_groups(evidence: DataFrame) -> DataFrame:
    """Ids of evidence whose independence group is blank."""
    with_group = with_effective_group(evidence)
    return with_group.where(F.col("effective_group").startswith("__evidence__:")).select("evidence_id")
