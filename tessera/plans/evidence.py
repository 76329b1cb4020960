"""Evidence queries over lineitem: part = target, return flag = role, supplier = independence group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evidence as ops
from tessera.session import table

EVIDENCE_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS evidence_id,
       l_partkey AS target_object_id,
       CASE l_returnflag WHEN 'A' THEN 'refute' WHEN 'N' THEN 'support' ELSE 'qualify' END AS evidence_role,
       CASE WHEN l_suppkey % 10 = 0 THEN '  ' ELSE 'grp_' || CAST(l_suppkey AS VARCHAR) END AS independence_group
FROM lineitem"""


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    role = F.when(F.col("l_returnflag") == "A", "refute").when(F.col("l_returnflag") == "N", "support").otherwise("qualify")
    group = F.when(F.col("l_suppkey") % 10 == 0, "  ").otherwise(F.concat(F.lit("grp_"), F.col("l_suppkey").cast("string")))
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("evidence_id"),
        F.col("l_partkey").alias("target_object_id"),
        role.alias("evidence_role"),
        group.alias("independence_group"),
    )


GROUPED_SQL = f"""
SELECT *, CASE WHEN trim(independence_group) = '' THEN '__evidence__:' || evidence_id ELSE independence_group END AS effective_group
FROM ({EVIDENCE_SQL})"""

QUERIES = {
    "g3_count_independent_evidence": lambda s, d: ops.count_independent(evidence(s, d), "target_object_id", "evidence_role"),
    "g3_count_independent_total": lambda s, d: ops.count_independent(evidence(s, d)),
    "g2_group_evidence": lambda s, d: ops.group_evidence(evidence(s, d)),
    "g4_group_by_label": lambda s, d: ops.group_by_label(evidence(s, d)),
    "g5_blank_groups": lambda s, d: ops.blank_groups(evidence(s, d)),
    "e8_evidence_subset": lambda s, d: ops.count_independent(ops.subset(evidence(s, d), target=17, role="support"), "target_object_id"),
}

ORACLES = {
    "g3_count_independent_evidence": f"SELECT target_object_id, evidence_role, count(DISTINCT effective_group) AS n_independent FROM ({GROUPED_SQL}) GROUP BY ALL",
    "g3_count_independent_total": f"SELECT count(*) AS n_independent FROM (SELECT DISTINCT target_object_id, evidence_role, effective_group FROM ({GROUPED_SQL}))",
    "g2_group_evidence": f"SELECT target_object_id, evidence_role, effective_group, count(*) AS n_evidence, min(evidence_id) AS first_evidence_id FROM ({GROUPED_SQL}) GROUP BY ALL",
    "g4_group_by_label": f"SELECT independence_group, count(*) AS n_evidence FROM ({EVIDENCE_SQL}) GROUP BY ALL",
    "g5_blank_groups": f"SELECT evidence_id FROM ({GROUPED_SQL}) WHERE trim(independence_group) = ''",
    "e8_evidence_subset": f"SELECT target_object_id, count(DISTINCT effective_group) AS n_independent FROM ({GROUPED_SQL}) WHERE target_object_id = 17 AND evidence_role = 'support' GROUP BY ALL",
}
