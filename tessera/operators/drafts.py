"""Draft identities and mapping of candidates to objects (survey D22, D23, F9, F11, L11, N10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.schemas import ENUMS
from tessera.functions.text import enum_cast, fiscal_period, sha256
from tessera.operators.joins import null_safe

NAMESPACE = "tessera/v1"
UNIT_PREFIX = "cu_"

#: What makes up a candidate's identity, by type; confidence and epistemic fields never do. Fixed values.
SEMANTIC_FIELDS = {
    "entity": ("entity_type", "canonical_name"),
    "data_point": ("metric", "value", "unit", "entity_id", "period"),
    "claim": ("claim_type", "claim_dimension", "statement", "asserted_by"),
    "evidence": ("evidence_type", "evidence_role", "target_object_id"),
    "fact": ("statement",),
}
#: Object types that candidates become, with their id prefix, in the order of their dependencies. Facts never do.
MAPPED = {"entity": "ent", "data_point": "dat", "claim": "clm", "evidence": "evi"}


def natural_key(workspace: Column, candidates: DataFrame) -> Column:
    """A hash of namespace, workspace, type, id and the fields that make up the identity."""
    have = set(candidates.columns)
    value = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("None" if name == "value" else "")) if name in have else F.lit("None" if name == "value" else "")
    out = F.lit(None).cast("string")
    for kind, fields in SEMANTIC_FIELDS.items():
        parts = [F.lit(NAMESPACE), workspace, F.col("candidate_type"), value("candidate_id"), *(value(f) for f in fields), value("source_unit_id"), value("source_quote")]
        out = F.when(F.col("candidate_type") == kind, sha256(F.concat_ws("|", *parts))).otherwise(out)
    return out


def operation_key(workspace: Column, bundle_hash: Column) -> Column:
    return sha256(F.concat_ws("|", F.lit(NAMESPACE), workspace, bundle_hash))


def independence_group(root_source: Column, workspace: Column) -> Column:
    """What evidence from one root source shares."""
    return sha256(F.concat_ws("|", F.lit(NAMESPACE), F.lit("independence_group"), root_source, workspace))


def with_object_ids(candidates: DataFrame, workspace: Column) -> DataFrame:
    """Adds natural_key and object_id: ids come from keys, before any reference is rewritten, and carry their prefix."""
    keyed = candidates.withColumn("natural_key", natural_key(workspace, candidates))
    prefix = F.create_map(*(x for kind, p in MAPPED.items() for x in (F.lit(kind), F.lit(f"{p}_"))))
    return keyed.withColumn("object_id", F.concat(prefix[F.col("candidate_type")], F.left("natural_key", F.lit(40))))


def rewrite_references(candidates: DataFrame, columns: tuple[str, ...] = ("entity_id", "target_object_id")) -> DataFrame:
    """ids of candidates as ids of the objects they become; other ids stay. A reference means its own document's
    candidate; of two with one id there, the one whose object id comes first."""
    document = F.coalesce("document_id", F.lit("")) if "document_id" in candidates.columns else F.lit("")
    candidates = candidates.withColumn("__doc", document)
    ids = candidates.where("object_id IS NOT NULL").groupBy("__doc", F.col("candidate_id").alias("__from")).agg(F.min("object_id").alias("__to"))
    for name in columns:
        joined = candidates.withColumn("__from", F.col(name)).join(ids, ["__doc", "__from"], "left")
        candidates = joined.withColumn(name, F.coalesce("__to", name)).drop("__from", "__to")
    return candidates.drop("__doc")


def apart(candidates: DataFrame) -> Column:
    """A candidate's unit as its natural key has it: ids of stored units stand alone, as they come from their document's;
    any other, such as u1, is told apart by document."""
    unit = F.coalesce("source_unit_id", F.lit(""))
    if "document_id" not in candidates.columns:
        return unit
    return F.when((unit == "") | unit.startswith(UNIT_PREFIX) | F.col("document_id").isNull(), unit).otherwise(F.concat(F.col("document_id"), F.lit("/"), unit))


def map_candidates(candidates: DataFrame, groups: DataFrame, workspace: str) -> DataFrame:
    """Objects from accepted candidates, in one shape; `groups` maps document_id, if it has that, and source_unit_id to
    independence_group. Units of two documents are two, whatever their ids: `apart` says how.

    Claims start under review and keep their dimension; evidence starts at S5, E1 and unknown directness."""
    mapped = candidates.where(F.col("candidate_type").isin(*MAPPED)).withColumn("__unit", F.col("source_unit_id"))
    keyed = with_object_ids(mapped.withColumn("source_unit_id", apart(mapped)), F.lit(workspace)).withColumn("source_unit_id", F.col("__unit")).drop("__unit")
    keyed = rewrite_references(keyed).drop("independence_group")
    both = ["document_id", "source_unit_id"] if "document_id" in groups.columns and "document_id" in keyed.columns else ["source_unit_id"]
    grouped = null_safe(keyed, groups.select(*both, "independence_group"), both)
    kind, period = F.col("candidate_type"), fiscal_period(F.col("period"))
    return grouped.select(
        F.col("object_id").alias("id"), kind.alias("object_type"), F.lit(workspace).alias("workspace_id"), "natural_key", "candidate_id",
        F.array_compact(F.array("source_unit_id")).alias("source_refs"), enum_cast(F.col("entity_type"), ENUMS["entity_type"]).alias("entity_type"), "canonical_name",
        "metric", "value", "unit", "entity_id", period["start"].alias("period_start"), period["end"].alias("period_end"), "statement",
        enum_cast(F.col("claim_type"), ENUMS["claim_type"]).alias("claim_type"), F.when(kind == "claim", F.coalesce(enum_cast(F.col("claim_dimension"), ENUMS["claim_dimension"]), F.lit("general"))).alias("claim_dimension"),
        F.when(kind == "claim", "under_review").alias("epistemic_status"), enum_cast(F.col("evidence_role"), ENUMS["evidence_role"]).alias("evidence_role"),
        enum_cast(F.col("evidence_type"), ENUMS["evidence_type"]).alias("evidence_type"), "target_object_id", F.when(kind == "evidence", F.col("independence_group")).alias("independence_group"),
        F.when(kind == "evidence", "S5").alias("source_quality_tier"), F.when(kind == "evidence", "E1").alias("evidence_strength"), F.when(kind == "evidence", "unknown").alias("directness"),
    )


#: What a mapped object must have, by type. Fixed values.
REQUIRED = {
    "entity": ("entity_type", "canonical_name"),
    "data_point": ("metric", "value", "unit", "entity_id"),
    "claim": ("claim_type", "statement"),
    "evidence": ("evidence_role", "evidence_type", "target_object_id", "independence_group"),
}


def strictness_findings(objects: DataFrame) -> DataFrame:
    """(id, object_type, missing) of mapped objects that lack a required field."""
    lacking = [F.when((F.col("object_type") == kind) & F.col(f).isNull(), F.lit(f)) for kind, fields in REQUIRED.items() for f in fields]
    found = objects.select("id", "object_type", F.array_compact(F.array(*lacking)).alias("lacking"))
    return found.select("id", "object_type", F.explode("lacking").alias("missing"))


def reuse_or_create(objects: DataFrame, existing: DataFrame) -> DataFrame:
    """each object with REUSED and the live object's id if its natural key is there already, else CREATED."""
    live = existing.where("deleted_at IS NULL").groupBy("workspace_id", "object_type", "natural_key").agg(F.min("id").alias("existing_id"))
    joined = objects.join(live, ["workspace_id", "object_type", "natural_key"], "left")
    return joined.withColumn("action", F.when(F.col("existing_id").isNull(), "CREATED").otherwise("REUSED"))
