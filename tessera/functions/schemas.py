"""The object model: types, id prefixes, enumerations, and which fields refer to which objects (survey 1.2, K1).

The values below are fixed by the data that the engine exchanges."""

from __future__ import annotations

from pyspark.sql import types as T

#: Id prefixes by object type. Fixed values.
ID_PREFIXES = {
    "source": "src_",
    "document": "doc_",
    "content_unit": "cu_",
    "entity": "ent_",
    "event": "evt_",
    "data_point": "dat_",
    "claim": "clm_",
    "evidence": "evi_",
    "fact": "fac_",
    "knowledge_object": "knw_",
    "relation": "rel_",
    "timeline_entry": "tml_",
    "insight": "ins_",
    "personal_opinion": "opn_",
    "output_artifact": "out_",
    "feedback": "fbk_",
    "processing_run": "run_",
}

#: Closed enumerations that operators check. Fixed values.
ENUMS = {
    "lifecycle_status": ("active", "archived", "superseded", "deleted"),
    "origin_type": ("original", "imported", "derived", "user_created"),
    "derivation_relation_type": ("derived_from", "quoted_from", "summarizes", "reposts", "calculated_from", "translated_from", "extracted_from", "inferred_from"),
    "source_type": (
        "official_website", "company_announcement", "government_database", "academic_journal", "research_institution", "news_media",
        "video_channel", "podcast", "social_media", "blog", "api", "local_file", "user_note", "unknown",
    ),
    "content_unit_type": ("paragraph", "heading", "transcript_segment", "table", "table_row", "list_item", "quote", "code_block", "note_block", "unknown"),
    "entity_type": ("person", "company", "organization", "industry", "product", "technology", "policy", "location", "security", "paper", "project", "concept", "unknown"),
    "claim_type": ("fact_claim", "interpretation", "causal_claim", "prediction", "recommendation", "risk_claim", "value_judgment", "hypothesis"),
    "claim_dimension": (
        "general", "business_growth", "financial_performance", "valuation", "risk", "market_expectation", "action_recommendation", "policy",
        "technology", "operations", "governance", "supply_chain", "competition", "other",
    ),
    "evidence_role": ("support", "refute", "qualify", "context", "counterexample"),
    "evidence_type": (
        "direct_quote", "official_data", "company_filing", "research_result", "observed_event", "expert_testimony", "historical_case",
        "derived_calculation", "user_observation", "unknown",
    ),
    "run_status": ("pending", "running", "success", "partial_success", "failed", "cancelled"),
    "time_precision": ("second", "minute", "hour", "day", "month", "quarter", "year", "unknown"),
    "measurement_kind": ("unknown", "monetary", "ratio", "percentage", "count", "physical", "index", "rate", "other"),
}

#: Reference fields by object type, in the order in which the first of equal edges wins. Fixed values.
REFERENCES = {
    "document": ("source_id", "parent_document_id", "duplicate_of_document_id"),
    "content_unit": ("document_id", "parent_unit_id"),
    "entity": ("possible_same_as",),
    "event": ("entity_ids",),
    "data_point": ("entity_id", "source_ref"),
    "claim": ("subject_entity_ids", "asserted_by", "source_ref"),
    "evidence": ("target_object_id", "source_ref"),
    "fact": ("subject_entity_ids", "evidence_ids"),
    "knowledge_object": ("topic_ids", "fact_ids", "data_point_ids", "claim_ids", "evidence_ids", "related_entity_ids"),
    "relation": ("subject_id", "object_id", "evidence_ids"),
    "timeline_entry": ("target_object_id", "referenced_object_ids"),
    "insight": ("supporting_object_ids", "counter_evidence_ids"),
    "personal_opinion": ("topic_ids", "supporting_ids", "counter_evidence_ids", "previous_version_id"),
    "output_artifact": ("knowledge_refs", "insight_refs", "opinion_refs"),
    "feedback": ("target_object_id",),
    "processing_run": ("input_object_ids", "output_object_ids"),
}
#: References that are for audit only: a missing target doesn't break traceability.
ADVISORY = {("evidence", "target_object_id"), ("processing_run", "output_object_ids")}

_TEXT, _INT, _LONG, _DOUBLE, _FLAG, _TIME = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()
_TEXTS = T.ArrayType(_TEXT)


def _struct(*groups: tuple[T.DataType, str]) -> T.StructType:
    """Fields in order, given as (type, names) groups."""
    return T.StructType([T.StructField(name, kind) for kind, names in groups for name in names.split()])


LOCATOR = _struct((_DOUBLE, "start_seconds end_seconds"), (_INT, "page_no block_no paragraph_no line_start line_end"), (_TEXTS, "heading_path"), (_TEXT, "sheet_name"), (_INT, "row_no"), (_TEXT, "column_name css_selector xpath"))
UNIT = _struct((_INT, "sequence_no"), (_TEXT, "unit_type text"), (LOCATOR, "locator"), (_TEXT, "speaker"), (_INT, "parent_sequence_no"), (_TEXTS, "quality_flags"))
SEGMENT = _struct((_INT, "sequence_no"), (_TEXT, "unit_type text"), (LOCATOR, "locator"), (_TEXT, "speaker"))
OBJECT_RECORD = _struct((_TEXT, "id object_type schema_version lifecycle_status workspace_id privacy_level created_by"), (_TIME, "created_at updated_at deleted_at"), (_INT, "version"), (_TEXT, "payload"))
MEASUREMENT_CONTEXT = _struct((_TEXT, "measurement_kind currency"), (_LONG, "scale_multiplier"), (_TEXT, "reporting_standard attribution_scope consolidation_scope"))
CANDIDATE = _struct(
    (_TEXT, "candidate_id candidate_type"), (_DOUBLE, "confidence"), (_TEXT, "entity_type canonical_name metric unit entity_id period"), (_DOUBLE, "value"),
    (MEASUREMENT_CONTEXT, "measurement_context"), (_TEXT, "statement claim_type claim_dimension claimant_name asserted_by"), (_struct((_TEXT, "start end precision")), "time_horizon"),
    (_FLAG, "promotable_to_fact"), (_TEXT, "evidence_type evidence_role target_object_id target_data_point_id target_claim_id confidence_rationale rejection_reason"),
    (_TEXTS, "supporting_evidence_ids"), (T.MapType(_TEXT, _TEXT), "valid_time"), (_FLAG, "promotable"), (_TEXT, "source_quote source_unit_id quote_match_mode quote_locator_hint note"),
    (_TEXT, "independence_group source_quality_tier evidence_strength verification_status epistemic_status"),
)
CANDIDATE_ORDER = ("entity", "data_point", "claim", "evidence", "fact")


def registry() -> dict[str, dict]:
    """The exported schemas by name, as Spark's own JSON."""
    return {name: schema.jsonValue() for name, schema in (("locator", LOCATOR), ("unit", UNIT), ("object_record", OBJECT_RECORD), ("candidate", CANDIDATE))}
