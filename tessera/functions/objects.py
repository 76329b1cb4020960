"""The object model by type: what each field of a payload may hold (survey 1.2, 1.3, B4, E4). Fixed values throughout."""

from __future__ import annotations

from dataclasses import dataclass

from tessera.functions.schemas import ENUMS, ID_PREFIXES

CURRENT_VERSION = "1.1"
#: Versions that are upgraded before they are checked.
OLDER_VERSIONS = ("1.0",)

#: Enumerations that only payloads have; the others are in ENUMS.
STATES = {
    "privacy_level": ("public", "internal", "private", "sensitive", "restricted"),
    "source_quality_tier": ("S1", "S2", "S3", "S4", "S5"),
    "document_type": ("web_article", "news", "pdf", "video", "audio", "markdown", "text", "spreadsheet", "company_filing", "research_report", "user_note", "unknown"),
    "parse_status": ("discovered", "queued", "collected", "parsed", "partially_parsed", "failed", "archived", "superseded"),
    "quality_level": ("very_low", "low", "medium", "high", "very_high"),
    "human_review_status": ("not_reviewed", "reviewed", "approved", "rejected", "needs_revision"),
    "event_status": ("reported", "confirmed", "disputed", "cancelled", "ongoing", "completed", "superseded"),
    "calculation_method": ("reported", "calculated", "estimated", "derived", "unknown"),
    "epistemic_status": ("asserted", "under_review", "supported", "disputed", "verified", "falsified", "outdated", "withdrawn"),
    "directness": ("direct", "indirect", "circumstantial", "unknown"),
    "evidence_strength": ("E0", "E1", "E2", "E3", "E4", "E5"),
    "verification_status": ("unverified", "partially_verified", "verified", "disputed", "falsified", "outdated"),
    "knowledge_type": ("topic_card", "company_profile", "person_profile", "industry_card", "technology_card", "policy_card", "event_summary", "concept_definition", "argument_map", "risk_card", "case_study"),
    "knowledge_status": ("draft", "active", "challenged", "revised", "invalidated", "archived"),
    "relation_status": ("asserted", "hypothesized", "verified", "disputed", "invalidated"),
    "insight_status": ("draft", "under_review", "supported", "challenged", "revised", "invalidated", "archived"),
    "opinion_status": ("draft", "under_review", "active", "watch", "challenged", "revised", "invalidated", "archived"),
    "output_type": ("research_brief", "research_report", "opinion_matrix", "timeline", "risk_list", "company_profile", "industry_profile", "decision_memo", "learning_card", "wqrs_input", "markdown_report", "other"),
    "output_review_status": ("not_reviewed", "reviewed", "approved", "rejected"),
    "feedback_type": ("user_rating", "correction", "new_evidence", "prediction_outcome", "application_result", "duplicate_report", "staleness_report", "quality_issue"),
    "feedback_effect": ("support", "challenge", "correct", "invalidate", "no_change"),
    "feedback_action": ("review_required", "revision_required", "invalidate_candidate", "no_change"),
}


@dataclass(frozen=True)
class Field:
    """`kind`: text, texts, whole, number, flag, time, day, moment (day or time), url, map (of texts), any_map, member of an
    enumeration (`of`), struct or structs (`of`). Bounds count characters of texts and elements of lists, or are of numbers."""

    kind: str
    required: bool = False
    nullable: bool = True
    least: float | None = None
    most: float | None = None
    of: str = ""


def _need(kind: str, **more) -> Field:
    return Field(kind, required=True, nullable=False, **more)


def _have(kind: str, **more) -> Field:
    """May be left out, for its default, but not be null."""
    return Field(kind, nullable=False, **more)


_TEXT, _TEXTS, _TIME = Field("text"), _have("texts"), Field("time")
_ID, _SOME, _TITLE = _need("text"), _need("text", least=1), _need("text", least=1, most=1000)

STRUCTS = {
    "human_review": {"status": _have("member", of="human_review_status"), "reviewed_by": _TEXT, "reviewed_at": _TIME, "note": _TEXT},
    "derivation_link": {"object_id": _SOME, "relation_type": _need("member", of="derivation_relation_type"), "note": _TEXT},
    "provenance": {
        "origin_type": _have("member", of="origin_type"), "origin_object_ids": _TEXTS, "derivation_links": _have("structs", of="derivation_link"), "processing_run_id": _TEXT,
        "human_review": _have("struct", of="human_review"), "derivation_note": _TEXT, "source_locator_required": _have("flag"),
    },
    "locator": {
        "start_seconds": Field("number", least=0), "end_seconds": Field("number", least=0), **{f: Field("whole", least=1) for f in ("page_no", "block_no", "paragraph_no", "line_start", "line_end", "row_no")},
        "heading_path": _TEXTS, **{f: _TEXT for f in ("sheet_name", "column_name", "css_selector", "xpath")},
    },
    "quality": {
        "source_quality": Field("member", of="source_quality_tier"), **{f: Field("member", of="quality_level") for f in ("parse_quality", "extraction_confidence", "reasoning_confidence")},
        "evidence_strength": _TEXT, "human_review_status": _have("member", of="human_review_status"), "quality_flags": _TEXTS,
    },
    "time_range": {"start": Field("moment"), "end": Field("moment"), "precision": _have("member", of="time_precision")},
    "validity": {"as_of_date": _need("day"), "valid_from": Field("moment"), "valid_to": Field("moment"), "review_due_at": Field("moment")},
    "measurement_context": {"measurement_kind": _have("member", of="measurement_kind"), "currency": _TEXT, "scale_multiplier": _have("whole", least=1), "reporting_standard": _TEXT, "attribution_scope": _TEXT, "consolidation_scope": _TEXT},
    "processor": {"module": _ID, **{f: _TEXT for f in ("model_provider", "model_name", "prompt_version", "code_version")}},
}

_RANGE = {"kind": "struct", "of": "time_range"}

#: Fields that every type has.
COMMON = {
    "id": _have("text"), "object_type": _need("text"), "schema_version": _need("text"), "status": _have("member", of="lifecycle_status"), "created_at": _have("time"), "updated_at": _have("time"), "created_by": _have("text"), "workspace_id": _have("text"),
    "language": _TEXT, "tags": _TEXTS, "source_refs": _TEXTS, "provenance": _have("struct", of="provenance"), "privacy_level": _have("member", of="privacy_level"), "deleted_at": _TIME, "external_ids": _have("map"), "metadata": _have("any_map"),
}

TYPES = {
    "source": {
        "name": _need("text", least=1, most=500), "source_type": _need("member", of="source_type"), "publisher": _TEXT, "author": _TEXT, "homepage_url": Field("url"), "domain": _TEXT,
        "source_quality_tier": _have("member", of="source_quality_tier"), "ownership_or_interest": _TEXT, "first_seen_at": _TIME, "last_seen_at": _TIME,
    },
    "document": {
        "source_id": _ID, "document_type": _need("member", of="document_type"), "title": _TITLE, "original_url": Field("url"), "published_at": _TIME, "collected_at": _have("time"), "authors": _TEXTS,
        **{f: _TEXT for f in ("content_hash", "normalized_url", "mime_type", "raw_storage_uri", "copyright_note", "parent_document_id", "duplicate_of_document_id")}, "parse_status": _have("member", of="parse_status"),
    },
    "content_unit": {"document_id": _ID, "unit_type": _need("member", of="content_unit_type"), "sequence_no": _need("whole", least=0), "text": _SOME, "locator": _need("struct", of="locator"), "speaker": _TEXT, "quality": _have("struct", of="quality"), "parent_unit_id": _TEXT},
    "entity": {"entity_type": _need("member", of="entity_type"), "canonical_name": _need("text", least=1, most=500), "aliases": _TEXTS, "attributes": _have("any_map"), "possible_same_as": _TEXTS},
    "event": {"event_type": _SOME, "title": _TITLE, "event_time": _need(**_RANGE), "entity_ids": _need("texts", least=1), "location": _TEXT, "description": _TEXT, "event_status": _have("member", of="event_status")},
    "data_point": {
        "metric": _SOME, "value": _need("number"), "unit": _SOME, "measurement_context": _have("struct", of="measurement_context"), "entity_id": _ID, "period": _need(**_RANGE), "reported_at": _TIME,
        "calculation_method": _have("member", of="calculation_method"), "calculation_expression": _TEXT, "source_ref": _ID, "audited": Field("flag"),
    },
    "claim": {
        "claim_type": _need("member", of="claim_type"), "claim_dimension": _have("member", of="claim_dimension"), "statement": _SOME, "subject_entity_ids": _TEXTS, "asserted_by": _SOME, "asserted_at": _TIME,
        "time_horizon": Field(**_RANGE), "conditions": _TEXTS, "source_ref": _ID, "direct_quote": _have("flag"), "epistemic_status": _have("member", of="epistemic_status"),
    },
    "evidence": {
        "evidence_role": _need("member", of="evidence_role"), "evidence_type": _need("member", of="evidence_type"), "target_object_id": _ID, "source_ref": _ID, "summary": _SOME, "independence_group": _SOME,
        "directness": _have("member", of="directness"), "source_quality_tier": _have("member", of="source_quality_tier"), "evidence_strength": _have("member", of="evidence_strength"),
    },
    "fact": {"statement": _SOME, "subject_entity_ids": _TEXTS, "valid_time": _need(**_RANGE), "evidence_ids": _need("texts", least=1), "verification_status": _have("member", of="verification_status"), "reviewed_by": _TEXT},
    "knowledge_object": {
        "knowledge_type": _need("member", of="knowledge_type"), "title": _TITLE, "topic_ids": _TEXTS, "summary": _SOME, **{f"{f}_ids": _TEXTS for f in ("fact", "data_point", "claim", "evidence", "related_entity")},
        "validity": _need("struct", of="validity"), "knowledge_status": _have("member", of="knowledge_status"),
    },
    "relation": {"subject_id": _ID, "predicate": _SOME, "object_id": _ID, "valid_time": Field(**_RANGE), "evidence_ids": _TEXTS, "relation_status": _have("member", of="relation_status")},
    "timeline_entry": {"target_object_id": _ID, "event_time": _need(**_RANGE), "title": _SOME, "summary": _TEXT, "referenced_object_ids": _TEXTS, "sequence_key": _TEXT},
    "insight": {
        "title": _TITLE, "statement": _SOME, "supporting_object_ids": _need("texts", least=1), "counter_evidence_ids": _TEXTS, "reasoning_steps": _need("texts", least=1), "alternative_explanations": _TEXTS,
        "confidence_level": _have("member", of="quality_level"), "validity": _need("struct", of="validity"), "insight_status": _have("member", of="insight_status"),
    },
    "personal_opinion": {
        "title": _TITLE, "statement": _SOME, **{f: _TEXTS for f in ("topic_ids", "supporting_ids", "counter_evidence_ids", "key_assumptions", "unknown_variables", "invalidation_conditions")},
        "confidence_level": _have("member", of="quality_level"), "opinion_status": _have("member", of="opinion_status"), "confirmed_by_user": _have("flag"), "confirmed_at": _TIME, "as_of_date": _need("day"),
        "review_due_at": Field("moment"), "version_no": _have("whole", least=1), "previous_version_id": _TEXT, "revision_reason": _TEXT,
    },
    "output_artifact": {
        "output_type": _need("member", of="output_type"), "title": _TITLE, "purpose": _SOME, "audience": _have("text"), "content_uri": _TEXT, "content": _TEXT, "knowledge_refs": _TEXTS, "insight_refs": _TEXTS, "opinion_refs": _TEXTS,
        "as_of_date": _need("day"), "review_status": _have("member", of="output_review_status"),
    },
    "feedback": {"feedback_type": _need("member", of="feedback_type"), "target_object_id": _ID, "content": _SOME, "effect": _need("member", of="feedback_effect"), "recommended_action": _have("member", of="feedback_action")},
    "processing_run": {
        "task_type": _SOME, "input_object_ids": _TEXTS, "output_object_ids": _TEXTS, "processor": _need("struct", of="processor"), "started_at": _have("time"), "finished_at": _TIME, "run_status": _have("member", of="run_status"),
        "quality_flags": _TEXTS, "error_code": _TEXT, "error_message": _TEXT,
    },
}

assert set(TYPES) == set(ID_PREFIXES)


def members(name: str) -> tuple[str, ...]:
    return STATES[name] if name in STATES else ENUMS[name]


def owners() -> dict[str, dict[str, Field]]:
    """The fields of every type, common ones among them, and of every nested struct."""
    return {kind: COMMON | own for kind, own in TYPES.items()} | STRUCTS


_JSON_KINDS = {"whole": "integer", "number": "number", "flag": "boolean", "texts": "array", "structs": "array", "map": "object", "any_map": "object"}


def _field_schema(field: Field) -> dict:
    if field.kind == "struct":
        out = {"$ref": f"#/$defs/{field.of}"}
    elif field.kind == "member":
        out = {"type": "string", "enum": list(members(field.of))}
    else:
        out = {"type": _JSON_KINDS.get(field.kind, "string")}
        if field.kind in ("time", "day", "url"):
            out["format"] = {"time": "date-time", "day": "date", "url": "uri"}[field.kind]
        if field.kind == "texts":
            out["items"] = {"type": "string"}
        if field.kind == "structs":
            out["items"] = {"$ref": f"#/$defs/{field.of}"}
        if field.kind == "map":
            out["additionalProperties"] = {"type": "string"}
        low, high = {"text": ("minLength", "maxLength"), "texts": ("minItems", "maxItems")}.get(field.kind, ("minimum", "maximum"))
        out |= {low: field.least} if field.least is not None else {}
        out |= {high: field.most} if field.most is not None else {}
    return {"anyOf": [out, {"type": "null"}]} if field.nullable else out


def json_schema(kind: str) -> dict:
    """The JSON Schema of an object type in the current version; older ones are never exported anew."""
    shape = lambda fields: {"type": "object", "additionalProperties": False, "properties": {n: _field_schema(f) for n, f in fields.items()}, "required": [n for n, f in fields.items() if f.required]}
    return {"title": kind, "x-schema-version": CURRENT_VERSION, "$defs": {n: shape(f) for n, f in STRUCTS.items()}, **shape(COMMON | TYPES[kind])}
