"""Payloads against the object model; every payload is written for these tests."""

import copy
import json

import pytest

from tessera.functions import objects
from tessera.operators import payloads

RANGE = {"start": "2024-01-01", "end": "2024-03-31T00:00:00Z", "precision": "quarter"}
BASE = {"object_type": "", "schema_version": "1.1", "created_at": "2024-01-01T00:00:00Z", "updated_at": "2024-01-02T00:00:00Z", "provenance": {"origin_type": "imported", "derivation_links": [{"object_id": "doc_1", "relation_type": "quoted_from", "note": None}]}, "external_ids": {"k": "v"}, "metadata": {"any": [1, {"x": None}]}}
VALID = {
    "source": {"name": "n", "source_type": "blog", "homepage_url": "https://a.example/x"},
    "document": {"source_id": "src_1", "document_type": "news", "title": "t", "authors": ["a"]},
    "content_unit": {"document_id": "doc_1", "unit_type": "paragraph", "sequence_no": 0, "text": "x", "locator": {"page_no": 1, "heading_path": []}, "quality": {"parse_quality": "low"}},
    "entity": {"entity_type": "company", "canonical_name": "Acme", "attributes": {"n": 1}},
    "event": {"event_type": "e", "title": "t", "event_time": RANGE, "entity_ids": ["ent_1"]},
    "data_point": {"metric": "m", "value": 1.5, "unit": "USD", "entity_id": "ent_1", "period": RANGE, "source_ref": "cu_1", "measurement_context": {"currency": "USD", "scale_multiplier": 1000}},
    "claim": {"claim_type": "prediction", "statement": "s", "asserted_by": "a", "source_ref": "cu_1", "time_horizon": RANGE},
    "evidence": {"evidence_role": "support", "evidence_type": "direct_quote", "target_object_id": "clm_1", "source_ref": "cu_1", "summary": "s", "independence_group": "g"},
    "fact": {"statement": "s", "valid_time": {}, "evidence_ids": ["evi_1"]},
    "knowledge_object": {"knowledge_type": "risk_card", "title": "t", "summary": "s", "claim_ids": ["clm_1"], "validity": {"as_of_date": "2024-01-01"}},
    "relation": {"subject_id": "ent_1", "predicate": "p", "object_id": "ent_2", "evidence_ids": ["evi_1"]},
    "timeline_entry": {"target_object_id": "evt_1", "event_time": RANGE, "title": "t"},
    "insight": {"title": "t", "statement": "s", "supporting_object_ids": ["clm_1"], "reasoning_steps": ["r"], "validity": {"as_of_date": "2024-01-01"}},
    "personal_opinion": {"title": "t", "statement": "s", "as_of_date": "2024-01-01", "opinion_status": "active", "confirmed_by_user": True, "confirmed_at": "2024-01-01T00:00:00Z", "supporting_ids": ["clm_1"], "key_assumptions": ["k"], "invalidation_conditions": ["i"], "review_due_at": "2025-01-01"},
    "output_artifact": {"output_type": "timeline", "title": "t", "purpose": "p", "content": "c", "opinion_refs": ["opn_1"], "as_of_date": "2024-01-01"},
    "feedback": {"feedback_type": "correction", "target_object_id": "clm_1", "content": "c", "effect": "correct"},
    "processing_run": {"task_type": "t", "processor": {"module": "m"}, "run_status": "success", "started_at": "2024-01-01T00:00:00Z", "finished_at": "2024-01-01T00:00:01Z"},
}


def payload(kind, **changes):
    """A valid payload; a dotted name as a__b changes a nested field, and a change to ... removes it."""
    out = copy.deepcopy(BASE | {"object_type": kind} | VALID[kind])
    for name, value in changes.items():
        *way, last = name.split("__")
        at = out
        for step in way:
            at = at.setdefault(step, {})
        if value is ...:
            at.pop(last)
        else:
            at[last] = value
    return json.dumps(out)


BROKEN = {
    "not json": ("{", {("INVALID_JSON", "")}),
    "list": ("[1]", {("NOT_AN_OBJECT", "")}),
    "no version": (payload("claim", schema_version=...), {("MISSING_SCHEMA_VERSION", "")}),
    "odd version": (payload("claim", schema_version="0.9"), {("UNSUPPORTED_VERSION", "")}),
    "no type": (payload("claim", object_type=...), {("MISSING_OBJECT_TYPE", "")}),
    "odd type": (payload("claim", object_type="thing"), {("UNSUPPORTED_TYPE", "")}),
    "older claim": (payload("claim", schema_version="1.0"), set()),
    "unknown and missing": (payload("claim", extra=1, statement=...), {("UNKNOWN_FIELD", "extra"), ("MISSING_FIELD", "statement")}),
    "nulls": (payload("claim", tags=None, language=None, provenance=None), {("NULL_FIELD", "tags"), ("NULL_FIELD", "provenance")}),
    "types": (payload("claim", statement=5, tags="x", direct_quote="yes", created_at="soon", external_ids={"a": 1}, conditions=["a", 1]), {("WRONG_TYPE", f) for f in ("statement", "tags", "direct_quote", "created_at", "external_ids", "conditions")}),
    "members": (payload("claim", claim_type="guess", status="gone"), {("NOT_A_MEMBER", "claim_type"), ("NOT_A_MEMBER", "status")}),
    "blank": (payload("claim", statement="  "), {("TOO_SMALL", "statement")}),
    "long title": (payload("document", title="t" * 1001), {("TOO_LARGE", "title")}),
    "few": (payload("event", entity_ids=[]), {("TOO_SMALL", "entity_ids")}),
    "numbers": (payload("content_unit", sequence_no=-1, locator__page_no=1.5, locator__line_start=0), {("TOO_SMALL", "sequence_no"), ("WRONG_TYPE", "locator.page_no"), ("TOO_SMALL", "locator.line_start")}),
    "nested": (payload("claim", provenance__derivation_links=[{"object_id": "", "relation_type": "x", "more": 1}, {"relation_type": "reposts"}], provenance__human_review={"status": "fine"}), {("TOO_SMALL", "provenance.derivation_links[].object_id"), ("NOT_A_MEMBER", "provenance.derivation_links[].relation_type"), ("UNKNOWN_FIELD", "provenance.derivation_links[].more"), ("MISSING_FIELD", "provenance.derivation_links[].object_id"), ("NOT_A_MEMBER", "provenance.human_review.status"), ("REVIEW_INCOMPLETE", "")}),
    "not structs": (payload("claim", provenance__derivation_links=[1], time_horizon="2024"), {("WRONG_TYPE", "provenance.derivation_links"), ("WRONG_TYPE", "time_horizon")}),
    "times": (payload("claim", updated_at="2023-01-01T00:00:00Z", deleted_at="2024-01-01T00:00:00Z", time_horizon={"start": "2024-02-01", "end": "2024-01-01"}), {("UPDATED_BEFORE_CREATED", ""), ("DELETED_AT_MISMATCH", ""), ("TIME_REVERSED", "")}),
    "prediction": (payload("claim", time_horizon=None), {("PREDICTION_WITHOUT_HORIZON", "")}),
    "derived": (payload("claim", provenance={"origin_type": "derived"}), {("DERIVED_WITHOUT_ORIGINS", "")}),
    "links twice": (payload("claim", provenance__derivation_links=[{"object_id": "a", "relation_type": "reposts"}] * 2), {("DUPLICATE_LINK", "")}),
    "currency": (payload("data_point", measurement_context__currency="usd", value="1"), {("BAD_CURRENCY", ""), ("WRONG_TYPE", "value")}),
    "relation": (payload("relation", object_id="ent_1", evidence_ids=[]), {("SELF_RELATION", ""), ("NO_EVIDENCE", "")}),
    "locator": (payload("content_unit", locator={"heading_path": []}), {("EMPTY_LOCATOR", "")}),
    "opinion": (payload("personal_opinion", confirmed_at=None, key_assumptions=[]), {("NOT_CONFIRMED", ""), ("ACTIVE_INCOMPLETE", "")}),
    "output": (payload("output_artifact", content="", opinion_refs=[]), {("NO_CONTENT", ""), ("NO_REFERENCE", "")}),
    "run": (payload("processing_run", run_status="failed", finished_at="2023-01-01T00:00:00Z"), {("FINISHED_BEFORE_START", ""), ("NO_ERROR_MESSAGE", "")}),
    "day": (payload("insight", validity__as_of_date="2024-13-01"), {("WRONG_TYPE", "validity.as_of_date")}),
    "url": (payload("source", homepage_url="ftp://x"), {("WRONG_TYPE", "homepage_url")}),
}


def test_findings(spark):
    rows = [(f"ok {k}", payload(k)) for k in objects.TYPES] + [(k, p) for k, (p, _) in BROKEN.items()] + [("null", None)]
    found = {}
    for r in payloads.payload_findings(spark.createDataFrame(rows, "id string, payload string")).collect():
        found.setdefault(r.id, set()).add((r.code, r.path))
    want = {k: f for k, (_, f) in BROKEN.items() if f} | {"null": {("INVALID_JSON", "")}}
    assert {k: v for k, v in found.items() if v != want.get(k)} == {} and set(found) == set(want)


def test_valid_records_stay(spark):
    rows = spark.createDataFrame([("a", payload("fact"), 1), ("b", "{}", 2)], "id string, payload string, more int")
    assert [r.id for r in payloads.typed(rows).collect()] == ["a"]


@pytest.mark.parametrize("kind", sorted(objects.TYPES))
def test_schemas_name_every_field(kind):
    schema = objects.json_schema(kind)
    assert set(schema["properties"]) == set(objects.COMMON | objects.TYPES[kind]) >= set(json.loads(payload(kind)))
    assert set(schema["required"]) <= set(json.loads(payload(kind)))
