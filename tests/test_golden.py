"""Golden sets with one thing wrong each; all rows are written for these tests."""

import pytest

from tessera.operators import golden

GOOD = [
    {"section": "entity", "item_id": "e1"},
    {"section": "data_point", "item_id": "p1", "entity_id": "e1", "measurement_kind": "ratio", "quote": "revenue  grew", "source_unit_id": "u1"},
    {"section": "claim", "item_id": "c1", "claimant_id": "e1", "claim_type": "prediction", "horizon_precision": "range", "promotable_to_fact": False, "quote": "grew", "source_unit_id": "u1"},
    {"section": "evidence", "item_id": "v1", "target_object_id": "p1", "evidence_role": "support", "quote": "12 total", "source_unit_id": "u2", "quote_match_mode": "token_set", "independence_group": "g"},
    {"section": "fact_candidate", "item_id": "f1", "target_data_point_id": "p1", "supporting_evidence_ids": ["v1"], "promotable": True, "valid_time": "2024", "confidence_rationale": "r"},
    {"section": "reject", "item_id": "r1", "quote": "revenue", "source_unit_id": "u1", "reason_code": "OUT_OF_SCOPE"},
    *({"section": "review_decision", "item_id": f"d{i}", "target_id": t, "action": a, "revised_statement": "s"} for i, (t, a) in enumerate(zip(("f1", "r1", "e1"), golden.ACTIONS, strict=True))),
    {"section": "disagreement", "item_id": "x", "resolution": "kept"},
]
CASE = {"annotated_at": "2024-02-29T10:00:00Z", "reviewed_by": "a", "reviewed_at": "2024-03-01T00:00:00"}


def at(item, **changes):
    return [x | changes if x["item_id"] == item else x for x in GOOD]


WRONG = {
    "nothing": (GOOD, CASE, set()),
    "reference": (at("p1", entity_id="c1"), CASE, {("data_point", "p1", "REFERENCE_NOT_FOUND")}),
    "evidence": (at("f1", supporting_evidence_ids=["v1", "v9"]), CASE, {("fact_candidate", "f1", "REFERENCE_NOT_FOUND")}),
    "two targets": (at("f1", target_claim_id="c1"), CASE, {("fact_candidate", "f1", "TWO_TARGETS")}),
    "no targets": (at("f1", target_data_point_id=None), CASE, {("fact_candidate", "f1", "NO_TARGET")}),
    "promotable": (at("f1", valid_time="", confidence_rationale=None, supporting_evidence_ids=[]), CASE, {("fact_candidate", "f1", f"PROMOTABLE_WITHOUT_{x}") for x in ("TIME", "RATIONALE", "EVIDENCE")}),
    "not promotable": (at("f1", promotable=False), CASE, {("fact_candidate", "f1", "NO_REJECTION_REASON")}),
    "member": (at("v1", evidence_role="qualify"), CASE, {("evidence", "v1", "NOT_A_MEMBER")}),
    "horizon": (at("c1", horizon_precision="day", promotable_to_fact=None), CASE, {("claim", "c1", "BAD_HORIZON_PRECISION"), ("claim", "c1", "PREDICTION_PROMOTABLE")}),
    "quote": (at("r1", quote="losses"), CASE, {("reject", "r1", "QUOTE_NOT_FOUND")}),
    "table": (at("v1", source_unit_id="u1", quote="grew revenue"), CASE, {("evidence", "v1", "TOKEN_SET_ON_NON_TABLE")}),
    "other case": (at("c1", source_unit_id="u9"), CASE, {("claim", "c1", "CROSS_DOCUMENT_UNIT")}),
    "mode": (at("c1", quote_match_mode="fuzzy"), CASE, {("claim", "c1", "BAD_MATCH_MODE")}),
    "collision": ([*GOOD, {"section": "warning", "item_id": "c1"}], CASE, {("claim,warning", "c1", "ID_COLLISION")}),
    "actions": (at("d1", action="APPROVE"), CASE, {("review_decision", "", "ACTION_NOT_COVERED")}),
    "revision": (at("d2", revised_statement=""), CASE, {("review_decision", "d2", "REVISION_WITHOUT_STATEMENT")}),
    "disagreement": (at("x", resolution=None), CASE, {("disagreement", "x", "NOT_RESOLVED")}),
    "times": (GOOD, CASE | {"annotated_at": "2023-02-29T10:00:00", "reviewed_at": None, "reviewed_by": ""}, {("case", "", "BAD_TIME"), ("case", "", "NO_TIME"), ("case", "", "NO_REVIEWER")}),
}


def frame(spark, items):
    schema = f"case_id string, section string, item_id string, {golden.FIELDS}"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(x.get(n) for n in names) for x in items], schema)


@pytest.fixture(scope="module")
def found(spark):
    """All cases in one run, except for the action that no case must have."""
    rows = [x | {"case_id": name} for name, (items, _, _) in WRONG.items() if name != "actions" for x in items]
    cases = spark.createDataFrame([(n, c["annotated_at"], c["reviewed_by"], c["reviewed_at"]) for n, (_, c, _) in WRONG.items() if n != "actions"], "case_id string, annotated_at string, reviewed_by string, reviewed_at string")
    units = [(n, u, k, 0, t) for n in WRONG for u, k, t in (("u1", "paragraph", "Total revenue grew by 12."), ("u2", "TABLE_ROW", "total | 12 | EUR"))] + [("elsewhere", "u9", "paragraph", 0, "grew")]
    frozen = spark.createDataFrame(units, "case_id string, unit_id string, unit_type string, sequence_no int, text string")
    return [tuple(r) for r in golden.golden_findings(frame(spark, rows), frozen, cases).collect()]


@pytest.mark.parametrize("name", [n for n in WRONG if n != "actions"])
def test_case(found, name):
    assert {f[1:4] for f in found if f[0] == name} == WRONG[name][2]


def test_coverage_over_cases(spark):
    rows = frame(spark, [x | {"case_id": c} for c in ("a", "b") for x in WRONG["actions"][0]])
    assert [r.action for r in golden.missing_actions(rows).collect()] == ["REJECT"]
    assert [r.independence_group for r in golden.shared_groups(rows, "a", "b").collect()] == ["g"]
    assert golden.shared_groups(rows, "a", "c").isEmpty()
