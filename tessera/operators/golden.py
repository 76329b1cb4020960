"""The gate over golden sets: what annotators expect of each case, checked against frozen units and itself (survey L12, F19, G14, G15, J6).

Items are rows of all sections in one table: case_id, section, item_id and the fields of FIELDS, null where a section has no
such field. The rules are data; they compile to one pass over the rows, one anti join for all references of all sections,
one aggregate for ids, and the quote gate. Findings are rows (case_id, section, item_id, code, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import is_blank
from tessera.operators import gates
from tessera.operators.joins import null_safe

#: Sections, the first five with candidates' ids.
SECTIONS = ("entity", "data_point", "claim", "evidence", "fact_candidate", "warning", "reject", "review_decision", "disagreement")
#: Sections whose ids must differ from each other's within a case, and from their own. Fixed values.
NAMED = ("entity", "data_point", "claim", "evidence", "fact_candidate", "warning", "reject")

FIELDS = (
    "claim_type string, claim_dimension string, measurement_kind string, evidence_type string, evidence_role string, reason_code string, quote string, source_unit_id string, quote_match_mode string, "
    "entity_id string, claimant_id string, target_object_id string, supporting_evidence_ids array<string>, target_data_point_id string, target_claim_id string, target_id string, promotable boolean, "
    "promotable_to_fact boolean, valid_time string, confidence_rationale string, rejection_reason string, horizon_precision string, action string, revised_statement string, independence_group string, resolution string"
)

#: Allowed values by section and field. Fixed values.
MEMBERS = {
    ("claim", "claim_type"): ("fact_claim", "prediction", "risk_claim", "value_judgment", "opinion", "other"),
    ("claim", "claim_dimension"): ("financial_performance", "business_growth", "operations", "market_expectation", "competition", "valuation", "regulation", "technology", "esg", "general", "other"),
    ("data_point", "measurement_kind"): ("monetary", "percentage", "ratio", "count", "rate", "index", "score", "other"),
    ("evidence", "evidence_type"): ("company_filing", "observed_event", "direct_quote", "third_party_report", "expert_statement", "public_record", "other"),
    ("evidence", "evidence_role"): ("support", "refute", "context", "attribution"),
    ("reject", "reason_code"): ("CONTENT_UNIT_CODE_BLOCK_NON_CLAIM", "VALUE_JUDGMENT_NOT_FACT", "PREDICTION_NOT_FACT", "INSUFFICIENT_EVIDENCE", "SINGLE_SOURCE_ONLY", "CIRCULAR_SUPPORT", "UNSUPPORTED_CALCULATION", "OUT_OF_SCOPE", "other"),
    ("review_decision", "action"): ("APPROVE", "REJECT", "REVISE_AND_APPROVE"),
}
ACTIONS = MEMBERS["review_decision", "action"]

#: References by section and field: the sections one of which must have the id. Fixed values.
REFERENCES = {
    ("data_point", "entity_id"): ("entity",),
    ("claim", "claimant_id"): ("entity",),
    ("evidence", "target_object_id"): ("claim", "data_point"),
    ("fact_candidate", "supporting_evidence_ids"): ("evidence",),
    ("review_decision", "target_id"): ("entity", "claim", "data_point", "evidence", "fact_candidate", "reject"),
}

#: Sections whose quotes must stand in a frozen unit. Fixed values.
QUOTED = ("claim", "data_point", "evidence", "reject")
MATCH_MODES = ("literal", "token_set")

_lacks = lambda field: f"coalesce({field}, '') = ''"
#: What else must not hold, by section, as SQL over the fields. Fixed values.
RULES = {
    "fact_candidate": {
        "NO_TARGET": f"{_lacks('target_data_point_id')} AND {_lacks('target_claim_id')}",
        "TWO_TARGETS": f"NOT {_lacks('target_data_point_id')} AND NOT {_lacks('target_claim_id')}",
        "PROMOTABLE_WITHOUT_TIME": f"promotable AND {_lacks('valid_time')}",
        "PROMOTABLE_WITHOUT_RATIONALE": f"promotable AND {_lacks('confidence_rationale')}",
        "PROMOTABLE_WITHOUT_EVIDENCE": "promotable AND size(coalesce(supporting_evidence_ids, array())) = 0",
        "NO_REJECTION_REASON": f"NOT coalesce(promotable, false) AND {_lacks('rejection_reason')}",
    },
    "claim": {
        "PREDICTION_WITHOUT_HORIZON": "claim_type = 'prediction' AND horizon_precision IS NULL",
        "BAD_HORIZON_PRECISION": "claim_type = 'prediction' AND horizon_precision NOT IN ('exact', 'range', 'estimated', 'unknown')",
        "PREDICTION_PROMOTABLE": "claim_type = 'prediction' AND coalesce(promotable_to_fact, true)",
    },
    "review_decision": {"NO_TARGET": _lacks("target_id"), "REVISION_WITHOUT_STATEMENT": f"action = 'REVISE_AND_APPROVE' AND {_lacks('revised_statement')}"},
    "disagreement": {"NOT_RESOLVED": _lacks("resolution")},
}

_KEY = ("case_id", "section", "item_id")


def _row_findings(items: DataFrame) -> DataFrame:
    section = F.col("section")
    finding = lambda code, detail: F.struct(F.lit(code).alias("code"), detail.alias("detail"))
    found = [F.when((section == s) & (F.coalesce(F.col(f), F.lit("")) != "") & ~F.col(f).isin(*allowed), finding("NOT_A_MEMBER", F.lit(f))) for (s, f), allowed in MEMBERS.items()]
    found += [F.when((section == s) & F.expr(sql), finding(code, F.lit(""))) for s, rules in RULES.items() for code, sql in rules.items()]
    found.append(F.when(section.isin(*QUOTED) & ~is_blank(F.col("quote")) & ~F.coalesce("quote_match_mode", F.lit("literal")).isin(*MATCH_MODES), finding("BAD_MATCH_MODE", F.coalesce("quote_match_mode", F.lit("")))))
    return items.select(*_KEY, F.explode(F.array_compact(F.array(*found))).alias("f")).select(*_KEY, "f.code", "f.detail")


def dangling_references(items: DataFrame) -> DataFrame:
    """(case_id, section, item_id, field, reference) of references that no allowed section of the case has: one anti join for all."""

    def of(section: str, field: str, targets: tuple[str, ...]) -> Column:
        values = F.col(field) if field == "supporting_evidence_ids" else F.array(field)
        as_row = F.transform(values, lambda x: F.struct(F.lit(field).alias("field"), x.alias("reference"), F.array(*map(F.lit, targets)).alias("targets")))
        return F.when(F.col("section") == section, as_row)

    kinds = [of(s, f, t) for (s, f), t in REFERENCES.items()]
    refs = items.select(*_KEY, F.explode(F.coalesce(*kinds)).alias("r")).select(*_KEY, "r.*").where("coalesce(reference, '') <> ''")
    ids = items.select(F.col("case_id").alias("__case"), F.col("section").alias("__section"), F.col("item_id").alias("__id")).distinct()
    there = refs["case_id"].eqNullSafe(ids["__case"]) & (refs["reference"] == ids["__id"]) & F.array_contains(refs["targets"], ids["__section"])
    return refs.join(ids, there, "left_anti").drop("targets")


def id_collisions(items: DataFrame, case: str = "case_id") -> DataFrame:
    """(`case`, item_id, n, sections) of ids that a case has more than once, in whatever sections."""
    return items.groupBy(case, "item_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("section")).alias("sections")).where("n > 1")


def seen_values(items: DataFrame, by: str, field: str) -> DataFrame:
    """(`by`, seen: the values of `field` in order)."""
    return items.groupBy(by).agg(F.array_sort(F.collect_set(field)).alias("seen"))


def missing_actions(items: DataFrame) -> DataFrame:
    """(action) of review actions that no case has."""
    spark = items.sparkSession
    wanted = spark.createDataFrame([(a,) for a in ACTIONS], "action string")
    return wanted.join(items.where("section = 'review_decision'").select("action").distinct(), "action", "left_anti")


def shared_groups(items: DataFrame, first: str, second: str) -> DataFrame:
    """(independence_group) of groups whose evidence both cases have."""
    of = lambda case: items.where((F.col("section") == "evidence") & (F.col("case_id") == case)).select("independence_group").distinct()
    return null_safe(of(first), of(second), ["independence_group"], "left_semi")


def quote_findings(items: DataFrame, units: DataFrame) -> DataFrame:
    """The quote gate over frozen units (case_id, unit_id, unit_type, sequence_no, text); a reject's quote counts like a claim's."""
    own = items.where(F.col("section").isin(*QUOTED) & F.coalesce("quote_match_mode", F.lit("literal")).isin(*MATCH_MODES))
    name = F.to_json(F.struct("section", "item_id"))
    asked = own.select(F.col("case_id").alias("document_id"), name.alias("candidate_id"), F.col("section").alias("candidate_type"), F.col("quote").alias("source_quote"), "source_unit_id", "quote_match_mode")
    found = gates.quote_findings(asked, units.withColumnRenamed("case_id", "document_id"))
    back = F.from_json("candidate_id", "section string, item_id string")
    return found.select(F.col("document_id").alias("case_id"), back["section"].alias("section"), back["item_id"].alias("item_id"), "code", F.col("source_unit_id").alias("detail"))


def _valid_time(value: Column) -> Column:
    """An ISO date and time of the calendar, to the second at least."""
    return value.rlike(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}") & F.try_to_timestamp(F.left(value, F.lit(19)), F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()


def case_findings(cases: DataFrame) -> DataFrame:
    """Of cases (case_id, annotated_at, reviewed_by, reviewed_at): who reviewed, and times that aren't."""
    blank = lambda f: F.coalesce(F.col(f), F.lit("")) == ""
    found = [F.when(blank("reviewed_by"), F.struct(F.lit("NO_REVIEWER").alias("code"), F.lit("reviewed_by").alias("detail")))]
    for f in ("annotated_at", "reviewed_at"):
        code = F.when(blank(f), "NO_TIME").when(~F.coalesce(_valid_time(F.col(f)), F.lit(False)), "BAD_TIME")
        found.append(F.when(code.isNotNull(), F.struct(code.alias("code"), F.lit(f).alias("detail"))))
    rows = cases.select("case_id", F.explode(F.array_compact(F.array(*found))).alias("f"))
    return rows.select("case_id", F.lit("case").alias("section"), F.lit("").alias("item_id"), "f.code", "f.detail")


def complete(items: DataFrame) -> DataFrame:
    """All fields, null where they are lacking."""
    have = set(items.columns)
    lacking = [F.lit(None).cast(kind).alias(name) for name, kind in (x.split(" ") for x in FIELDS.split(", ")) if name not in have]
    return items.select(*items.columns, *lacking)


def golden_findings(items: DataFrame, units: DataFrame, cases: DataFrame) -> DataFrame:
    """All that is wrong with a golden set; it passes if there is no row."""
    items = complete(items)
    named = items.where(F.col("section").isin(*NAMED))
    parts = [
        _row_findings(items),
        dangling_references(items).select(*_KEY, F.lit("REFERENCE_NOT_FOUND").alias("code"), F.concat_ws(":", "field", "reference").alias("detail")),
        id_collisions(named).select("case_id", F.array_join("sections", ",").alias("section"), "item_id", F.lit("ID_COLLISION").alias("code"), F.col("n").cast("string").alias("detail")),
        quote_findings(items, units),
        case_findings(cases),
        missing_actions(items).select(F.lit(None).cast("string").alias("case_id"), F.lit("review_decision").alias("section"), F.lit("").alias("item_id"), F.lit("ACTION_NOT_COVERED").alias("code"), F.col("action").alias("detail")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
