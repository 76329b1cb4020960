"""Payloads against the object model (survey B4, E4): types, unknown and missing fields, bounds, members and rules between fields.

The rules are a table derived from `functions.objects`, a few hundred rows however many payloads there are, and are joined by
broadcast. A payload is parsed to VARIANT once; its fields, then those of its nested structs, are laid out beside each other
level by level, so all findings come from one pass without a shuffle. Repeated keys in an object make it invalid JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import objects
from tessera.operators.store import upgrade_payload

#: Object, struct in it, list of structs, element: as deep as the model goes.
LEVELS = 4


def _at(path: str, kind: str = "string") -> str:
    return f"try_variant_get(v, '$.{path}', '{kind}')"


def _list(path: str) -> str:
    return f"coalesce(size({_at(path, 'array<variant>')}), 0)"


def _reversed(path: str, start: str = "start", end: str = "end") -> str:
    """Compared as days."""
    return f"to_date({_at(f'{path}.{end}', 'timestamp')}) < to_date({_at(f'{path}.{start}', 'timestamp')})"


#: Rules between fields by type, "" for all: a code where the SQL over the payload `v` holds. Fixed values.
BETWEEN = {
    "": {
        "UPDATED_BEFORE_CREATED": f"{_at('updated_at', 'timestamp')} < {_at('created_at', 'timestamp')}",
        "DELETED_AT_MISMATCH": f"({_at('deleted_at')} IS NOT NULL) <> (coalesce({_at('status')}, 'active') = 'deleted')",
        "DERIVED_WITHOUT_ORIGINS": f"{_at('provenance.origin_type')} = 'derived' AND {_list('provenance.origin_object_ids')} = 0 AND {_list('provenance.derivation_links')} = 0",
        "DUPLICATE_LINK": f"size(array_distinct(transform({_at('provenance.derivation_links', 'array<variant>')}, x -> struct(try_variant_get(x, '$.object_id', 'string'), try_variant_get(x, '$.relation_type', 'string'))))) < {_list('provenance.derivation_links')}",
        "REVIEW_INCOMPLETE": f"coalesce({_at('provenance.human_review.status')}, 'not_reviewed') <> 'not_reviewed' AND (coalesce({_at('provenance.human_review.reviewed_by')}, '') = '' OR {_at('provenance.human_review.reviewed_at')} IS NULL)",
    },
    "content_unit": {
        "EMPTY_LOCATOR": " AND ".join([f"{_at(f'locator.{f}')} IS NULL" for f in objects.STRUCTS["locator"] if f != "heading_path"] + [f"{_list('locator.heading_path')} = 0"]),
        "END_BEFORE_START": f"{_at('locator.end_seconds', 'double')} < {_at('locator.start_seconds', 'double')} OR {_at('locator.line_end', 'long')} < {_at('locator.line_start', 'long')}",
    },
    "event": {"TIME_REVERSED": _reversed("event_time")},
    "data_point": {"BAD_CURRENCY": f"NOT {_at('measurement_context.currency')} RLIKE '\\\\A[A-Z]{{3}}\\\\z'", "TIME_REVERSED": _reversed("period")},
    "claim": {"PREDICTION_WITHOUT_HORIZON": f"{_at('claim_type')} = 'prediction' AND {_at('time_horizon')} IS NULL", "TIME_REVERSED": _reversed("time_horizon")},
    "fact": {"TIME_REVERSED": _reversed("valid_time")},
    "knowledge_object": {"NO_REFERENCE": " + ".join(_list(f"{f}_ids") for f in ("fact", "data_point", "claim", "evidence", "related_entity")) + " = 0", "TIME_REVERSED": _reversed("validity", "valid_from", "valid_to")},
    "relation": {"SELF_RELATION": f"{_at('subject_id')} = {_at('object_id')}", "NO_EVIDENCE": f"coalesce({_at('relation_status')}, 'asserted') <> 'hypothesized' AND {_list('evidence_ids')} = 0", "TIME_REVERSED": _reversed("valid_time")},
    "timeline_entry": {"TIME_REVERSED": _reversed("event_time")},
    "insight": {"TIME_REVERSED": _reversed("validity", "valid_from", "valid_to")},
    "personal_opinion": {
        "NOT_CONFIRMED": f"{_at('confirmed_by_user', 'boolean')} AND {_at('confirmed_at')} IS NULL",
        "ACTIVE_INCOMPLETE": f"{_at('opinion_status')} = 'active' AND NOT (coalesce({_at('confirmed_by_user', 'boolean')}, false) AND " + " AND ".join(f"{_list(f)} > 0" for f in ("supporting_ids", "key_assumptions", "invalidation_conditions")) + f" AND {_at('review_due_at')} IS NOT NULL)",
    },
    "output_artifact": {"NO_CONTENT": f"coalesce({_at('content_uri')}, '') = '' AND coalesce({_at('content')}, '') = ''", "NO_REFERENCE": " + ".join(_list(f"{f}_refs") for f in ("knowledge", "insight", "opinion")) + " = 0"},
    "processing_run": {
        "FINISHED_BEFORE_START": f"{_at('finished_at', 'timestamp')} < {_at('started_at', 'timestamp')}",
        "NOT_FINISHED": f"{_at('run_status')} IN ('success', 'partial_success', 'failed', 'cancelled') AND {_at('finished_at')} IS NULL",
        "NO_ERROR_MESSAGE": f"{_at('run_status')} = 'failed' AND coalesce({_at('error_message')}, '') = ''",
    },
}


def _number(bound: float | None) -> float | None:
    return None if bound is None else float(bound)


def rule_table(spark: SparkSession) -> DataFrame:
    """owner, field, kind, nullable, least, most, of, members: a row for each field of each type and struct."""
    rows = [(owner, name, f.kind, f.nullable, _number(f.least), _number(f.most), f.of, list(objects.members(f.of)) if f.kind == "member" else None) for owner, fields in objects.owners().items() for name, f in fields.items()]
    return spark.createDataFrame(rows, "owner string, field string, kind string, nullable boolean, least double, most double, of string, members array<string>")


def _owner_table(spark: SparkSession) -> DataFrame:
    rows = [(owner, [n for n, f in fields.items() if f.required]) for owner, fields in objects.owners().items()]
    return spark.createDataFrame(rows, "of string, required array<string>")


def _field_code() -> Column:
    """What is wrong with one value by its rule; null if nothing is."""
    form, text = F.schema_of_variant("value"), F.col("value").cast("string")
    kind, size = F.col("kind"), F.expr("size(try_variant_get(value, '$', 'array<variant>'))")
    is_text, is_number = form == "STRING", form.rlike(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z")
    as_number, as_time = text.try_cast("double"), text.try_cast("timestamp")
    element = lambda items, wanted: F.expr(f"size(filter({items}, x -> NOT startswith(schema_of_variant(x), '{wanted}'))) = 0")
    shape = (
        F.when(kind.isin("text", "member"), is_text)
        .when(kind == "texts", form.startswith("ARRAY") & element("try_variant_get(value, '$', 'array<variant>')", "STRING"))
        .when(kind == "structs", form.startswith("ARRAY") & element("try_variant_get(value, '$', 'array<variant>')", "OBJECT"))
        .when(kind == "whole", is_number & (as_number == F.floor(as_number)))
        .when(kind == "number", is_number)
        .when(kind == "flag", form == "BOOLEAN")
        .when(kind.isin("time", "moment"), is_text & as_time.isNotNull())
        .when(kind == "day", is_text & text.rlike(r"\A\d{4}-\d{2}-\d{2}\z") & text.try_cast("date").isNotNull())
        .when(kind == "url", is_text & text.rlike(r"\A(?i:https?)://[^\s/?#]+"))
        .when(kind == "map", form.startswith("OBJECT") & element("map_values(try_variant_get(value, '$', 'map<string,variant>'))", "STRING"))
        .otherwise(form.startswith("OBJECT"))
    )
    measure = F.when(kind == "text", F.length(F.trim(text))).when(kind.isin("texts", "structs"), size).when(kind.isin("whole", "number"), as_number)
    return (
        F.when(F.col("kind").isNull(), "UNKNOWN_FIELD")
        .when(F.col("value").isNull(), "MISSING_FIELD")
        .when(form == "VOID", F.when(~F.col("nullable"), "NULL_FIELD"))
        .when(~F.coalesce(shape, F.lit(False)), "WRONG_TYPE")
        .when((kind == "member") & ~F.array_contains("members", text), "NOT_A_MEMBER")
        .when(measure < F.col("least"), "TOO_SMALL")
        .when(measure > F.col("most"), "TOO_LARGE")
    )


def _level(rows: DataFrame, rules: DataFrame, owners: DataFrame) -> DataFrame:
    """rows (id, path, value, of, code) with those that have an `of` replaced by a row for each field they have or lack."""
    opened = rows.join(F.broadcast(owners), "of", "left")
    have = F.expr("try_variant_get(value, '$', 'map<string,variant>')")
    fields = F.transform(F.map_entries(have), lambda e: F.struct(e["key"].alias("field"), e["value"].alias("value")))
    lacking = F.transform(F.array_except("required", F.map_keys(have)), lambda k: F.struct(k.alias("field"), F.lit(None).cast("variant").alias("value")))
    elements = F.transform(F.expr("try_variant_get(value, '$', 'array<variant>')"), lambda x, i: F.struct(F.concat(F.lit("#"), i.cast("string")).alias("field"), x.alias("value")))
    nothing = F.array().cast("array<struct<field:string,value:variant>>")
    inside = F.when(F.col("of").isNull(), nothing).when(F.schema_of_variant("value").startswith("ARRAY"), elements).otherwise(F.concat(fields, lacking))
    own = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col("value")))
    laid = opened.select("id", "path", "code", F.col("of").alias("owner"), F.explode(F.when(F.col("of").isNull(), own).otherwise(F.coalesce(inside, nothing))).alias("e")).select("id", "path", "code", "owner", "e.*")
    judged = laid.join(F.broadcast(rules), ["owner", "field"], "left")
    element = F.col("field").startswith("#")
    code = F.when(F.col("owner").isNull(), F.col("code")).when(~element, _field_code())
    nested = F.when(element, F.col("owner")).when(F.col("kind").isin("struct", "structs") & code.isNull() & (F.schema_of_variant("value") != "VOID"), F.col("of"))
    path = F.when(F.col("owner").isNull() | (F.col("path") == ""), F.coalesce("field", "path")).otherwise(F.concat("path", F.lit("."), "field"))
    return judged.select("id", path.alias("path"), "value", nested.alias("of"), code.alias("code"))


def payload_findings(records: DataFrame, payload: str = "payload") -> DataFrame:
    """(id, code, path) of what keeps payloads (id, `payload`: JSON) from being objects of the current version.

    Payloads of older versions are upgraded first. One that isn't an object, or of an unknown type or version, has that one
    finding. `path` is the field, "" for rules of the whole payload."""
    spark = records.sparkSession
    raw = F.try_parse_json(payload)
    kind = F.try_variant_get(raw, "$.object_type", "string")
    version = F.try_variant_get(raw, "$.schema_version", "string")
    current = F.when(version.isin(*objects.OLDER_VERSIONS), upgrade_payload(F.col(payload), kind)).otherwise(F.col(payload))
    known = records.select("id", raw.alias("raw"), kind.alias("kind"), version.alias("version"), F.try_parse_json(current).alias("v"))
    fatal = (
        F.when(F.col("raw").isNull(), "INVALID_JSON")
        .when(~F.schema_of_variant("raw").startswith("OBJECT"), "NOT_AN_OBJECT")
        .when(F.col("version").isNull(), "MISSING_SCHEMA_VERSION")
        .when(~F.col("version").isin(objects.CURRENT_VERSION, *objects.OLDER_VERSIONS), "UNSUPPORTED_VERSION")
        .when(F.col("kind").isNull(), "MISSING_OBJECT_TYPE")
        .when(~F.col("kind").isin(*objects.TYPES), "UNSUPPORTED_TYPE")
        .when(F.col("v").isNull(), "INVALID_JSON")
    )
    when = lambda kind, rules: [F.when((F.lit(kind) == "") | (F.col("kind") == kind), F.when(F.expr(sql), F.lit(code))) for code, sql in rules.items()]
    between = F.array_compact(F.array(*reduce(lambda a, b: a + b, (when(k, r) for k, r in BETWEEN.items()))))
    codes = F.when(F.col("fatal").isNotNull(), F.array("fatal")).otherwise(F.concat(F.array(F.lit(None).cast("string")), between))
    rows = known.withColumn("fatal", fatal).select("id", "v", "kind", F.explode(codes).alias("code"))
    rows = rows.select("id", F.lit("").alias("path"), F.col("v").alias("value"), F.when(F.col("code").isNull(), F.col("kind")).alias("of"), "code")
    rules, owners = rule_table(spark), _owner_table(spark)
    for _ in range(LEVELS):
        rows = _level(rows, rules, owners)
    return rows.where("code IS NOT NULL").select("id", "code", F.regexp_replace("path", r"\.?#\d+", "[]").alias("path"))


def typed(records: DataFrame) -> DataFrame:
    """`records` whose payloads have no finding."""
    return records.join(payload_findings(records).select("id").distinct(), "id", "left_anti")
