"""Repository, versions, runs and draft plans over driver tables (survey E1-E3, F9-F18, G1, G11-G15, I1, J6, J8, N)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.durable import shared_folder
from tessera.functions import text as t
from tessera.operators import drafts, gates, golden, ingestion, payloads, store
from tessera.operators.gates import complete
from tessera.session import table


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as object records of three types in two workspaces, some deleted, some of version 1.0."""
    o = F.col("o_orderkey")
    kind = F.when(o % 3 == 0, "data_point").when(o % 3 == 1, "claim").otherwise("document")
    payload = F.to_json(F.struct(F.create_map(F.lit("erp"), o.cast("string")).alias("external_ids"), F.col("o_orderpriority").alias("priority")))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("obj_"), o.cast("string")).alias("id"), kind.alias("object_type"), F.when(o % 4 == 0, "1.0").otherwise("1.1").alias("schema_version"),
        F.when(o % 11 == 0, "deleted").otherwise("active").alias("lifecycle_status"), F.when(o % 2 == 0, "a").otherwise("b").alias("workspace_id"),
        F.lit("private").alias("privacy_level"), F.lit("u").alias("created_by"), F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
        F.when(o % 11 == 0, F.col("o_orderdate")).alias("deleted_at"), F.lit(1).alias("version"), payload.alias("payload"),
    )


def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.repository_filter(records(spark, sf_dir), "claim", "a", "active")
    return rows.orderBy("created_at", "id").offset(20).limit(100).select("id", "object_type", "workspace_id")


def external_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store.repository_filter(records(spark, sf_dir), workspace_id="b")
    key = F.get_json_object("payload", "$.external_ids['erp']").cast("long")
    return rows.where((key % 100 == 7) | (F.get_json_object("payload", "$.priority") == "1-URGENT")).groupBy("object_type").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir)
    live = store.repository_filter(rows).groupBy("object_type", "workspace_id").agg(F.count("*").alias("n_live"))
    return rows.groupBy("object_type", "workspace_id").agg(F.count("*").alias("n_all")).join(live, ["object_type", "workspace_id"], "left")


def upgrade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records of version 1.0 with legacy origins, some of them repeated or blank."""
    o = F.col("o_orderkey")
    origins = F.array(F.concat(F.lit("doc_"), (o % 5).cast("string")), F.lit(""), F.concat(F.lit("doc_"), (o % 3).cast("string")), F.concat(F.lit("doc_"), (o % 5).cast("string")))
    typed = records(spark, sf_dir).withColumn("o_orderkey", F.substring_index("id", "_", -1).cast("long")).select(
        "id", "object_type", "schema_version", F.lit(None).cast("struct<measurement_kind:string,currency:string,scale_multiplier:bigint,reporting_standard:string,attribution_scope:string,consolidation_scope:string>").alias("measurement_context"),
        F.when(o % 8 == 0, "risk").alias("claim_dimension"), origins.alias("origin_object_ids"), F.lit(None).cast("array<struct<object_id:string,relation_type:string,note:string>>").alias("derivation_links"),
    )
    up = store.upgrade_records(typed)
    links = F.array_join(F.transform("derivation_links", lambda x: F.concat_ws(":", x["object_id"], x["relation_type"])), ",")
    return up.select("id", "schema_version", F.coalesce("measurement_context.measurement_kind", F.lit("")).alias("kind"), F.coalesce("claim_dimension", F.lit("")).alias("claim_dimension"), F.coalesce(links, F.lit("")).alias("links"))


_UPGRADE_SQL = """
WITH o AS (SELECT o_orderkey AS o, o_orderkey % 4 = 0 AS old FROM orders)
SELECT 'obj_' || o AS id, '1.1' AS schema_version, CASE WHEN old AND o % 3 = 0 THEN 'unknown' ELSE '' END AS kind,
  CASE WHEN o % 8 = 0 THEN 'risk' WHEN old AND o % 3 = 1 THEN 'general' ELSE '' END AS claim_dimension,
  CASE WHEN NOT old THEN '' WHEN o % 5 = o % 3 THEN 'doc_' || o % 5 || ':derived_from' ELSE 'doc_' || o % 5 || ':derived_from,doc_' || o % 3 || ':derived_from' END AS links FROM o"""


def migration_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a migration from 1.0 would do, by type; payloads of every fifth claim have the wrong version inside."""
    o = F.substring_index("id", "_", -1).cast("long")
    payload = F.concat(F.lit('{"schema_version":"'), F.when(o % 5 == 0, "0.9").otherwise("1.0"), F.lit('","provenance":{"origin_object_ids":["doc_1"]}}'))
    rows = records(spark, sf_dir).where("schema_version = '1.0'").withColumn("new", store.upgrade_payload(payload, F.col("object_type")))
    return rows.groupBy("object_type").agg(F.count("*").alias("selected"), F.count("new").alias("migrated"), F.count_if(F.col("new").isNull()).alias("failed"), F.max("new").alias("sample"))


_LINK = '[{"object_id":"doc_1","relation_type":"derived_from","note":"legacy V1.0 compatibility mapping"}]'
_MIGRATION_SQL = f"""
WITH r AS (SELECT o_orderkey AS o, CASE o_orderkey % 3 WHEN 0 THEN 'data_point' WHEN 1 THEN 'claim' ELSE 'document' END AS object_type FROM orders WHERE o_orderkey % 4 = 0)
SELECT object_type, count(*) AS selected, count(*) FILTER (o % 5 <> 0) AS migrated, count(*) FILTER (o % 5 = 0) AS failed,
  '{{"schema_version":"1.1","provenance":{{"derivation_links":{_LINK},"origin_object_ids":["doc_1"]}}' ||
  CASE object_type WHEN 'claim' THEN ',"claim_dimension":"general"' WHEN 'data_point' THEN ',"measurement_context":{{"measurement_kind":"unknown","currency":null,"scale_multiplier":1,"reporting_standard":null,"attribution_scope":null,"consolidation_scope":null}}' ELSE '' END || '}}' AS sample
FROM r GROUP BY object_type"""


def plan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd documents come in; those with ids below a third of the largest are there already, by content."""
    docs = table(spark, sf_dir, "documents").select("doc_id", t.content_hash(F.col("text")).alias("dedupe_key"), F.concat(F.lit("series_"), "source").alias("series_key"))
    there = docs.where("doc_id % 6 = 0").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document_id"), "dedupe_key", "series_key", (F.col("doc_id") / 6 + 1).cast("int").alias("version_no"))
    there = there.groupBy("dedupe_key").agg(F.min_by(F.struct("document_id", "series_key", "version_no"), "version_no").alias("x")).select("dedupe_key", "x.*")
    plan = ingestion.plan_documents(docs.withColumnRenamed("doc_id", "input_no"), there, "new_version")
    return plan.select("input_no", "action", F.col("version_no").cast("long").alias("version_no"))


_PLAN_SQL = """
WITH d AS (SELECT doc_id, sha256(rtrim(text, chr(10))) AS k, source AS s FROM documents),
t AS (SELECT k, arg_min(s, doc_id) AS s, CAST(min(doc_id) // 6 + 1 AS BIGINT) AS v FROM d WHERE doc_id % 6 = 0 GROUP BY k),
l AS (SELECT s, max(v) AS v FROM t GROUP BY s),
c AS (SELECT d.*, row_number() OVER (PARTITION BY k ORDER BY doc_id) > 1 OR k IN (SELECT k FROM t) AS known FROM d)
SELECT doc_id AS input_no, CASE WHEN known THEN 'NEW_VERSION' ELSE 'CREATED' END AS action, coalesce(l.v, 0) + row_number() OVER (PARTITION BY c.s ORDER BY doc_id) AS version_no FROM c LEFT JOIN l USING (s)"""


def plan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    n = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    incoming = docs.select(F.concat(F.lit("src_new_"), "source").alias("source_id"), F.lit("blog").alias("source_type"), F.concat(F.lit("name:blog:"), "source").alias("canonical_key"), F.col("source").alias("name"))
    one = docs.where(n % 3 == 0).select(F.concat(F.lit("src_old_"), "source").alias("source_id"), F.lit("blog").alias("source_type"), F.concat(F.lit("name:blog:"), "source").alias("canonical_key"), F.when(n % 2 == 0, F.upper("source")).otherwise(F.col("source")).alias("name"))
    two = one.where(F.col("source_id") == "src_old_src9").withColumn("source_id", F.lit("src_old_zz"))
    return ingestion.plan_sources(incoming, one.unionByName(two)).withColumn("warning", F.coalesce("warning", F.lit("")))


_SOURCES_SQL = """
WITH s AS (SELECT DISTINCT source AS x, CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS n FROM documents)
SELECT CASE WHEN n % 3 = 0 THEN 'src_old_' ELSE 'src_new_' END || x AS source_id, 'blog' AS source_type, 'name:blog:' || x AS canonical_key, x AS name,
  CASE WHEN x = 'src9' THEN 'AMBIGUOUS' WHEN n % 3 = 0 THEN 'TOUCH' ELSE 'CREATE' END AS action, CASE WHEN n % 3 = 0 AND n % 2 = 0 THEN 'SOURCE_NAME_DIFFERS' ELSE '' END AS warning FROM s"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ("pending", "running", "success", "failed"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("at"), status.alias("run_status"), "event_id")


def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingestion.latest_runs(_log(spark, sf_dir)).select("run_id", "run_status")


_RUNS_SQL = "SELECT CAST(user_id AS VARCHAR) AS run_id, arg_max(['pending', 'running', 'success', 'failed'][event_id % 4 + 1], (ts, event_id % 4)) AS run_status FROM events GROUP BY user_id"


def operation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    runs = log.select(F.col("event_id").cast("string").alias("run_id"), F.col("at").alias("created_at"), "run_status", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("k"), "run_id")).alias("external_key"), F.when(F.col("event_id") % 2 == 1, F.array(F.concat(F.lit("k"), "run_id"))).alias("input_object_ids"))
    keys = table(spark, sf_dir, "events").select(F.concat(F.lit("k"), (F.col("user_id") + 3).cast("string")).alias("operation_key")).distinct()
    return ingestion.operation_status(runs, keys).select("operation_key", F.coalesce("run_status", F.lit("")).alias("run_status"))


_OPERATIONS_SQL = """
WITH k AS (SELECT DISTINCT 'k' || (user_id + 3) AS operation_key FROM events),
l AS (SELECT 'k' || user_id AS operation_key, arg_max(['pending', 'running', 'success', 'failed'][event_id % 4 + 1], (ts, CAST(event_id AS VARCHAR))) AS run_status FROM events GROUP BY user_id)
SELECT operation_key, coalesce(run_status, '') AS run_status FROM k LEFT JOIN l USING (operation_key)"""


def mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as entities, their orders as data points that refer to them by candidate id."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c_"), F.col("c_custkey").cast("string")).alias("candidate_id"), F.lit("entity").alias("candidate_type"), F.when(F.col("c_custkey") % 9 == 0, "alien").otherwise("company").alias("entity_type"), F.col("c_name").alias("canonical_name"), F.lit("cu_1").alias("source_unit_id"))
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("d_"), F.col("o_orderkey").cast("string")).alias("candidate_id"), F.lit("data_point").alias("candidate_type"), F.lit("totalprice").alias("metric"), F.lit(1.0).alias("value"), F.lit("USD").alias("unit"), F.concat(F.lit("c_"), F.col("o_custkey").cast("string")).alias("entity_id"), F.concat(F.year("o_orderdate").cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("period"), F.lit("cu_2").alias("source_unit_id"))
    both = complete(c).unionByName(complete(o))
    groups = spark.sql("SELECT * FROM VALUES ('cu_1', 'g1'), ('cu_2', 'g2') AS t(source_unit_id, independence_group)")
    objects = drafts.map_candidates(both, groups, "ws")
    known = objects.select(F.col("id").alias("entity_id"), F.col("canonical_name").alias("entity_name")).where("entity_name IS NOT NULL")
    lacking = drafts.strictness_findings(objects).groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("missing")), ",").alias("missing"))
    return objects.drop("canonical_name").join(known, "entity_id", "left").join(lacking, "id", "left").groupBy("object_type", F.coalesce("entity_name", F.lit("")).alias("entity_name"), F.coalesce("missing", F.lit("")).alias("missing")).agg(F.count("*").alias("n"), F.coalesce(F.min("period_start").cast("string"), F.lit("")).alias("first_period"))


_MAPPED_SQL = """
SELECT 'entity' AS object_type, '' AS entity_name, CASE WHEN c_custkey % 9 = 0 THEN 'entity_type' ELSE '' END AS missing, count(*) AS n, '' AS first_period FROM customer GROUP BY ALL
UNION ALL SELECT 'data_point', c_name, '', count(*), CAST(min(make_date(year(o_orderdate), (quarter(o_orderdate) - 1) * 3 + 1, 1)) AS VARCHAR) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name"""


def collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that two sections share."""
    sections = [table(spark, sf_dir, n).select(F.col(k).cast("long").alias("item_id"), F.lit(n).alias("section"), F.lit("all").alias("case_id")) for n, k in (("part", "p_partkey"), ("supplier", "s_suppkey"), ("customer", "c_custkey"))]
    found = golden.id_collisions(sections[0].unionByName(sections[1]).unionByName(sections[2]))
    return found.select(F.col("item_id").alias("id"), "n", F.array_join("sections", ",").alias("sections"))


def accepted_or_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as decisions and toxic ones as errors: actions seen, accepted ones and those in both sets, by source."""
    labels = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")
    name = F.col("doc_id").cast("string")
    candidates = labels.where("quality = 1").select(F.col("source").alias("document_id"), name.alias("candidate_id"), F.lit("claim").alias("candidate_type"))
    errors = labels.where("toxic = 1").select(F.col("source").alias("document_id"), name.alias("candidate_id"), F.lit("X").alias("code"), F.lit("ERROR").alias("severity"))
    judged = gates.verdicts(candidates, errors).groupBy(F.col("document_id").alias("source")).agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("overlap"))
    seen = golden.seen_values(labels.withColumn("action", F.col("quality").cast("string")), "source", "action")
    return seen.select("source", F.array_join("seen", ",").alias("actions")).join(judged, "source", "left").na.fill(0)


def golden_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source is a case; a document gives it an entity, a data point, a claim, evidence, a fact candidate, a reject
    and a decision, with what is wrong by the number of the document; its first line is a frozen unit."""
    d = F.col("doc_id")
    n = d.cast("string")
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").select("doc_id", F.col("source").alias("case_id"), F.concat(F.lit("x"), F.get(F.split(F.coalesce("text", F.lit("")), "\n"), F.lit(0))).alias("line"))
    unit, quote = F.concat(F.lit("cu_"), n), F.when(d % 11 == 0, "no such words").otherwise("x")
    has = lambda section, prefix, **fields: golden.complete(docs.select("case_id", F.lit(section).alias("section"), F.concat(F.lit(prefix), n).alias("item_id"), *(v.alias(k) for k, v in fields.items())))
    parts = [
        has("entity", "e"), has("entity", "e").where(F.expr("cast(substring(item_id, 2) AS long) % 29 = 0")),
        has("data_point", "p", entity_id=F.concat(F.when(d % 7 == 0, "z").otherwise("e"), n), measurement_kind=F.when(d % 5 == 0, "odd").otherwise("ratio"), quote=quote, source_unit_id=unit),
        has("claim", "c", claim_type=F.when(d % 3 == 0, "prediction").otherwise("opinion"), horizon_precision=F.when(d % 6 == 0, "exact"), promotable_to_fact=F.lit(False), quote=F.lit("x"), source_unit_id=F.when(d % 13 == 0, "").otherwise(unit), quote_match_mode=F.when(d % 17 == 0, "fuzzy")),
        has("evidence", "v", target_object_id=F.concat(F.when(d % 2 == 0, "c").otherwise("p"), n), quote=F.lit("x"), source_unit_id=unit, evidence_role=F.lit("support")),
        has("fact_candidate", "f", target_claim_id=F.when(d % 2 == 0, F.concat(F.lit("c"), n)), target_data_point_id=F.when(d % 3 == 0, F.concat(F.lit("p"), n)), supporting_evidence_ids=F.array(F.concat(F.lit("v"), n), F.when(d % 19 == 0, "v_none")), promotable=d % 4 == 0, valid_time=F.lit("2024"), confidence_rationale=F.when(d % 8 == 0, "r"), rejection_reason=F.lit("r")),
        has("review_decision", "r", target_id=F.concat(F.lit("f"), n), action=F.when(d % 2 == 0, "APPROVE").otherwise("REVISE_AND_APPROVE"), revised_statement=F.when(d % 5 != 0, "s")),
    ]
    items = parts[0]
    for more in parts[1:]:
        items = items.unionByName(more)
    units = docs.select("case_id", unit.alias("unit_id"), F.lit("paragraph").alias("unit_type"), F.lit(0).alias("sequence_no"), F.col("line").alias("text"))
    i = F.regexp_extract("case_id", r"(\d+)", 1).cast("int")
    cases = docs.select("case_id").distinct().select("case_id", F.when(i % 2 == 0, "a").alias("reviewed_by"), F.lit("2024-02-29T10:00:00Z").alias("annotated_at"), F.when(i % 3 == 0, "2023-02-29T10:00:00Z").otherwise("2024-01-01T00:00:00").alias("reviewed_at"))
    return golden.golden_findings(items, units, cases).groupBy("section", "code").agg(F.count("*").alias("n"), F.count_distinct("case_id").alias("n_cases"))


_GOLDEN_SQL = """
WITH d AS (SELECT doc_id AS d, source AS s, CASE WHEN contains('x' || string_split(coalesce(text, ''), chr(10))[1], 'no such words') THEN 1 ELSE 0 END AS odd FROM documents WHERE source IS NOT NULL),
c AS (SELECT DISTINCT s, CAST(regexp_extract(s, '([0-9]+)', 1) AS INTEGER) AS i FROM d),
f AS (SELECT 'data_point' AS section, 'REFERENCE_NOT_FOUND' AS code, s FROM d WHERE d % 7 = 0 UNION ALL SELECT 'data_point', 'NOT_A_MEMBER', s FROM d WHERE d % 5 = 0
  UNION ALL SELECT 'data_point', 'QUOTE_NOT_FOUND', s FROM d WHERE d % 11 = 0 AND odd = 0 UNION ALL SELECT 'entity', 'ID_COLLISION', s FROM d WHERE d % 29 = 0
  UNION ALL SELECT 'claim', 'PREDICTION_WITHOUT_HORIZON', s FROM d WHERE d % 3 = 0 AND d % 6 <> 0 UNION ALL SELECT 'claim', 'ILLEGAL_UNIT_REFERENCE', s FROM d WHERE d % 13 = 0 AND d % 17 <> 0 UNION ALL SELECT 'claim', 'BAD_MATCH_MODE', s FROM d WHERE d % 17 = 0
  UNION ALL SELECT 'fact_candidate', 'NO_TARGET', s FROM d WHERE d % 2 <> 0 AND d % 3 <> 0 UNION ALL SELECT 'fact_candidate', 'TWO_TARGETS', s FROM d WHERE d % 6 = 0 UNION ALL SELECT 'fact_candidate', 'REFERENCE_NOT_FOUND', s FROM d WHERE d % 19 = 0
  UNION ALL SELECT 'fact_candidate', 'PROMOTABLE_WITHOUT_RATIONALE', s FROM d WHERE d % 4 = 0 AND d % 8 <> 0 UNION ALL SELECT 'review_decision', 'REVISION_WITHOUT_STATEMENT', s FROM d WHERE d % 2 = 1 AND d % 5 = 0
  UNION ALL SELECT 'case', 'NO_REVIEWER', s FROM c WHERE i % 2 = 1 UNION ALL SELECT 'case', 'BAD_TIME', s FROM c WHERE i % 3 = 0 UNION ALL SELECT 'review_decision', 'ACTION_NOT_COVERED', NULL)
SELECT section, code, count(*) AS n, count(DISTINCT s) AS n_cases FROM f GROUP BY ALL"""


def payloads_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as payloads of claims and data points, wrong in a way of their own by key."""
    o = F.col("o_orderkey")
    way = (o % 16).cast("int")
    head = lambda kind, version="1.1": F.concat(F.lit(f'{{"object_type":"{kind}","schema_version":"{version}","created_at":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('T00:00:00Z","external_ids":{"erp":"'), o.cast("string"), F.lit('"}'))
    claim = ',"claim_type":"fact_claim","statement":"s","asserted_by":"a","source_ref":"cu_1"'
    point = ',"metric":"totalprice","unit":"USD","entity_id":"ent_1","source_ref":"cu_1","period":{"start":"1995-01-01","end":"1995-03-31","precision":"quarter"},"value":'
    with_point = lambda more: F.concat(head("data_point"), F.lit(point), F.col("o_totalprice").cast("string"), F.lit(more + "}"))
    with_claim = lambda more, version="1.1", kind="claim", body=claim: F.concat(head(kind, version), F.lit(body + more + "}"))
    forms = [
        with_point(""), with_claim(""), with_claim("", version="1.0"), F.lit("{broken"), with_claim("", version="2.0"), with_claim("", kind="thing"), with_claim(',"extra":1'), with_claim("", body=claim.replace(',"statement":"s"', "")), with_claim(',"tags":null'),
        with_claim(',"direct_quote":"yes"'), with_claim(',"status":"gone"'), with_claim("", body=claim.replace('"s"', '" "')), with_claim("", body=claim.replace("fact_claim", "prediction")), with_point(',"measurement_context":{"currency":"usd","scale_multiplier":0}'),
        with_claim(',"provenance":{"origin_type":"derived","derivation_links":[]}'), with_claim(',"updated_at":"1990-01-01T00:00:00Z"'),
    ]
    rows = table(spark, sf_dir, "orders").select(o.cast("string").alias("id"), F.element_at(F.array(*forms), way + 1).alias("payload"))
    found = payloads.payload_findings(rows)
    return found.groupBy("code", "path").agg(F.count("*").alias("n"), F.min(F.col("id").cast("long")).alias("first_id"))


_PAYLOADS_SQL = """
WITH k(way, code, path) AS (VALUES (3, 'INVALID_JSON', ''), (4, 'UNSUPPORTED_VERSION', ''), (5, 'UNSUPPORTED_TYPE', ''), (6, 'UNKNOWN_FIELD', 'extra'), (7, 'MISSING_FIELD', 'statement'), (8, 'NULL_FIELD', 'tags'),
  (9, 'WRONG_TYPE', 'direct_quote'), (10, 'NOT_A_MEMBER', 'status'), (11, 'TOO_SMALL', 'statement'), (12, 'PREDICTION_WITHOUT_HORIZON', ''), (13, 'BAD_CURRENCY', ''), (13, 'TOO_SMALL', 'measurement_context.scale_multiplier'),
  (14, 'DERIVED_WITHOUT_ORIGINS', ''), (15, 'UPDATED_BEFORE_CREATED', ''))
SELECT code, path, count(*) AS n, min(o_orderkey) AS first_id FROM orders JOIN k ON o_orderkey % 16 = way GROUP BY code, path"""


def documents_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document has a unit u1, a claim c1 and an evidence e1 for it; groups are by document, one for each source."""
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("document_id"), F.coalesce("source", F.lit("none")).alias("g"))
    kinds = docs.select("document_id", F.lit("u1").alias("source_unit_id"), F.lit("q").alias("source_quote"), F.explode(F.array(F.lit("claim"), F.lit("evidence"))).alias("candidate_type"))
    is_claim = F.col("candidate_type") == "claim"
    rows = kinds.select("*", F.when(is_claim, "c1").otherwise("e1").alias("candidate_id"), F.when(is_claim, "fact_claim").alias("claim_type"), F.when(is_claim, "s").alias("statement"), F.when(~is_claim, "support").alias("evidence_role"), F.when(~is_claim, "direct_quote").alias("evidence_type"), F.when(~is_claim, "c1").alias("target_object_id"))
    groups = docs.select("document_id", F.lit("u1").alias("source_unit_id"), F.col("g").alias("independence_group"))
    objects = drafts.map_candidates(complete(rows), groups, "ws")
    claims = objects.where("object_type = 'claim'").select(F.col("id").alias("target_object_id"))
    evidence = objects.where("object_type = 'evidence'").join(claims, "target_object_id", "left_semi")
    return evidence.groupBy("independence_group").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"), F.count_distinct("target_object_id").alias("n_targets"), F.max(F.array_join("source_refs", ",")).alias("units"))


def _stored(spark: SparkSession, sf_dir: str) -> tuple[store.ObjectStore, DataFrame]:
    """A fresh store with all orders as claims, and the rows: payloads of every tenth can't be upgraded."""
    o = F.col("o_orderkey")
    payload = F.when(o % 10 == 0, F.lit("broken")).otherwise(F.concat(F.lit('{"schema_version":"1.0","external_ids":{"k":"'), (o % 50).cast("string"), F.lit('"}}')))
    day = F.col("o_orderdate").cast("timestamp")
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("clm_"), o.cast("string")).alias("id"), F.lit("claim").alias("object_type"), F.lit("1.0").alias("schema_version"), F.lit("active").alias("lifecycle_status"), F.lit("w").alias("workspace_id"), F.lit("private").alias("privacy_level"),
        F.lit("u").alias("created_by"), day.alias("created_at"), day.alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"), F.lit(1).alias("version"), payload.alias("payload"), o.alias("o"),
    )
    fresh = store.ObjectStore(spark, f"{shared_folder(spark).rstrip('/')}/store-{uuid.uuid4().hex}")
    fresh.create(rows)
    return fresh, rows


def store_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders are stored, a third get new payloads, then a quarter are deleted and some of those restored."""
    kept, rows = _stored(spark, sf_dir)
    changes = lambda when, version: rows.where(when).select("id", F.lit(version).cast("int").alias("expected_version"))
    kept.update(changes("o % 3 = 0", 1).withColumn("payload", F.lit('{"external_ids":{"k":"new"}}')))
    kept.soft_delete(changes("o % 4 = 0", None))
    kept.restore_deleted(changes("o % 8 = 0", None))
    new = kept.by_external_id("claim", "w", "k", "new").select("id", F.lit(True).alias("new"))
    return kept.read().join(new.hint("merge"), "id", "left").groupBy("version", "lifecycle_status", F.coalesce("new", F.lit(False)).alias("new")).agg(F.count("*").alias("n"))


_UPDATES_SQL = """
SELECT CAST(1 + CAST(o_orderkey % 3 = 0 AS INTEGER) + CAST(o_orderkey % 4 = 0 AS INTEGER) + CAST(o_orderkey % 8 = 0 AS INTEGER) AS INTEGER) AS version, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0 THEN 'deleted' ELSE 'active' END AS lifecycle_status,
  o_orderkey % 3 = 0 AND NOT (o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0) AS new, count(*) AS n FROM orders GROUP BY ALL"""


def backup_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backup of all orders, a migration, and the backup restored, also to a store that lacks every third order:
    how many rows each step took and left, counted in full."""
    kept, rows = _stored(spark, sf_dir)
    folder = f"{kept.root}-backup"
    saved = kept.backup(folder)
    moved = kept.migrate(store.upgrade_payload, "1.0", "1.1")
    back = kept.restore(folder, saved["sha256"])
    other = store.ObjectStore(spark, f"{kept.root}-other")
    other.create(rows.where("o % 3 <> 0"))
    there = other.restore(folder, saved["sha256"])
    reports = [("backup", saved["count"], 0), ("migrate", moved["migrated_count"], moved["failed_count"]), ("restore", back["restored_count"], back["failed_count"]), ("restore elsewhere", there["restored_count"], there["failed_count"])]
    counted = spark.createDataFrame(reports, "step string, n long, failed long")
    again = kept.read().join(rows.select("id", F.col("payload").alias("before")).hint("merge"), "id").agg(F.lit("same payloads").alias("step"), F.count_if(F.col("payload") == F.col("before")).alias("n"), F.count_if(F.col("payload") != F.col("before")).alias("failed"))
    return counted.unionByName(again)


_BACKUP_SQL = """
SELECT 'backup' AS step, count(*) AS n, 0 :: BIGINT AS failed FROM orders UNION ALL SELECT 'migrate', count(*) FILTER (o_orderkey % 10 <> 0), count(*) FILTER (o_orderkey % 10 = 0) FROM orders
UNION ALL SELECT 'restore', count(*), 0 FROM orders UNION ALL SELECT 'restore elsewhere', count(*) FILTER (o_orderkey % 3 <> 0), count(*) FILTER (o_orderkey % 3 = 0) FROM orders UNION ALL SELECT 'same payloads', count(*), 0 FROM orders"""

QUERIES = {
    "l12_f19_golden_gate": golden_gate,
    "b4_e4_payloads": payloads_checked,
    "n10_documents_apart": documents_apart,
    "b1_n1_n2_store_updates": store_updates,
    "b2_n4_n5_backup_restore": backup_restore,
    "e1_i1_list_objects": list_objects,
    "e2_e3_external_ids": external_ids,
    "g1_counts": counts,
    "n3_j8_upgrade_records": upgrade,
    "n4_g11_migration_report": migration_report,
    "n8_f13_f14_plan_documents": plan_documents,
    "n7_f16_plan_sources": plan_sources,
    "n6_latest_runs": latest_runs,
    "f12_operation_status": operation_status,
    "n10_f9_l11_map_candidates": mapped,
    "g15_id_collisions": collisions,
    "g9_g14_j6_verdict_sets": accepted_or_rejected,
}

_KIND = "CASE o_orderkey % 3 WHEN 0 THEN 'data_point' WHEN 1 THEN 'claim' ELSE 'document' END"
_SPACE = "CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END"
ORACLES = {
    "l12_f19_golden_gate": _GOLDEN_SQL,
    "b4_e4_payloads": _PAYLOADS_SQL,
    "n10_documents_apart": "SELECT coalesce(source, 'none') AS independence_group, count(*) AS n, count(*) AS n_ids, count(*) AS n_targets, 'u1' AS units FROM documents GROUP BY ALL",
    "b1_n1_n2_store_updates": _UPDATES_SQL,
    "b2_n4_n5_backup_restore": _BACKUP_SQL,
    "e1_i1_list_objects": "SELECT 'obj_' || o_orderkey AS id, 'claim' AS object_type, 'a' AS workspace_id FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 AND o_orderkey % 11 <> 0 ORDER BY o_orderdate, id LIMIT 100 OFFSET 20",
    "e2_e3_external_ids": f"SELECT {_KIND} AS object_type, count(*) AS n, min('obj_' || o_orderkey) AS first_id FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 11 <> 0 AND (o_orderkey % 100 = 7 OR o_orderpriority = '1-URGENT') GROUP BY ALL",
    "g1_counts": f"SELECT {_KIND} AS object_type, {_SPACE} AS workspace_id, count(*) AS n_all, count(*) FILTER (o_orderkey % 11 <> 0) AS n_live FROM orders GROUP BY ALL",
    "n3_j8_upgrade_records": _UPGRADE_SQL,
    "n4_g11_migration_report": _MIGRATION_SQL,
    "n8_f13_f14_plan_documents": _PLAN_SQL,
    "n7_f16_plan_sources": _SOURCES_SQL,
    "n6_latest_runs": _RUNS_SQL,
    "f12_operation_status": _OPERATIONS_SQL,
    "n10_f9_l11_map_candidates": _MAPPED_SQL,
    "g15_id_collisions": """
WITH s AS (SELECT p_partkey AS id, 'part' AS x FROM part UNION ALL SELECT s_suppkey, 'supplier' FROM supplier UNION ALL SELECT c_custkey, 'customer' FROM customer)
SELECT id, count(*) AS n, string_agg(DISTINCT x, ',' ORDER BY x) AS sections FROM s GROUP BY id HAVING count(*) > 1""",
    "g9_g14_j6_verdict_sets": """
SELECT source, string_agg(DISTINCT CAST(quality AS VARCHAR), ',' ORDER BY CAST(quality AS VARCHAR)) AS actions, count(*) FILTER (quality = 1 AND toxic <> 1) AS accepted, count(*) FILTER (quality = 1 AND toxic = 1) AS overlap
FROM labels JOIN documents USING (doc_id) GROUP BY source""",
}
