import json

import pytest
from pyspark.sql import functions as F

from tessera.functions.schemas import CANDIDATE
from tessera.operators import ingestion, workflow
from tessera.operators.store import ObjectStore, StoreError, upgrade_payload


def record(spark, *ids, kind="claim", version="1.0", payload=None):
    rows = [(i, kind, version, "active", "w", "private", "u", i, payload or json.dumps({"schema_version": version, "n": i})) for i in ids]
    frame = spark.createDataFrame(rows, "id string, object_type string, schema_version string, lifecycle_status string, workspace_id string, privacy_level string, created_by string, x string, payload string")
    now = F.lit("2024-01-01").cast("timestamp")
    return frame.drop("x").withColumns({"created_at": now, "updated_at": now, "deleted_at": F.lit(None).cast("timestamp"), "version": F.lit(1)})


def change(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, expected_version int, payload string")


@pytest.fixture
def store(spark, tmp_path):
    return ObjectStore(spark, f"file://{tmp_path}/store")


def test_create_read_update_delete(spark, store):
    assert store.read().count() == 0 and store.create(record(spark, "clm_1", "clm_2")) == 1
    store.create(record(spark, "src_1", kind="source"))
    assert {r.id for r in store.read().collect()} == {"clm_1", "clm_2", "src_1"} and store.read("source").count() == 1
    with pytest.raises(StoreError, match="DUPLICATE_OBJECT"):
        store.create(record(spark, "clm_1", "clm_3"))
    assert store.get("clm_3") is None
    store.update(change(spark, ("clm_1", 1, "{}")))
    assert store.record_version("clm_1") == 2 and store.get("clm_1")["payload"] == "{}"
    with pytest.raises(StoreError, match="CONCURRENT_UPDATE"):
        store.update(change(spark, ("clm_1", 1, "x")))
    with pytest.raises(StoreError, match="OBJECT_NOT_FOUND"):
        store.update(change(spark, ("clm_9", None, "x")))
    store.soft_delete(change(spark, ("clm_2", 1, None)))
    assert store.count("claim") == 1 and store.count("claim", include_deleted=True) == 2
    store.restore_deleted(change(spark, ("clm_2", 2, None)))
    assert [r.id for r in store.list("claim").collect()] == ["clm_1", "clm_2"] and store.record_version("clm_2") == 3
    assert store.read(version=1).count() == 2  # old versions stay readable


def test_only_one_writer_gets_a_version(spark, store):
    store.create(record(spark, "clm_1"))
    base, folders = store.manifest()
    store._switch(base + 1, folders)
    with pytest.raises(StoreError, match="CONCURRENT_UPDATE"):
        store._switch(base + 1, folders)


def test_bounds_and_fields(spark, store):
    store.create(record(spark, "clm_1", payload='{"external_ids":{"k":"v"},"n":"7"}'))
    for bad in ({"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            store.list(**bad)
    with pytest.raises(ValueError):
        store.by_payload_field("claim", "w", "a.b", "x")
    assert store.by_external_id("claim", "w", "k", "v").count() == store.by_payload_field("claim", "w", "n", "7").count() == 1


def test_backup_migration_restore(spark, store, tmp_path):
    origins = '{"schema_version":"1.0","provenance":{"origin_object_ids":["doc_1","doc_1"]}}'
    store.create(record(spark, "clm_1", payload=origins))
    store.create(record(spark, "clm_2", payload="broken"))
    dry = store.migrate(upgrade_payload, "1.0", "1.1", dry_run=True)
    assert (dry["selected_count"], dry["would_migrate_count"], dry["failed_ids"]) == (2, 1, ["clm_2"]) and store.record_version("clm_1") == 1
    done = store.migrate(upgrade_payload, "1.0", "1.1", backup_folder=f"file://{tmp_path}/b")
    new = store.get("clm_1")
    assert new["schema_version"] == "1.1" and new["version"] == 2
    payload = json.loads(new["payload"])
    assert payload["claim_dimension"] == "general" and [x["object_id"] for x in payload["provenance"]["derivation_links"]] == ["doc_1"]
    with pytest.raises(StoreError, match="CHECKSUM"):
        store.restore(f"file://{tmp_path}/b", "0" * 64)
    assert store.restore(f"file://{tmp_path}/b", done["backup"]["sha256"])["restored_count"] == 2
    assert store.get("clm_1")["payload"] == origins and store.get("clm_1")["schema_version"] == "1.0"


def test_document_plans(spark):
    existing = spark.createDataFrame([("doc_1", "k1", "s1", 1), ("doc_2", "k2", "s1", 2)], "document_id string, dedupe_key string, series_key string, version_no int")
    incoming = spark.createDataFrame([(1, "k1", "s1"), (2, "k3", "s1"), (3, "k3", "s1"), (4, "k4", "s2")], "input_no int, dedupe_key string, series_key string")
    plans = {s: {r.input_no: r for r in ingestion.plan_documents(incoming, existing, s).collect()} for s in ingestion.STRATEGIES}
    reuse = plans["reuse"]
    assert [reuse[i].action for i in (1, 2, 3, 4)] == ["REUSED", "CREATED", "REUSED", "CREATED"]
    assert reuse[1].document_id == "doc_1" and reuse[2].version_no == 3 and reuse[2].parent_document_id == "doc_2" and reuse[3].document_id == reuse[2].document_id
    assert [plans["reject"][i].action for i in (1, 2, 3, 4)] == ["REJECTED", "CREATED", "REJECTED", "CREATED"]
    new = plans["new_version"]
    assert [new[i].version_no for i in (1, 2, 3, 4)] == [3, 4, 5, 1] and new[3].parent_document_id == new[2].document_id


@pytest.mark.parametrize(("status", "step"), [(None, "start"), ("success", "done"), ("running", "conflict"), ("failed", "retry")])
def test_next_step(status, step):
    assert ingestion.next_step(status) == step


def draft_inputs(spark, statement="s", more=()):
    units = spark.createDataFrame([("doc_1", "cu_1", "paragraph", 0, "revenue grew"), *(("doc_1", "cu_x", "paragraph", 1 + i, text) for i, text in enumerate(more[:1]))], "document_id string, unit_id string, unit_type string, sequence_no int, text string")
    fields = ["document_id", *CANDIDATE.names]
    rows = [
        {"candidate_id": "n1", "candidate_type": "entity", "entity_type": "company", "canonical_name": "Acme"},
        {"candidate_id": "c1", "candidate_type": "claim", "claim_type": "fact_claim", "claim_dimension": "risk", "statement": statement, "source_quote": "revenue grew"},
        {"candidate_id": "e1", "candidate_type": "evidence", "evidence_type": "direct_quote", "evidence_role": "support", "target_object_id": "c1", "source_quote": "revenue"},
        {"candidate_id": "f1", "candidate_type": "fact", "statement": "可能", "source_quote": "revenue"},
    ]
    schema = CANDIDATE.__class__([CANDIDATE.fields[0].__class__("document_id", CANDIDATE.fields[0].dataType), *CANDIDATE.fields])
    candidates = spark.createDataFrame([tuple({"document_id": "doc_1"}.get(f, r.get(f)) for f in fields) for r in rows], schema)
    groups = spark.createDataFrame([("cu_1", "g", None)], "source_unit_id string, independence_group string, problem string")
    bundle, findings = workflow.review_bundle(candidates, units)
    return bundle.cache(), findings.cache(), units, groups


def test_drafts_are_stored_once_and_traceable(spark, store):
    bundle, findings, units, groups = draft_inputs(spark)
    assert {r.candidate_id: r.accepted for r in bundle.collect()} == {"n1": True, "c1": True, "e1": True, "f1": False}
    run = lambda: workflow.persist_drafts(store, bundle, findings, units, groups, "w", workflow.signed_hash(bundle, findings, units))
    assert run()["created"] == 3
    assert run()["repeated"] and store.count() == 4  # three objects and the run
    evidence = json.loads(store.read("evidence").first().payload)
    claim = store.read("claim").first()
    assert evidence["target_object_id"] == claim.id and claim.id.startswith("clm_") and json.loads(claim.payload)["claim_dimension"] == "risk"
    assert evidence["source_refs"] == ["cu_1"] and evidence["independence_group"] == "g"
    other = draft_inputs(spark, more=("noted", "x"))
    again = workflow.persist_drafts(store, *other[:3], groups, "w", workflow.signed_hash(*other[:3]))
    with pytest.raises(StoreError, match="BUNDLE_HASH_MISMATCH"):
        workflow.persist_drafts(store, bundle, findings, units, groups, "w", "h" * 64)
    elsewhere = bundle.withColumn("workspace_id", F.lit("v"))
    with pytest.raises(StoreError, match="OTHER_WORKSPACE"):
        workflow.persist_drafts(store, elsewhere, findings, units, groups, "w", workflow.signed_hash(elsewhere, findings, units), dry_run=True)
    provided = bundle.withColumn("provider_name", F.lit("p"))
    with pytest.raises(StoreError, match="PROVIDER_NOT_ALLOWED"):
        workflow.persist_drafts(store, provided, findings, units, groups, "w", workflow.signed_hash(bundle, findings, units), dry_run=True, providers=("q",))
    assert (again["created"], again["reused"]) == (0, 3)


def test_a_failed_run_leaves_no_objects_and_can_be_tried_again(spark, store):
    bundle, findings, units, groups = draft_inputs(spark)
    broken = groups.withColumn("problem", F.lit("SOURCE_NOT_FOUND"))
    with pytest.raises(StoreError, match="SOURCE_GRAPH"):
        workflow.persist_drafts(store, bundle, findings, units, broken, "w", workflow.signed_hash(bundle, findings, units))
    assert [json.loads(r.payload)["run_status"] for r in store.read().collect()] == ["failed"]
    assert workflow.persist_drafts(store, bundle, findings, units, groups, "w", workflow.signed_hash(bundle, findings, units))["created"] == 3


def test_bundle_hash_follows_content_only(spark):
    one, two = draft_inputs(spark), draft_inputs(spark, "t")
    hashes = [workflow.bundle_hashes(b.repartition(3), f, u).first().bundle_sha256 for b, f, u, _ in (one, one, two)]
    assert hashes[0] == hashes[1] != hashes[2]


def test_opinion_matrix(spark):
    claims = spark.createDataFrame([("clm_1",), ("clm_2",)], "claim_id string")
    evidence = spark.createDataFrame([("e1", "clm_1", "support", "g"), ("e2", "clm_1", "support", "g"), ("e3", "clm_1", "refute", "h")], "evidence_id string, target_object_id string, evidence_role string, independence_group string")
    row = workflow.opinion_matrix(claims, evidence).orderBy("claim_id").first()
    assert row.support == ["e1", "e2"] and row.n_support_groups == 1 and row.refute == ["e3"]


def test_ingestion_writes_documents_once(spark, store):
    docs = spark.createDataFrame([("mem:a", "one\n\ntwo"), ("mem:b", "three"), ("mem:c", " "), ("mem:d", "three\n")], "input_uri string, text string")
    source = {"name": "Ann's Blog", "source_type": "blog"}
    run = lambda d, **more: workflow.ingest(store, d, "text", "w", source, **more)
    dry = run(docs, dry_run=True)
    assert (dry["created"], dry["reused"], dry["failed"]) == (2, 1, ["mem:c"]) and store.count() == 0
    first = run(docs)
    assert (first["created"], first["units"]) == (2, 3) and store.count("source") == 1 and store.count("document") == 2
    assert run(docs)["created"] == 0 and store.count() == 6
    changed = spark.createDataFrame([("mem:a", "one\n\ntwo\n\nmore")], "input_uri string, text string")
    assert run(changed)["created"] == 1
    versions = sorted((json.loads(r.payload)["input_uri"], json.loads(r.payload)["version_no"]) for r in store.read("document").collect())
    assert ("mem:a", 2) in versions and store.count("source") == 1
    units = [json.loads(r.payload) for r in store.read("content_unit").collect()]
    assert {u["document_id"] for u in units} == {r.id for r in store.read("document").collect()}


def test_an_update_takes_each_id_once(spark, store):
    store.create(record(spark, "clm_1", payload="{}"))
    twice = spark.createDataFrame([("clm_1", None, "{}"), ("clm_1", 1, "[]")], "id string, expected_version int, payload string")
    for change in (store.update, store.soft_delete, store.restore_deleted):
        with pytest.raises(StoreError, match="DUPLICATE_CHANGE"):
            change(twice)
    assert store.read().count() == 1 and store.record_version("clm_1") == 1


def test_references_mean_the_own_documents_candidate(spark):
    from tessera.operators import drafts

    rows = [(d, "c1", "claim", None, f"statement {d}") for d in ("d1", "d2")] + [(d, "e1", "evidence", "c1", None) for d in ("d1", "d2")]
    frame = spark.createDataFrame(rows, "document_id string, candidate_id string, candidate_type string, target_object_id string, statement string")
    keyed = drafts.with_object_ids(frame.withColumns({c: F.lit(None).cast("string") for c in ("entity_id",)}), F.lit("w"))
    ids = {r.document_id: r.object_id for r in keyed.where("candidate_type = 'claim'").collect()}
    found = {r.document_id: r.target_object_id for r in drafts.rewrite_references(keyed).where("candidate_type = 'evidence'").collect()}
    assert found == ids and len(set(ids.values())) == 2


def test_counts_cover_more_than_a_report_lists(spark, store, tmp_path):
    rows = spark.range(260).selectExpr("concat('clm_', id) AS id", "'claim' AS object_type", "CASE WHEN id < 130 THEN '{\"schema_version\":\"1.0\"}' ELSE 'broken' END AS payload")
    rows = record(spark, "clm_x").drop("id", "object_type", "payload").crossJoin(rows).select(*record(spark, "clm_x").columns)
    store.create(rows)
    report = store.migrate(upgrade_payload, "1.0", "1.1", dry_run=True)
    assert (report["would_migrate_count"], report["failed_count"], len(report["failed_ids"])) == (130, 130, 100)
    manifest = store.backup(f"file://{tmp_path}/all")
    other = type(store)(spark, f"file://{tmp_path}/other")
    other.create(rows.where("substring(id, 5) < '2'"))
    n = other.count()
    done = other.restore(f"file://{tmp_path}/all", manifest["sha256"])
    assert (done["restored_count"], done["failed_count"], len(done["failed_ids"])) == (n, 260 - n, 100) and 260 - n > 140
    blank = spark.range(250).selectExpr("concat('mem:', id) AS input_uri", "CASE WHEN id = 0 THEN 'text' ELSE ' ' END AS text")
    took = workflow.ingest(store, blank, "text", "w", {"name": "n", "source_type": "blog"}, dry_run=True)
    assert (took["created"], took["failed_count"], len(took["failed"])) == (1, 249, 100)


def test_documents_stay_apart_to_the_end(spark, store):
    """Two documents with a unit u1, the same candidates and quotes, and sources of their own; the second's data point is of a stored entity."""
    from tessera.operators import drafts

    units = spark.createDataFrame([(d, "u1", "paragraph", 0, "revenue grew") for d in ("doc_1", "doc_2")], "document_id string, unit_id string, unit_type string, sequence_no int, text string")
    store.create(record(spark, "ent_stored").withColumn("object_type", F.lit("entity")))
    base = {"source_quote": "revenue", "source_unit_id": "u1", "quote_match_mode": "literal"}
    rows = [{"document_id": d, **base, **r} for d in ("doc_1", "doc_2") for r in (
        {"candidate_id": "c1", "candidate_type": "claim", "claim_type": "fact_claim", "statement": "s"},
        {"candidate_id": "e1", "candidate_type": "evidence", "evidence_type": "direct_quote", "evidence_role": "support", "target_object_id": "c1"},
    )] + [{"document_id": "doc_2", **base, "candidate_id": "d1", "candidate_type": "data_point", "metric": "m", "value": 1.0, "unit": "USD", "entity_id": "ent_stored"}]
    schema = CANDIDATE.__class__([CANDIDATE.fields[0].__class__("document_id", CANDIDATE.fields[0].dataType), *CANDIDATE.fields])
    bundle, findings = workflow.review_bundle(spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema), units)
    groups = spark.createDataFrame([("doc_1", "u1", "g1", None), ("doc_2", "u1", "g2", None), ("doc_3", "u1", None, "SOURCE_NOT_FOUND")], "document_id string, source_unit_id string, independence_group string, problem string")
    report = workflow.persist_drafts(store, bundle, findings, units, groups, "w", workflow.signed_hash(bundle, findings, units))
    assert report["created"] == 5
    evidence = [json.loads(r.payload) for r in store.read("evidence").collect()]
    assert sorted(e["independence_group"] for e in evidence) == ["g1", "g2"] and len({e["target_object_id"] for e in evidence}) == 2
    assert {e["target_object_id"] for e in evidence} == {r.id for r in store.read("claim").collect()}
    assert {u for e in evidence for u in e["source_refs"]} == {"u1"} and json.loads(store.read("data_point").first().payload)["entity_id"] == "ent_stored"
    assert drafts.map_candidates(bundle, groups, "w").count() == 5


def test_signed_hash_is_a_tree_over_documents(spark):
    units = spark.range(40).selectExpr("concat('d', id) AS document_id", "concat('u', id) AS unit_id", "'paragraph' AS unit_type", "0 AS sequence_no", "'x' AS text")
    claims = units.selectExpr("document_id", "'c' AS candidate_id", "'claim' AS candidate_type", "'s' AS statement")
    none = spark.createDataFrame([], "document_id string, code string, severity string, candidate_id string, gate_name string, source_unit_id string, detail string")
    signed = {workflow.signed_hash(claims.repartition(k), none, units, fan=3) for k in (1, 5)}
    changed = claims.withColumn("statement", F.when(F.col("document_id") == "d7", "t").otherwise(F.col("statement")))
    assert len(signed) == 1 and workflow.signed_hash(changed, none, units, fan=3) not in signed


def test_a_commit_writes_its_buckets_only(spark, store):
    """Of 200 records in 16 buckets, a change of one replaces one folder, and a look-up reads one bucket of each type."""
    store.create(record(spark, *(f"clm_{i}" for i in range(200))))
    store.create(record(spark, "src_1", kind="source"))
    _, before = store.manifest()
    store.update(change(spark, ("clm_7", 1, "{}")))
    _, after = store.manifest()
    changed = {k for k in after if after[k] != before.get(k)}
    assert len(changed) == 1 and changed < {k for k in after if k.startswith("claim/")} and len([k for k in after if k.startswith("claim/")]) == 16
    files = {f.rsplit("/", 2)[1] for f in store._load([after[k] for k in changed]).inputFiles()}
    assert len(files) == 1 and store.get("clm_7")["version"] == 2 and store.get("clm_8")["version"] == 1
    read, load = [], store._load
    store._load = lambda paths: read.append(len(paths)) or load(paths)
    assert store.get("clm_9")["id"] == "clm_9" and read[0] <= 2
    assert ObjectStore(spark, store.root, buckets=5).count() == 201  # the number of the first commit counts


def test_a_manifest_of_whole_types_is_dealt_into_buckets(spark, store):
    path = f"{store.root}/data/old/claim"
    record(spark, *(f"clm_{i}" for i in range(40))).select(*store.read().columns).write.parquet(path)
    store._switch(1, {"claim": path})
    assert store.count() == 40 and store.get("clm_3")["id"] == "clm_3"
    store.update(change(spark, ("clm_3", 1, "{}")))
    _, folders = store.manifest()
    assert "claim" not in folders and store.count() == 40 and store.record_version("clm_3") == 2


def test_a_killed_migration_goes_on(spark, store, tmp_path):
    ids = [f"clm_{i}" for i in range(120)]
    store.create(record(spark, *ids, payload='{"schema_version":"1.0"}'))
    store.create(record(spark, "clm_bad", payload="broken"))
    commits, switch = [], store._switch

    def dying(version, folders):
        if len(commits) == 2:
            raise KeyboardInterrupt
        commits.append(version)
        return switch(version, folders)

    store._switch = dying
    folder = f"file://{tmp_path}/b"
    with pytest.raises(KeyboardInterrupt):
        store.migrate(upgrade_payload, "1.0", "1.1", backup_folder=folder, batch=4)
    store._switch = switch
    half = store.read().where("schema_version = '1.1'").count()
    assert 0 < half < 120
    with pytest.raises(StoreError, match="MIGRATION_RUNNING"):
        store.migrate(upgrade_payload, "1.1", "1.2")
    done = ObjectStore(spark, store.root).migrate(upgrade_payload, "1.0", "1.1", backup_folder=folder, batch=4)
    assert (done["selected_count"], done["migrated_count"], done["failed_count"], done["backup"]["count"]) == (121 - half, 120, 1, 121)
    assert {(r.version, r.schema_version) for r in store.read().where("id <> 'clm_bad'").collect()} == {(2, "1.1")} and "__migration" not in store.manifest()[1]
    assert store.restore(folder, done["backup"]["sha256"])["restored_count"] == 121


def test_a_migration_can_stop_at_the_first_failure(spark, store):
    store.create(record(spark, *(f"clm_{i}" for i in range(60)), payload='{"schema_version":"1.0"}'))
    store.create(record(spark, "clm_bad", payload="broken"))
    with pytest.raises(StoreError, match="MIGRATION_FAILED: clm_bad"):
        store.migrate(upgrade_payload, "1.0", "1.1", batch=1, fail_fast=True)
    assert store.read().where("id = 'clm_bad'").first().version == 1


def test_rows_of_a_store_are_not_broadcast(spark, tmp_path):
    """Their number isn't bounded, and the size of their files says little of it: no join may send them through the driver."""
    from tessera.plans import storing

    key = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(key)
    spark.conf.set(key, "1b")
    try:
        got = {(r.step, r.n) for r in storing.backup_restore(spark, "/root/testdata/sf0.001").collect()}
        storing.store_updates(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set(key, before)
    assert ("restore", 1500) in got and ("same payloads", 1500) in got
