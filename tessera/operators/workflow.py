"""Whole workflows: extraction to stored drafts (survey D21, B6, L13, N9, N11, N12), opinion matrix (an extension)."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import replace
from hashlib import sha256 as digest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.durable import checkpoint
from tessera.functions import text as t
from tessera.functions.schemas import CANDIDATE
from tessera.functions.text import sha256
from tessera.operators import drafts, gates, graph, ingestion, windows
from tessera.operators.joins import null_safe
from tessera.operators.store import SHOWN, ObjectStore, StoreError


def review_bundle(candidates: DataFrame, units: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(candidates with accepted and their codes, findings) in the reviewers' order."""
    resolved = gates.resolve_quotes(gates.complete(candidates), units)
    findings = gates.all_findings(resolved, units, strict)
    judged = gates.verdicts(resolved, findings).select(*gates.KEY, "codes", "accepted").dropDuplicates(list(gates.KEY))
    return null_safe(resolved, judged, gates.KEY, "inner"), findings


#: What a bundle's hash covers besides candidates, findings and windows, with what stands for a run that doesn't say. Fixed values.
RUN = {
    "run_id": "", "provider_name": "", "provider_version": "", "deterministic_mode": True, "schema_version": "1.0", "case_id": "", "prompt_version": "placeholder",
    "profile_version": "placeholder", "provider_response_hash": "", "errors": (),
}


def _candidate_json() -> Column:
    """A candidate's own fields, null ones among them, as canonical JSON; what the review adds doesn't count."""
    return t.canonical_value(F.struct(*(F.col(f) for f in sorted(CANDIDATE.names))))


def bundle_hashes(bundle: DataFrame, findings: DataFrame, units: DataFrame, run: Mapping = RUN) -> DataFrame:
    """(document_id, bundle_sha256): a hash over the canonical JSON of each document's bundle: what the run says of
    itself, candidates in the reviewers' order, findings, the window's hash, unit ids and errors in order.

    Bundle ids and times don't count. A document's bundle is one JSON text, so a document is the most that a task holds."""
    run = RUN | dict(run)
    place, primary = gates.order_key()
    own = gates.complete(bundle).select("document_id", F.struct(place.alias("place"), primary.alias("primary"), F.coalesce("candidate_id", F.lit("")).alias("id"), _candidate_json().alias("json")).alias("c"))
    listed = lambda name: F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(name, F.array().cast("array<string>")), lambda x: x), ","), F.lit("]"))
    found = t.canonical_object(**{f: t.json_string(F.col(f)) for f in gates.FINDING if f != "document_id"})
    by = own.groupBy("document_id").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c["json"]).alias("candidates"))
    by = null_safe(by, findings.select("document_id", found.alias("json")).groupBy("document_id").agg(F.array_sort(F.collect_list("json")).alias("findings")), ["document_id"])
    by = null_safe(by, windows.context_windows(units).select("document_id", "window_sha256"), ["document_id"])
    by = null_safe(by, units.select("document_id", t.json_string(F.col("unit_id")).alias("json")).groupBy("document_id").agg(F.array_sort(F.collect_list("json")).alias("units")), ["document_id"])
    text = lambda name: t.json_string(F.lit(str(run[name])))
    body = t.canonical_object(
        **{k: text(k) for k in run if k not in ("deterministic_mode", "errors")}, deterministic_mode=F.lit(json.dumps(bool(run["deterministic_mode"]))), errors=F.lit(json.dumps(sorted(run["errors"]), ensure_ascii=False, separators=(",", ":"))),
        document_id=t.json_string(F.col("document_id")), candidates=listed("candidates"), validation_findings=listed("findings"), content_unit_ids=listed("units"),
        context_hashes=t.canonical_object(window_sha256=t.json_string(F.col("window_sha256"))),
    )
    return by.select("document_id", sha256(body).alias("bundle_sha256"))


#: Lines that one hash of the tree over documents covers, about.
FAN = 1000


def signed_hash(bundle: DataFrame, findings: DataFrame, units: DataFrame, run: Mapping = RUN, fan: int = FAN) -> str:
    """What stands for a bundle of one document, its hash, or of several, the root of a tree of hashes: lines of document and
    hash, or of the level below, are dealt by their own hash to about n / `fan` nodes, in order within each."""
    hashes = checkpoint(bundle_hashes(bundle, findings, units, run))
    lines = hashes.select(F.concat_ws(":", F.coalesce("document_id", F.lit("")), "bundle_sha256").alias("line"))
    n = lines.count()
    if n == 1:
        return hashes.first().bundle_sha256
    while True:
        nodes = -(-n // fan)
        lines = checkpoint(lines.groupBy(F.pmod(F.xxhash64("line"), F.lit(nodes)).alias("node")).agg(sha256(F.array_join(F.array_sort(F.collect_list("line")), "\n")).alias("line")).select("line"))
        n = lines.count()
        if nodes <= 1:
            return lines.first().line if n else digest(b"").hexdigest()


def independence_groups(units: DataFrame, documents: DataFrame, sources: DataFrame, workspace: str) -> DataFrame:
    """(document_id, source_unit_id, independence_group, problem): one resolution for each unit, by its root source."""
    chain = graph.unit_sources(units, documents)
    roots = graph.root_sources(sources).select(F.col("id").alias("source_id"), "root", F.col("problem").alias("root_problem"))
    joined = chain.join(roots, "source_id", "left")
    problem = F.coalesce("problem", "root_problem", F.when(F.col("root").isNull(), "SOURCE_NOT_FOUND"))
    return joined.select("document_id", F.col("unit_id").alias("source_unit_id"), drafts.independence_group(F.col("root"), F.lit(workspace)).alias("independence_group"), problem.alias("problem"))


def persist_drafts(store: ObjectStore, bundle: DataFrame, findings: DataFrame, units: DataFrame, groups: DataFrame, workspace: str, bundle_hash: str, dry_run: bool = False, providers: tuple[str, ...] = (), policy: gates.Policy | None = None, run: Mapping = RUN) -> dict:
    """Accepted candidates as draft objects, all or none.

    The bundle's own workspace_id and provider_name, where it has them, are checked against `workspace` and `providers`, or the
    whole `policy`. References may go to the bundle's own candidates or to live objects of the workspace in the store.
    `bundle_hash` is what the reviewers signed, as `signed_hash` gives it for the `run`; a bundle that changed since is refused.

    The bundle's operation key makes it idempotent: a success is returned as it was, a running one conflicts, a failed
    one is tried again. Its run is recorded before and after in commits of their own, so that a failure leaves a
    failed run and nothing else. Objects whose natural key is there already are reused."""
    spark = store.spark
    key = spark.range(1).select(drafts.operation_key(F.lit(workspace), F.lit(bundle_hash)).alias("k")).first().k
    run_id = f"run_{key[:40]}"
    last = None if dry_run else store.get(run_id)
    state = None if last is None else json.loads(last["payload"])
    step = ingestion.next_step(state and state["run_status"])
    if step == "done":
        return state["report"] | {"repeated": True}
    if step == "conflict":
        raise StoreError("OPERATION_RUNNING", run_id)
    if not dry_run:
        _record_run(store, run_id, workspace, "running", None, last is None)
    try:
        if bundle_hash != signed_hash(bundle, findings, units, run):
            raise StoreError("BUNDLE_HASH_MISMATCH", bundle_hash)
        lacks = {c: v for c, v in (("workspace_id", F.lit(workspace)), ("provider_name", F.lit(""))) if c not in bundle.columns}
        checked = bundle.withColumns(lacks)
        foreign = checked.where(~F.col("workspace_id").eqNullSafe(workspace)).first()
        if foreign:
            raise StoreError("OTHER_WORKSPACE", f"{foreign.document_id}: {foreign.candidate_id}")
        policy = policy or gates.Policy(providers)
        stored = store.read().where((F.col("workspace_id") == workspace) & F.col("deleted_at").isNull()).select("id")
        known = stored if policy.known is None else stored.unionByName(policy.known.select("id"))
        problems = gates.preflight(checked, findings, units, policy=replace(policy, known=known))
        first = problems.orderBy("step", "check").first()
        if first:
            raise StoreError("PREFLIGHT_FAILED", f"{first.check}: {first.candidate_id}")
        accepted = bundle.where("accepted")
        both = ["document_id", "source_unit_id"] if "document_id" in groups.columns else ["source_unit_id"]
        used = accepted.where("candidate_type = 'evidence'").select(*both).distinct()
        broken = null_safe(groups, used, both, "left_semi").where("problem IS NOT NULL").first()
        if broken:
            raise StoreError("SOURCE_GRAPH", f"{broken.problem}: {broken.source_unit_id}")
        objects = drafts.map_candidates(accepted, groups, workspace)
        lacking = drafts.strictness_findings(objects).first()
        if lacking:
            raise StoreError("INCOMPLETE_OBJECT", f"{lacking.id} lacks {lacking.missing}")
        existing = store.read().select("id", "object_type", "workspace_id", "deleted_at", F.get_json_object("payload", "$.natural_key").alias("natural_key"))
        planned = drafts.reuse_or_create(objects, existing)
        counts = {r.action: r["count"] for r in planned.groupBy("action").count().collect()}
        report = {"created": counts.get("CREATED", 0), "reused": counts.get("REUSED", 0), "run_id": run_id, "dry_run": dry_run}
        if dry_run:
            return report
        new = planned.where("action = 'CREATED'")
        if report["created"]:
            store.create(_records(new.drop("existing_id", "action"), workspace))
        _record_run(store, run_id, workspace, "success", report, False)
        return report | {"repeated": False}
    except Exception as error:
        if not dry_run:
            try:
                _record_run(store, run_id, workspace, "failed", {"error": str(error)[:500]}, False)
            except StoreError:
                pass  # the first error is the one to report
        raise


def _records(objects: DataFrame, workspace: str) -> DataFrame:
    fields = [c for c in objects.columns if c not in ("id", "object_type", "workspace_id")]
    now = F.current_timestamp()
    return objects.select("id", "object_type", F.lit("1.1").alias("schema_version"), F.lit("active").alias("lifecycle_status"), F.lit(workspace).alias("workspace_id"), F.lit("private").alias("privacy_level"), F.lit("engine").alias("created_by"), now.alias("created_at"), now.alias("updated_at"), F.lit(None).cast("timestamp").alias("deleted_at"), F.lit(1).alias("version"), F.to_json(F.struct(*fields)).alias("payload"))


def _record_run(store: ObjectStore, run_id: str, workspace: str, status: str, report: dict | None, new: bool) -> None:
    payload = json.dumps({"run_status": status, "report": report})
    spark = store.spark
    if new:
        row = spark.range(1).select(F.lit(run_id).alias("id"), F.lit("processing_run").alias("object_type"), F.lit(payload).alias("natural_key"))
        store.create(_records(row, workspace).withColumn("payload", F.lit(payload)))
    else:
        store.update(spark.createDataFrame([(run_id, None, payload)], "id string, expected_version int, payload string"))


def ingest(store: ObjectStore, docs: DataFrame, input_type: str, workspace: str, source: dict[str, str], strategy: str = "reuse", dry_run: bool = False) -> dict:
    """Documents (input_uri, text) of one source to a source, document and unit records, in one commit.

    `source` has name, source_type and, if known, key and homepage_url. What can't be parsed is left out and counted, the
    first `SHOWN` of it by name; a dry run writes nothing."""
    from tessera.sources.readers import PARSERS

    lit = lambda name: F.lit(source.get(name)).cast("string")
    key = t.canonical_source_key(lit("name"), lit("source_type"), lit("key"), lit("homepage_url"))
    own = docs.withColumn("source_id", t.source_id(F.lit(workspace), lit("source_type"), key)).withColumn("canonical_key", key)
    parser = PARSERS[input_type]
    units = parser(own.select(F.col("input_uri").alias("document_id"), "text"))
    parsed = units.select(F.col("document_id").alias("input_uri")).distinct()
    unparsed = own.join(parsed, "input_uri", "left_anti").select("input_uri")
    failed = [r.input_uri for r in unparsed.orderBy("input_uri").limit(SHOWN).collect()]
    no_key = F.lit(None).cast("string")
    keyed = own.join(parsed, "input_uri", "left_semi").select(
        F.col("input_uri").alias("input_no"), "source_id", "canonical_key",
        t.dedupe_key(F.col("source_id"), t.content_hash(F.col("text")), F.lit(input_type), F.lit("1.0.0"), no_key).alias("dedupe_key"), t.series_key(F.col("source_id"), F.col("input_uri"), no_key).alias("series_key"),
    )
    field = lambda name: F.get_json_object("payload", f"$.{name}").alias(name)
    there = store.read("document").where("deleted_at IS NULL").select(F.col("id").alias("document_id"), field("dedupe_key"), field("series_key"), F.get_json_object("payload", "$.version_no").cast("int").alias("version_no"))
    plan = checkpoint(ingestion.plan_documents(keyed, there, strategy).join(keyed.select("input_no", "source_id", "canonical_key"), "input_no"))
    counts = {r.action.lower(): r["count"] for r in plan.groupBy("action").count().collect()}
    report = {"created": 0, "new_version": 0, "reused": 0, "rejected": 0} | counts | {"failed": failed, "failed_count": unparsed.count(), "dry_run": dry_run, "units": 0}
    new = plan.where(F.col("action").isin("CREATED", "NEW_VERSION"))
    if dry_run or new.isEmpty():
        return report
    ids = new.select(F.col("input_no").alias("__uri"), F.col("document_id").alias("__id"))
    own_units = ingestion.with_unit_ids(units.join(ids, units["document_id"] == ids["__uri"]).withColumn("document_id", F.col("__id")).drop("__uri", "__id"))
    unit_rows = _records(own_units.withColumnRenamed("unit_id", "id").withColumn("object_type", F.lit("content_unit")), workspace)
    document_rows = _records(new.select(F.col("document_id").alias("id"), F.lit("document").alias("object_type"), "source_id", F.col("input_no").alias("input_uri"), "dedupe_key", "series_key", "version_no", "parent_document_id"), workspace)
    sources = new.select(F.col("source_id").alias("id"), F.lit("source").alias("object_type"), "canonical_key", lit("name").alias("name"), lit("source_type").alias("source_type")).dropDuplicates(["id"])
    source_rows = _records(sources.join(store.read("source").select("id"), "id", "left_anti"), workspace)
    rows = checkpoint(unit_rows.unionByName(document_rows).unionByName(source_rows))
    store.create(rows)
    return report | {"units": rows.where("object_type = 'content_unit'").count()}


def same_rows(first: DataFrame, second: DataFrame) -> bool:
    """Whether two runs gave the same rows."""
    return first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def opinion_matrix(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """An extension (survey 2.Q): for each claim (claim_id) its evidence by role, and independent groups for and against."""
    roles = ("support", "refute", "qualify", "context", "counterexample")
    ids = [F.array_sort(F.collect_list(F.when(F.col("evidence_role") == r, F.col("evidence_id")))).alias(r) for r in roles]
    independent = [F.count_distinct(F.when(F.col("evidence_role") == r, F.col("independence_group"))).alias(f"n_{r}_groups") for r in roles[:2]]
    by = evidence.groupBy(F.col("target_object_id").alias("claim_id")).agg(*ids, *independent)
    return claims.join(by, "claim_id", "left")
