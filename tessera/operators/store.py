"""A versioned object store on plain Parquet (survey A9-A12, B1-B3, D27, E1-E3, G1, G11, I1, N1-N6).

A store is a folder. Data files are written once under data/; a manifest, which maps each object type and bucket of ids to
its current data, is one small text file with the next number, created only if no such file is there. A commit therefore
replaces whole buckets, those that its ids fall into and no others, is seen at once or not at all, and fails if another
writer was first. A look-up of an id reads one bucket of each type. The number of buckets is fixed with the first commit.
Readers resolve the newest manifest; one that maps whole types is read too, and its types are dealt into buckets when a
commit touches them. Paths go through the cluster's own file systems, so any store that Spark can write will do; exclusive
creation is as atomic as the file system makes it."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.schemas import OBJECT_RECORD
from tessera.functions.text import redact_url_password

MOST_ROWS, MOST_RAW_ROWS = 1000, 10_000
#: Ids that a report lists at most; its counts cover all.
SHOWN = 100
#: Buckets of each object type in a new store.
BUCKETS = 16
#: Entries of a manifest that aren't data: the number of buckets, and a migration that is under way.
_BUCKETS, _MIGRATION = "__buckets", "__migration"


class StoreError(RuntimeError):
    """Carries a stable code."""

    def __init__(self, code: str, message: str):
        super().__init__(f"{code}: {message}")
        self.code = code


class ObjectStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # Files

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _versions(self) -> list[int]:
        fs, folder = self._fs(f"{self.root}/manifest")
        if not fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())

    def manifest(self, version: int | None = None) -> tuple[int, dict[str, str]]:
        """The version (0: empty) and the data folder of each type and bucket, as type/bucket."""
        versions = self._versions()
        version = version if version is not None else (versions[-1] if versions else 0)
        if not version:
            return 0, {}
        fs, path = self._fs(f"{self.root}/manifest/{version:012d}")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return version, json.loads(text)

    def _switch(self, version: int, folders: dict[str, str]) -> int:
        fs, path = self._fs(f"{self.root}/manifest/{version:012d}")
        try:
            stream = fs.create(path, False)
        except Exception as taken:
            raise StoreError("CONCURRENT_UPDATE", f"version {version} was committed by another writer") from taken
        try:
            stream.write(bytearray(json.dumps(folders, sort_keys=True).encode()))
        finally:
            stream.close()
        return version

    # Reading

    def _count(self, folders: dict[str, str]) -> int:
        return int(folders.get(_BUCKETS, self.buckets))

    @staticmethod
    def _paths(folders: dict[str, str], types: Iterable[str] = (), buckets: Iterable[int] | None = None) -> list[str]:
        """The folders of some types and buckets; a folder of a whole type counts for each of its buckets."""
        types, buckets = set(types), None if buckets is None else set(buckets)
        parts = [(key.partition("/"), path) for key, path in sorted(folders.items()) if not key.startswith("__")]
        return [path for (kind, _, bucket), path in parts if (not types or kind in types) and (buckets is None or not bucket or int(bucket) in buckets)]

    def _load(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(OBJECT_RECORD).parquet(*paths) if paths else self.spark.createDataFrame([], OBJECT_RECORD)

    def read(self, *types: str, version: int | None = None) -> DataFrame:
        """All records, or those of some types only: other types' files aren't touched."""
        _, folders = self.manifest(version)
        return self._load(self._paths(folders, types))

    def _touched_by(self, folders: dict[str, str], ids: DataFrame) -> list[int]:
        """The buckets that ids (id) fall into."""
        return sorted(r.b for r in ids.select(bucket_of(F.col("id"), self._count(folders)).alias("b")).distinct().collect())

    def list(self, object_type: str | None = None, workspace_id: str | None = None, status: str | None = None, include_deleted: bool = False, limit: int = 100, offset: int = 0) -> DataFrame:
        """Filtered, ordered by creation and id, with bounds of 1 to 1000 and 0."""
        if not 1 <= limit <= MOST_ROWS or offset < 0:
            raise ValueError(f"limit must be from 1 to {MOST_ROWS} and offset 0 or more")
        rows = repository_filter(self.read(*[object_type] * bool(object_type)), object_type, workspace_id, status, include_deleted)
        return rows.orderBy("created_at", "id").offset(offset).limit(limit)

    def list_by_schema_version(self, schema_version: str, limit: int = 1000, offset: int = 0) -> DataFrame:
        """A10: raw records of one schema version."""
        if not 1 <= limit <= MOST_RAW_ROWS or offset < 0:
            raise ValueError(f"limit must be from 1 to {MOST_RAW_ROWS} and offset 0 or more")
        return self.read().where(F.col("schema_version") == schema_version).orderBy("created_at", "id").offset(offset).limit(limit)

    def get(self, object_id: str) -> dict | None:
        """One bucket of each type is read."""
        _, folders = self.manifest()
        paths = self._paths(folders, buckets=[zlib.crc32(object_id.encode()) % self._count(folders)])
        row = self._load(paths).where(F.col("id") == object_id).first()
        return row.asDict() if row else None

    def get_required(self, object_id: str) -> dict:
        found = self.get(object_id)
        if found is None:
            raise StoreError("OBJECT_NOT_FOUND", object_id)
        return found

    def record_version(self, object_id: str) -> int:
        return self.get_required(object_id)["version"]

    def count(self, object_type: str | None = None, workspace_id: str | None = None, include_deleted: bool = False) -> int:
        """G1."""
        return repository_filter(self.read(*[object_type] * bool(object_type)), object_type, workspace_id, None, include_deleted).count()

    def by_external_id(self, object_type: str, workspace_id: str, key: str, value: str) -> DataFrame:
        """E2."""
        rows = repository_filter(self.read(object_type), object_type, workspace_id, None, False)
        return rows.where(F.get_json_object("payload", f"$.external_ids['{key}']") == value).orderBy("created_at", "id")

    def by_payload_field(self, object_type: str, workspace_id: str, field: str, value: str) -> DataFrame:
        """A top-level field; dotted names are an error."""
        if "." in field:
            raise ValueError("only top-level fields can be searched")
        rows = repository_filter(self.read(object_type), object_type, workspace_id, None, False)
        return rows.where(F.get_json_object("payload", f"$.{field}") == value).orderBy("created_at", "id")

    # Writing

    def _replace(self, base: int, folders: dict[str, str], rows: DataFrame, notes: dict[str, str] | None = None) -> int:
        """Commits rows that add to, or replace by id, what is there: their buckets are written anew, once a type."""
        n = self._count(folders)
        bucket = bucket_of(F.col("id"), n)
        own: dict[str, set[int]] = {}
        for r in rows.select("object_type", bucket.alias("b")).distinct().collect():
            own.setdefault(r.object_type, set()).add(r.b)
        if not own:
            return base
        folders = folders | {_BUCKETS: str(n)} | (notes or {})
        for kind, buckets in sorted(own.items()):
            if kind in folders:  # of a manifest that maps whole types
                buckets = set(range(n))
            new = rows.where(F.col("object_type") == kind).select(*OBJECT_RECORD.names)
            old = self._load(self._paths(folders, [kind], buckets)).join(_merged(new.select("id")), "id", "left_anti").select(*OBJECT_RECORD.names)
            path = f"{self.root}/data/{uuid.uuid4().hex}/{kind}"
            old.unionByName(new).withColumn("bucket", bucket).repartition(n, "bucket").write.partitionBy("bucket").parquet(path)
            folders.pop(kind, None)
            fs, folder = self._fs(path)
            written = {s.getPath().getName() for s in fs.listStatus(folder)}
            folders |= {f"{kind}/{b}": f"{path}/bucket={b}" for b in buckets if f"bucket={b}" in written}
        return self._switch(base + 1, folders)

    def create(self, rows: DataFrame) -> int:
        """B1: inserts; ids that are there, or come twice, are an error and nothing is written."""
        base, folders = self.manifest()
        twice = rows.groupBy("id").count().where("count > 1").select("id")
        there = rows.select("id").join(_merged(self._load(self._paths(folders, buckets=self._touched_by(folders, rows))).select("id")), "id", "left_semi")
        bad = [r.id for r in twice.unionByName(there).limit(5).collect()]
        if bad:
            raise StoreError("DUPLICATE_OBJECT", ", ".join(bad))
        return self._replace(base, folders, rows)

    def _checked(self, changes: DataFrame) -> tuple[int, dict[str, str], DataFrame]:
        """Current rows with their expected_version; any that is missing, has moved on or comes twice stops the whole update."""
        twice = [r.id for r in changes.groupBy("id").count().where("count > 1").select("id").limit(5).collect()]
        if twice:
            raise StoreError("DUPLICATE_CHANGE", ", ".join(map(str, twice)))
        base, folders = self.manifest()
        now = self._load(self._paths(folders, buckets=self._touched_by(folders, changes)))
        joined = changes.select("id", "expected_version").join(_merged(now), "id", "left")
        wrong = joined.where(F.col("version").isNull() | (F.col("expected_version").isNotNull() & (F.col("expected_version") != F.col("version")))).limit(5).collect()
        if wrong:
            code = "OBJECT_NOT_FOUND" if wrong[0]["version"] is None else "CONCURRENT_UPDATE"
            raise StoreError(code, ", ".join(r.id for r in wrong))
        return base, folders, joined

    def update(self, changes: DataFrame) -> int:
        """New payloads (id, expected_version, payload) by compare and swap; versions and times move on."""
        base, folders, now = self._checked(changes)
        joined = now.drop("payload", "expected_version").join(_merged(changes.select("id", "payload")), "id")
        return self._replace(base, folders, _touched(joined))

    def soft_delete(self, changes: DataFrame) -> int:
        """(id, expected_version) marked as deleted."""
        base, folders, now = self._checked(changes)
        gone = now.withColumn("deleted_at", F.current_timestamp()).withColumn("lifecycle_status", F.lit("deleted"))
        return self._replace(base, folders, _touched(gone))

    def restore_deleted(self, changes: DataFrame) -> int:
        base, folders, now = self._checked(changes)
        back = now.withColumn("deleted_at", F.lit(None).cast("timestamp")).withColumn("lifecycle_status", F.lit("active"))
        return self._replace(base, folders, _touched(back))

    # Backup, migration, restore

    def backup(self, folder: str, schema_version: str | None = None, database_url: str = "") -> dict:
        """B2: JSON lines in the order of ids, over as many files as there are shuffle partitions; the manifest has their
        digest: of the SHA-256 of all lines the number, sum and exclusive or, hashed. The files' names and cuts don't count."""
        rows = self.read() if schema_version is None else self.read().where(F.col("schema_version") == schema_version)
        line = F.to_json(F.struct("id", F.col("payload"), F.col("version").alias("record_version"), "schema_version"), {"ignoreNullFields": "false"})
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartitionByRange(partitions, "id").sortWithinPartitions("id").select(line.alias("value")).write.text(f"{folder}/objects")
        url = self.spark.range(1).select(redact_url_password(F.lit(database_url)).alias("u")).first().u
        manifest = {"count": rows.count(), "sha256": self._digest(f"{folder}/objects"), "database_url": url, "schema_version": schema_version}
        self.report(manifest, f"{folder}/manifest")
        return manifest

    def _digest(self, folder: str) -> str:
        fs, path = self._fs(folder)
        if not fs.exists(path):
            raise StoreError("BACKUP_NOT_FOUND", folder)
        own = F.sha2(F.col("value").cast("binary"), 256)
        part = lambda at: F.conv(F.substring(own, at, 15), 16, 10).cast("long")
        sums = [F.sum(part(at).cast("decimal(38,0)")).cast("string") for at in (1, 16, 31, 46)]
        row = self.spark.read.text(folder).agg(F.count("*").cast("string"), *sums, *(F.bit_xor(part(at)).cast("string") for at in (1, 16, 31, 46))).first()
        return hashlib.sha256(":".join(map(str, row)).encode()).hexdigest()

    def report(self, content: dict, folder: str) -> None:
        """A report as one JSON line."""
        self.spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(folder)

    def migrate(
        self, upgrade, from_version: str, to_version: str, dry_run: bool = False, backup_folder: str | None = None,
        batch: int | None = None, fail_fast: bool = False, object_type: str | None = None, workspace_id: str | None = None,
    ) -> dict:
        """Upgrades payloads (a Column function) of one schema version; rows whose upgrade is null fail and stay.

        The backup comes first; a dry run writes nothing. `batch` buckets are committed at a time, all at once if null, and each
        commit notes in the manifest which buckets are done and the counts so far: a run that was killed goes on where it was
        when called again, with its first backup. With `fail_fast` the first batch with a failure stops the run; those before it stay."""
        base, folders = self.manifest()
        run = f"{from_version}>{to_version}:{object_type or ''}:{workspace_id or ''}"
        state = json.loads(folders.get(_MIGRATION, "{}"))
        if state and state["run"] != run:
            raise StoreError("MIGRATION_RUNNING", state["run"])
        state = state or {"run": run, "done": [], "migrated": 0, "failed": 0, "backup": None}

        def upgraded(buckets: Iterable[int] | None) -> DataFrame:
            rows = self._load(self._paths(folders, [object_type] * bool(object_type), buckets)).where(F.col("schema_version") == from_version)
            rows = rows if buckets is None else rows.where(bucket_of(F.col("id"), self._count(folders)).isin(*buckets))
            return repository_filter(rows, None, workspace_id, None, True).withColumn("__new", upgrade(F.col("payload"), F.col("object_type")))

        failing = upgraded(None).where("__new IS NULL")
        total = upgraded(None).agg(F.count("*").alias("n"), F.count("__new").alias("ok")).first()
        report = {"selected_count": total.n, "would_migrate_count": total.ok, "failed_count": total.n - total.ok, "failed_ids": [r.id for r in failing.select("id").orderBy("id").limit(SHOWN).collect()], "dry_run": dry_run, "migrated_count": 0}
        if dry_run or not (total.ok or state["done"]):
            return report
        if backup_folder and not state["backup"]:
            state["backup"] = self.backup(backup_folder, from_version)
        left = [b for b in range(self._count(folders)) if b not in state["done"]]
        size = batch or len(left) or 1
        for k in range(0, len(left), size):
            buckets = left[k : k + size]
            rows = upgraded(buckets)
            counts = rows.agg(F.count("*").alias("n"), F.count("__new").alias("ok")).first()
            if fail_fast and counts.ok < counts.n:
                raise StoreError("MIGRATION_FAILED", ", ".join(r.id for r in rows.where("__new IS NULL").select("id").orderBy("id").limit(5).collect()))
            state["done"], state["migrated"] = state["done"] + buckets, state["migrated"] + counts.ok
            last = k + size >= len(left)
            if counts.ok:
                moved = rows.where("__new IS NOT NULL").withColumn("payload", F.col("__new")).withColumn("schema_version", F.lit(to_version)).drop("__new")
                folders = {key: v for key, v in folders.items() if key != _MIGRATION}
                base = self._replace(base, folders, _touched(moved), {} if last else {_MIGRATION: json.dumps(state)})
            elif last and _MIGRATION in folders:
                base = self._switch(base + 1, {key: v for key, v in folders.items() if key != _MIGRATION})
            _, folders = self.manifest(base)
        report["migrated_count"] = state["migrated"]
        return report | ({"backup": state["backup"]} if state["backup"] else {})

    def restore(self, folder: str, sha256: str, current_backup: str | None = None) -> dict:
        """Payloads from a backup, verified before any line is read; lines without a record are errors."""
        if self._digest(f"{folder}/objects") != sha256:
            raise StoreError("BACKUP_CHECKSUM_MISMATCH", folder)
        if current_backup:
            self.backup(current_backup)
        base, folders = self.manifest()
        parsed = F.from_json("value", "id string, payload string, record_version int, schema_version string", {"mode": "FAILFAST"})
        lines = self.spark.read.text(f"{folder}/objects").select(parsed.alias("x")).select("x.*")
        now = self._load(self._paths(folders))
        joined = lines.select("id", F.col("payload").alias("__p"), F.col("schema_version").alias("__s")).join(_merged(now), "id", "left")
        missing = joined.where("version IS NULL").select("id")
        failed = [r.id for r in missing.orderBy("id").limit(SHOWN).collect()]
        n_failed = missing.count()
        back = joined.where("version IS NOT NULL").withColumn("payload", F.col("__p")).withColumn("schema_version", F.col("__s")).drop("__p", "__s")
        n = back.count()
        self._replace(base, folders, _touched(back))
        return {"restored_count": n, "failed_count": n_failed, "failed_ids": failed}


def _merged(rows: DataFrame) -> DataFrame:
    """Rows whose joins are sorted and merged: Parquet's size on disk says little of theirs, and broadcast they'd pass the driver whole."""
    return rows.hint("merge")


def bucket_of(object_id: Column, n: int) -> Column:
    return F.coalesce(F.crc32(object_id) % n, F.lit(0)).cast("int")


def _touched(rows: DataFrame) -> DataFrame:
    return rows.withColumn("version", (F.col("version") + 1).cast("int")).withColumn("updated_at", F.current_timestamp())


def repository_filter(rows: DataFrame, object_type: str | None = None, workspace_id: str | None = None, status: str | None = None, include_deleted: bool = False) -> DataFrame:
    """Null means any; deleted rows only on request. Plain column filters, which reach the files' statistics."""
    for column, value in (("object_type", object_type), ("workspace_id", workspace_id), ("lifecycle_status", status)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows if include_deleted else rows.where("deleted_at IS NULL")


_LINKS = "array<struct<object_id:string,relation_type:string,note:string>>"


def legacy_links(origins: Column) -> Column:
    """Origins of version 1.0 as derivation links, the first of each, blanks dropped."""
    return F.transform(
        F.array_distinct(F.filter(F.coalesce(origins, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")),
        lambda x: F.struct(x.alias("object_id"), F.lit("derived_from").alias("relation_type"), F.lit("legacy V1.0 compatibility mapping").alias("note")),
    )


def upgrade_records(rows: DataFrame) -> DataFrame:
    """Typed records of version 1.0 as 1.1; pure, without guessing. Columns: object_type, schema_version,
    measurement_context, claim_dimension, origin_object_ids, derivation_links; what a record has stays."""
    old = F.col("schema_version") == "1.0"
    kind = F.col("object_type")
    context = F.struct(F.lit("unknown").alias("measurement_kind"), F.lit(None).cast("string").alias("currency"), F.lit(1).cast("bigint").alias("scale_multiplier"), F.lit(None).cast("string").alias("reporting_standard"), F.lit(None).cast("string").alias("attribution_scope"), F.lit(None).cast("string").alias("consolidation_scope"))
    return rows.withColumns(
        {
            "measurement_context": F.when(old & (kind == "data_point"), F.coalesce("measurement_context", context)).otherwise(F.col("measurement_context")),
            "claim_dimension": F.when(old & (kind == "claim"), F.coalesce("claim_dimension", F.lit("general"))).otherwise(F.col("claim_dimension")),
            "derivation_links": F.when(old & F.col("derivation_links").isNull(), legacy_links(F.col("origin_object_ids"))).otherwise(F.col("derivation_links").cast(_LINKS)),
            "schema_version": F.when(old, "1.1").otherwise(F.col("schema_version")),
        }
    )


def upgrade_payload(payload: Column, object_type: Column) -> Column:
    """N3 on JSON payloads, for `migrate`: null for a payload that isn't an object of version 1.0.

    Members are added at the end of the object; what it has is left byte for byte as it is."""
    valid = F.get_json_object(payload, "$.schema_version") == "1.0"
    bumped = F.regexp_replace(payload, r'"schema_version"\s*:\s*"1\.0"', '"schema_version":"1.1"')
    lacks = lambda name: F.get_json_object(payload, f"$.{name}").isNull()
    add = F.concat(
        F.when((object_type == "claim") & lacks("claim_dimension"), ',"claim_dimension":"general"').otherwise(""),
        F.when((object_type == "data_point") & lacks("measurement_context"), ',"measurement_context":{"measurement_kind":"unknown","currency":null,"scale_multiplier":1,"reporting_standard":null,"attribution_scope":null,"consolidation_scope":null}').otherwise(""),
    )
    origins = F.from_json(F.get_json_object(payload, "$.provenance.origin_object_ids"), "array<string>")
    links = F.concat(F.lit('"provenance":{"derivation_links":'), F.to_json(legacy_links(origins)), F.lit(","))
    linked = F.when(F.get_json_object(payload, "$.provenance").isNotNull() & lacks("provenance.derivation_links"), F.replace(F.regexp_replace(bumped, r'"provenance"\s*:\s*\{\s*(?!\})', '"provenance":{'), F.lit('"provenance":{'), links)).otherwise(bumped)
    return F.when(valid, F.concat(F.regexp_replace(linked, r"\}\s*\z", ""), add, F.lit("}")))
