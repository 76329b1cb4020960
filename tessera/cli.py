"""A thin command line (survey B5, 2.P): parse files, export schemas, back up, migrate and restore a store."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from tessera.functions.objects import CURRENT_VERSION, TYPES, json_schema
from tessera.functions.schemas import registry
from tessera.operators.store import SHOWN, ObjectStore, StoreError, upgrade_payload
from tessera.session import local_session
from tessera.sources import readers


def _parse(args: argparse.Namespace) -> dict:
    spark = local_session(args.cores)
    files = readers.read_text_files(spark, args.path, args.glob)
    docs = files.where("code IS NULL").select(F.col("path").alias("document_id"), "text")
    units = readers.PARSERS[args.type](docs)
    units.write.mode("errorifexists").parquet(args.out)
    unread = files.where("code IS NOT NULL").select("path", "code")
    failed = [r.asDict() for r in unread.orderBy("path").limit(SHOWN).collect()]
    return {"status": "ok", "units": spark.read.parquet(args.out).count(), "failed": failed, "failed_count": unread.count()}


def _schemas(args: argparse.Namespace) -> dict:
    return {"status": "ok", "schemas": registry(), "objects": {kind: json_schema(kind) for kind in TYPES}, "latest": CURRENT_VERSION}


def _backup(args: argparse.Namespace) -> dict:
    return {"status": "ok", "backup": ObjectStore(local_session(args.cores), args.store).backup(args.folder)}


def _migrate(args: argparse.Namespace) -> dict:
    store = ObjectStore(local_session(args.cores), args.store)
    return {"status": "ok", "report": store.migrate(upgrade_payload, args.from_version, args.to_version, args.dry_run, args.backup)}


def _restore(args: argparse.Namespace) -> dict:
    return {"status": "ok", "report": ObjectStore(local_session(args.cores), args.store).restore(args.folder, args.sha256)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera", description=__doc__)
    parser.add_argument("--cores", type=int, default=8)
    commands = parser.add_subparsers(required=True)
    parse = commands.add_parser("parse", help="parse text files into units")
    parse.add_argument("type", choices=sorted(readers.PARSERS))
    parse.add_argument("path")
    parse.add_argument("out")
    parse.add_argument("--glob")
    parse.set_defaults(run=_parse)
    commands.add_parser("schemas", help="print the schemas as JSON").set_defaults(run=_schemas)
    for name, run, extra in (("backup", _backup, ("folder",)), ("restore", _restore, ("folder", "sha256"))):
        command = commands.add_parser(name)
        command.add_argument("store")
        for x in extra:
            command.add_argument(x)
        command.set_defaults(run=run)
    migrate = commands.add_parser("migrate")
    migrate.add_argument("store")
    migrate.add_argument("--from-version", default="1.0")
    migrate.add_argument("--to-version", default="1.1")
    migrate.add_argument("--backup")
    migrate.add_argument("--dry-run", action="store_true")
    migrate.set_defaults(run=_migrate)
    args = parser.parse_args(argv)
    try:
        result, failed = args.run(args), 0
    except (StoreError, ValueError) as error:
        result, failed = {"status": "error", "error_code": getattr(error, "code", "INVALID_REQUEST"), "error_message": str(error)}, 1
    print(json.dumps(result, ensure_ascii=False, indent=2, sort_keys=True))
    return failed


if __name__ == "__main__":
    sys.exit(main())
