"""Command line: python -m lamina ingest FILE ..., or python -m lamina with one of the options below."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from lamina.operators.scope import describe
from lamina.plans.inspect import explain, inventory, readiness
from lamina.plans.registry import CURATED, RAW, STAGING, default_registry
from lamina.plans.runner import run_many, selected, summary
from lamina.session import session
from lamina.sources.database import Database, Layers
from lamina.sources.export import Export
from lamina.sources.ingest import ingest, provision
from lamina.sources.labels import feed_name
from lamina.sources.payloads import PayloadError
from lamina.sources.tables import Tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lamina", description=__doc__)
    p.add_argument("--root", default=os.environ.get("LAMINA_ROOT", "data"), help="folder of the layers")
    what = p.add_mutually_exclusive_group()
    for flag in ("list", "inspect", "shippers", "list-groups", "all"):
        what.add_argument(f"--{flag}", action="store_true")
    what.add_argument("--show-plan", metavar="NAME")
    what.add_argument("--table", metavar="NAME")
    what.add_argument("--group", metavar="FOLDERS")
    p.add_argument("--source", help="only this feed")
    p.add_argument("--database", action="store_true", help="raw tables are in the database of DATABASE_URL or the PG* settings")
    p.add_argument("--reload", action="store_true", help="build tables that are there, too")
    p.add_argument("--parquet-dir", default=os.environ.get("PARQUET_OUTPUT_DIR", ""), help="folder for exports")
    p.add_argument("--no-parquet", action="store_true")
    commands = p.add_subparsers(dest="command")
    i = commands.add_parser("ingest")
    i.add_argument("file", nargs="+")
    i.add_argument("--dry-run", action="store_true")
    i.add_argument("--create-tables", action="store_true", help="begin with empty raw tables where there are none")
    return p


def main(argv: list[str] | None = None) -> int:
    """0: done. 1: a table or a write failed. 2: a name, file or payload is wrong."""
    args = parser().parse_args(argv)
    logging.basicConfig(stream=sys.stdout, level=os.environ.get("LOG_LEVEL", "INFO"), format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    registry, folder = default_registry(), "" if args.no_parquet else args.parquet_dir
    if args.list:
        for name in selected(registry, source=args.source):
            print(name, feed_name(registry[name].feed), ", ".join(t for _, t in (*registry[name].sources, *registry[name].optional)))
        return 0
    if args.list_groups:
        print("\n".join(sorted({p.group for p in registry.values() if p.group})))
        return 0
    wanted = args.show_plan or args.table
    if wanted and wanted not in registry:
        print(f"unknown: {wanted}", file=sys.stderr)
        return 2
    spark = session()
    tables = Tables(spark, args.root)
    if args.database or os.environ.get("DB_TYPE") in ("postgres", "jdbc"):
        tables = Layers(tables, {RAW: Database.from_environment(spark)})
    if args.command == "ingest":
        if args.create_tables and not args.dry_run:
            provision(tables)
        for file in args.file:
            try:
                done = ingest(spark, file, tables, export_dir=folder, dry_run=args.dry_run)
            except PayloadError as e:
                print(e, file=sys.stderr)
                return 2
            except Exception as e:
                print(f"{type(e).__name__}: {e}", file=sys.stderr)
                return 2 if "PATH_NOT_FOUND" in str(e) else 1
            print(f"{file}: {done.objects_read} read, {done.rows_written} new, {done.rows_rejected} invalid")
        return 0
    if args.show_plan:
        print(explain(registry, tables, wanted))
        return 0
    if args.inspect:
        inventory(tables, (RAW, STAGING, CURATED)).show(200, truncate=False)
        for name, status, missing in readiness(registry, tables):
            print(f"[{status:7}] {name}" + f": missing {', '.join(missing)}" * bool(missing))
        return 0
    if args.shippers:
        there = tables.exists(RAW, "shipper_mapping")
        print("\n".join(describe(tables.read(RAW, "shipper_mapping"), args.source)) if there else "no shipper mapping")
        return 0
    names = [args.table] if args.table else selected(registry, args.group, args.source)
    if not names:
        logging.warning("nothing selected")
        return 0
    results = run_many(registry, tables, names, args.reload, Export.start(folder, os.environ.get("PARQUET_STAGE", "")))
    for r in results:
        print(f"{r.name}: {r.status}, {r.rows} rows, {r.seconds:.1f} s {r.error}")
    print(summary(results))
    return int(any(r.status == "failed" for r in results))


if __name__ == "__main__":
    sys.exit(main())
