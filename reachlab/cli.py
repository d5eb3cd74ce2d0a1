"""Command line: list queries, run one to a table, or build all of them with resume."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reachlab.plans import catalog, materialize


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="reachlab")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query")
    build = sub.add_parser("build-all")
    build.add_argument("--limit", type=int)
    build.add_argument("--only", nargs="*")
    build.add_argument("--skip-existing", action="store_true")
    for s in (run, build):
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
    args = p.parse_args(argv)
    catalog.load()
    if args.command == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = SparkSession.builder.appName("reachlab").getOrCreate()
    names = [args.query] if args.command == "run" else [n for n in sorted(catalog.QUERIES) if not args.only or n in args.only][: args.limit]
    if unknown := [n for n in names if n not in catalog.QUERIES]:
        p.error(f"no such query: {', '.join(unknown)}")
    for n in names:
        path = f"{args.output}/{n}"
        if getattr(args, "skip_existing", False) and materialize.exists(spark, f"{path}/_SUCCESS"):
            continue
        catalog.QUERIES[n](spark, args.input).write.mode("overwrite").parquet(path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
