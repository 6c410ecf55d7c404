"""Job entry point, for ``spark-submit`` or ``python -m regweave``.

    python -m regweave STORE ingest ARCHIVE ... [--force] [--public] [--only TABLE ...]
    python -m regweave STORE build
    python -m regweave STORE all ARCHIVE ... [--force] [--public] [--only TABLE ...]
    python -m regweave STORE qa [--only-problems] [--json PATH]
    python -m regweave STORE query SQL [--limit N | --csv PATH]
    python -m regweave STORE export PATH [--table NAME | --sql SQL]
    python -m regweave STORE lookup FACILITY
    python -m regweave STORE info
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession, functions as F

from regweave.operators import quality
from regweave.plans import build as plans, layout
from regweave.plans.landing import drift, land_archive
from regweave.session import ENGINE_CONF
from regweave.sources.storage import Store


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser("regweave", description=__doc__.split("\n")[0])
    parser.add_argument("store", help="folder or URI of the published tables")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "all"):
        command = commands.add_parser(name)
        command.add_argument("archive", nargs="+", help="archives that together make one extract")
        command.add_argument("--force", action="store_true", help="land again what is there")
        command.add_argument("--public", action="store_true", help="withhold personal data")
        command.add_argument("--only", nargs="+", metavar="TABLE")
    commands.add_parser("build")
    commands.add_parser("info")
    qa = commands.add_parser("qa")
    qa.add_argument("--only-problems", action="store_true")
    qa.add_argument("--json", metavar="PATH")
    query = commands.add_parser("query")
    query.add_argument("sql", help="Spark SQL, or - for standard input")
    query.add_argument("--limit", type=int, default=40, help="rows shown")
    query.add_argument("--csv", metavar="PATH", help="write all rows to PATH (.csv) instead of showing some")
    lookup = commands.add_parser("lookup")
    lookup.add_argument("facility", help="registry id")
    export = commands.add_parser("export")
    export.add_argument("path")
    export.add_argument("--table", default="crosswalk")
    export.add_argument("--sql")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one command; the exit status is 1 when a quality check fails, 2 for an unknown export format."""
    store = Store(spark, args.store)
    if args.command in ("ingest", "all"):
        if unknown := drift(store, args.archive):
            print("members the registry does not know:", ", ".join(unknown))
        for r in land_archive(store, args.archive, force=args.force, public=args.public, only=args.only):
            print(f"{r.table:<24}{r.rows:>14,} rows {r.seconds:8.1f} s  control bytes {r.control_bytes}, "
                  f"bad bytes {r.bad_bytes}, U+FFFD in source {r.source_replacements}")
    if args.command in ("build", "all"):
        info = plans.build(store)
        print(f"crosswalk rows: {info.crosswalk_rows:,}\nwater_system rows: {info.water_system_rows:,}")
    elif args.command == "info":
        counts = {r.table: r for r in plans.info_listing(store).collect()}  # a row for each registered table
        for name, r in sorted(counts.items()):
            print(f"{name:<24}{f'{r.n:,}' if r.n else '-':>16}  {r.grain}")
        print(f"{'total':<24}{sum(r.n or 0 for r in counts.values()):>16,}")
    elif args.command == "qa":
        report = plans.run_quality(store)
        shown = report.filter(F.col("status") != quality.OK) if args.only_problems else report
        if args.json:
            plans.export_report(report, args.json, only_problems=args.only_problems)
        else:
            for r in shown.collect():  # one short line for each check
                samples = ", ".join(f"{s.key} ({s.n})" for s in r.sample or ())
                print(f"{r.status:<6}{r.name:<56}{r.value or '-':<24}{r.detail or ''} {samples}".rstrip())
        counts = {r.status: r.n for r in quality.tally(report).collect()}
        print(", ".join(f"{n} {status}" for status, n in sorted(counts.items())))
        return int(counts[quality.FAIL] > 0)
    elif args.command == "query":
        sql = sys.stdin.read() if args.sql == "-" else args.sql
        rows = plans.open_layers(store).query(spark, sql)
        if args.csv:
            plans.export(rows, args.csv)
        else:
            rows.show(args.limit, truncate=False)
    elif args.command == "lookup":
        rows = layout.lookup(store, args.facility)
        rows.orderBy(*rows.columns[:2]).show(1000, truncate=False)
    elif args.command == "export":
        layers = plans.open_layers(store)
        frame = layers.query(spark, args.sql) if args.sql else layers.relation(args.table)
        try:
            plans.export(frame, args.path)
        except plans.UnknownFormat as error:
            print(error, file=sys.stderr)
            return 2
    return 0


def main(argv: list[str]) -> int:
    args = arguments(argv)
    builder = SparkSession.builder.appName("regweave")
    for key, value in {"spark.ui.enabled": "false", **ENGINE_CONF}.items():
        builder = builder.config(key, value)
    return run(builder.getOrCreate(), args)


def command() -> None:
    sys.exit(main(sys.argv[1:]))


if __name__ == "__main__":
    command()
