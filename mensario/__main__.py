"""Command line for spark-submit: ``ingest``, ``process``, ``check``, ``book``, ``run`` and ``clean``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame

from mensario import fixed_values as fv
from mensario.functions.period import Period
from mensario.operators import inspection
from mensario.plans import incremental, monthly
from mensario.session import cluster_session
from mensario.sources.files import Delivery
from mensario.sources.lake import Lake
from mensario.sources.tables import APPEND, REPLACE_MONTHS

#: Rows of a check that are printed.
SHOWN = 20


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="mensario")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "process", "check", "book", "run", "clean"):
        command = commands.add_parser(name)
        command.add_argument("--lake", required=True, help="root folder of the lake")
        if name in ("ingest", "run"):
            command.add_argument("--faturas", help="folder with the invoice files")
            command.add_argument("--pagamentos", help="folder with the payment files")
            command.add_argument("--faturas-name", default="*", help="pattern of the invoice files' names")
            command.add_argument("--pagamentos-name", default="*", help="pattern of the payment files' names")
            command.add_argument("--delivery", help="one folder with the files of both, named after their subject")
        if name == "process":
            command.add_argument("subject", choices=monthly.SUBJECTS)
        if name in ("check", "book", "run"):
            command.add_argument("--ref-date", required=True, type=date.fromisoformat)
            command.add_argument("--months", type=int, default=fv.MESES_BOOK)
        if name in ("process", "book", "run"):
            command.add_argument("--dt-proc", default=None)
            command.add_argument("--mode", choices=(APPEND, REPLACE_MONTHS), default=APPEND)
        if name in ("process", "book", "run"):
            command.add_argument("--force", action="store_true", help="run even if no file is waiting")
        if name in ("book", "run"):
            command.add_argument("--from-states", action="store_true", help="from stored states of each month, without a stage")
        if name in ("process", "run"):
            command.add_argument("--only-pending", action="store_true")
            command.add_argument("--buckets", type=int, help="store the trusted tables in so many buckets by customer and invoice")
    return parser


def _sources(parser: argparse.ArgumentParser, args: argparse.Namespace) -> monthly.Sources:
    if args.delivery and not (args.faturas or args.pagamentos):
        return monthly.mixed_delivery(args.delivery)
    if args.delivery or not (args.faturas and args.pagamentos):
        parser.error("give --faturas and --pagamentos, or --delivery")
    return {
        fv.SUBJECT_FATURAS: Delivery(args.faturas, args.faturas_name),
        fv.SUBJECT_PAGAMENTOS: Delivery(args.pagamentos, args.pagamentos_name),
    }


def _show(title: str, rows: DataFrame) -> None:
    n, first = inspection.report(rows, SHOWN)
    print(f"{title}: {n} rows")
    for row in first:
        print("  " + ", ".join(f"{c}={v}" for c, v in row.asDict().items()))


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    sources = _sources(parser, args) if args.command in ("ingest", "run") else {}
    spark = cluster_session(f"mensario-{args.command}")
    lake = Lake(args.lake)
    build = incremental.build_book if getattr(args, "from_states", False) else monthly.build_book
    if args.command == "ingest":
        monthly.ingest(spark, lake, sources)
    elif args.command == "process":
        monthly.process(
            spark, lake, args.subject, args.dt_proc, args.mode, args.only_pending, not args.force, args.buckets
        )
    elif args.command == "check":
        for title, rows in monthly.book_checks(spark, lake, Period(args.ref_date, args.months)).items():
            _show(title, rows)
    elif args.command == "clean":
        print(f"removed {monthly.remove_hidden_runs(spark, lake)} folders")
    elif args.command == "book":
        period = Period(args.ref_date, args.months)
        build(spark, lake, period, args.dt_proc, args.mode, gate=not args.force)
    else:
        period = Period(args.ref_date, args.months)
        monthly.run_month(spark, lake, sources, period, args.dt_proc, args.mode, args.only_pending, not args.force, args.buckets, build)


if __name__ == "__main__":
    main()
