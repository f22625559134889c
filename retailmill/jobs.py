"""Command line for spark-submit.

    python -m retailmill.jobs batch --feed raw_pos_transactions --input_pattern '/landing/pos/*.json' \
        --output_table /lake/bronze/raw_pos_transactions/load=1 --dead_letter_table /lake/dead/pos/load=1
    python -m retailmill.jobs stream-pos --input_directory /landing/pos --root /lake
    python -m retailmill.jobs stream-pos --input_directory /landing/pos --output_table /lake/stream/pos \
        --dead_letter_table /lake/stream/pos_dead --windows_table /lake/stream/pos_windows --checkpoint /lake/ckpt/pos
    python -m retailmill.jobs daily --root /lake --input raw_pos_transactions='/landing/pos/*.json' ...
    python -m retailmill.jobs hourly-ecom --root /lake --prefix /landing/shop
    python -m retailmill.jobs monitoring --root /lake
    python -m retailmill.jobs maintenance --root /lake --table raw_ecom_orders

The sales that ``stream-pos --root`` stores are taken in by the next ``daily``.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from retailmill import schemas
from retailmill.plans import procedures
from retailmill.session import build_session
from retailmill.sources import feeds, landing
from retailmill.streaming import pos as stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="retailmill.jobs")
    parser.add_argument("--as_of", default=None, help="run time, ISO-8601; now if left out")
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="load one feed")
    batch.add_argument("--feed", required=True, choices=sorted(schemas.TABLES))
    batch.add_argument("--input_pattern", required=True)
    batch.add_argument("--output_table", required=True)
    batch.add_argument("--dead_letter_table", required=True)
    batch.add_argument("--strict", action="store_true", help="set lines with a wrong type aside, too")

    pos = jobs.add_parser("stream-pos", help="ingest the point-of-sale stream")
    pos.add_argument("--input_directory", required=True)
    pos.add_argument("--root", default=None, help="the warehouse; sets the paths that are not given")
    pos.add_argument("--output_table", default=None)
    pos.add_argument("--dead_letter_table", default=None)
    pos.add_argument("--windows_table", default=None)
    pos.add_argument("--checkpoint", default=None)
    pos.add_argument("--window_size", type=int, default=stream.WINDOW_SECONDS)
    pos.add_argument("--allowed_lateness", type=int, default=stream.LATENESS_SECONDS)
    pos.add_argument("--max_files", type=int, default=1000)
    pos.add_argument("--once", action="store_true", help="stop after the files present")

    daily = jobs.add_parser("daily", help="run the daily chain")
    daily.add_argument("--root", required=True)
    daily.add_argument("--input", action="append", default=[], metavar="TABLE=PATTERN")
    daily.add_argument("--previous", default=None, help="the run to build on")
    daily.add_argument("--lookback_days", type=int, default=7)

    hourly = jobs.add_parser("hourly-ecom", help="load one hour of orders")
    hourly.add_argument("--root", required=True)
    hourly.add_argument("--prefix", required=True)

    watch = jobs.add_parser("monitoring", help="freshness, duplicates, errors, and the run's own record")
    watch.add_argument("--root", required=True)
    watch.add_argument("--hours", type=int, default=1)

    upkeep = jobs.add_parser("maintenance", help="retention, archive and compaction")
    upkeep.add_argument("--root", required=True)
    upkeep.add_argument("--table", action="append", choices=sorted(schemas.TABLES), help="all if left out")

    args = parser.parse_args(argv)
    if args.job == "stream-pos":
        _stream_paths(parser, args)
    return args


def _stream_paths(parser: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    """Fills in the paths that a warehouse sets."""
    if args.root:
        warehouse = procedures.Warehouse(args.root.rstrip("/"))
        name = schemas.POS.name
        args.output_table = args.output_table or warehouse.stream(name)
        args.dead_letter_table = args.dead_letter_table or warehouse.stream(f"{name}_dead_letter")
        args.windows_table = args.windows_table or warehouse.stream(f"{name}_windows")
        args.checkpoint = args.checkpoint or warehouse.stream(f"{name}_progress")
    if not (args.output_table and args.dead_letter_table and args.checkpoint):
        parser.error("stream-pos needs --root, or --output_table, --dead_letter_table and --checkpoint")


def _stream_pos(spark, args) -> None:
    trigger = {"availableNow": True} if args.once else {"processingTime": "10 seconds"}

    def messages():
        return landing.stream_text_lines(spark, args.input_directory, args.max_files)

    started = stream.start_bronze(
        messages(), args.output_table, args.dead_letter_table, f"{args.checkpoint}/bronze", args.as_of, **trigger
    )
    if args.windows_table:
        rows = feeds.good_rows(stream.parse_messages(messages(), args.as_of))
        windows = stream.windowed_sales(rows, args.window_size, args.allowed_lateness)
        started += stream.start_windowed_sales(
            windows, args.windows_table, f"{args.checkpoint}/windows", args.window_size, args.allowed_lateness, **trigger
        )
    stream.finish(started)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"retailmill-{args.job}")
    as_of = args.as_of or datetime.now(timezone.utc)
    if args.job == "batch":
        record = procedures.run_batch(
            spark, schemas.TABLES[args.feed], args.input_pattern, args.output_table, args.dead_letter_table, as_of,
            strict=args.strict,
        )
        record.show(truncate=False)
    elif args.job == "stream-pos":
        _stream_pos(spark, args)
    elif args.job == "hourly-ecom":
        warehouse = procedures.Warehouse(args.root.rstrip("/"))
        procedures.run_hourly_ecom(spark, warehouse, args.prefix, as_of).show(truncate=False)
    elif args.job == "monitoring":
        warehouse = procedures.Warehouse(args.root.rstrip("/"))
        for output in procedures.run_monitoring(spark, warehouse, as_of, args.hours).values():
            output.show(truncate=False)
    elif args.job == "maintenance":
        warehouse = procedures.Warehouse(args.root.rstrip("/"))
        for name in args.table or sorted(schemas.TABLES):
            procedures.run_maintenance(spark, warehouse, schemas.TABLES[name], as_of).show(truncate=False)
    else:
        inputs = dict(item.split("=", 1) for item in args.input)
        out = procedures.run_daily(spark, args.root, inputs, as_of, args.previous, args.lookback_days)
        out["dq_scorecard"].show(vertical=True)
        out["failed_runs"].show(truncate=False)


if __name__ == "__main__":
    main()
