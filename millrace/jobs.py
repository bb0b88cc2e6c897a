"""Jobs for spark-submit: ``python -m millrace.jobs layers|archive|monitor|errors|words ...``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from millrace.operators.words import word_count, word_split_ws
from millrace.plans.monitors import monitor_errors, monitor_layer
from millrace.schema import TRIGGER
from millrace.session import use_utc
from millrace.sinks.text import write_exposition, write_kv, write_snapshot
from millrace.sources.files import read_lines
from millrace.sources.streams import archive_source, stream_source
from millrace.streaming.archive import archive_stream
from millrace.streaming.layering import start_layers
from millrace.streaming.progress import ProgressLog
from millrace.streaming.supervise import supervise


def _option(text: str) -> tuple[str, str]:
    key, value = text.split("=", 1)
    return key, value


def _utc_time(text: str) -> datetime:
    at = datetime.fromisoformat(text)
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("layers", "archive"):
        job = jobs.add_parser(name)
        job.add_argument("root")
        job.add_argument("--format", default="kafka")
        job.add_argument("--path", help="input folder of a file format")
        job.add_argument("--option", type=_option, action="append", default=[], metavar="KEY=VALUE")
        job.add_argument("--trigger", default=TRIGGER, help="pace, or 'once' for what is there now")
        if name == "layers":
            job.add_argument("--dedup", choices=("exact", "bounded"), default="exact")
            job.add_argument("--delay", default="1 hour")
            job.add_argument("--separate", action="store_true", help="one folder per layer")
            job.add_argument("--files-per-hour", type=int, default=1)
            job.add_argument("--progress", help="table of batch reports, default <root>_progress")
            job.add_argument("--state-partitions", type=int)
    for name in ("monitor", "errors"):
        job = jobs.add_parser(name)
        job.add_argument("root")
        job.add_argument("out")
        job.add_argument("--as-of", type=_utc_time, help="UTC, default now")
        job.add_argument("--separate", action="store_true")
        job.add_argument("--text", action="store_true", help="scrape lines instead of a table")
        if name == "monitor":
            job.add_argument("--layer", help="default all")
            job.add_argument("--prefix", default="")
        else:
            job.add_argument("--metric", default="error_count_per_hour")
    job = jobs.add_parser("words")
    job.add_argument("path")
    job.add_argument("out")
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    args = arguments().parse_args(argv)
    if args.job in ("layers", "archive"):
        source = stream_source if args.job == "layers" else archive_source
        given = dict(args.option) if args.path is None else {"path": args.path, **dict(args.option)}
        messages = source(spark, args.format, **given)
        trigger = None if args.trigger == "once" else args.trigger
        if args.job == "archive":
            supervise(spark, [archive_stream(messages, args.root, trigger)])
            return
        log = ProgressLog(spark, args.progress or f"{args.root}_progress")
        spark.streams.addListener(log)
        try:
            queries = start_layers(
                messages,
                args.root,
                dedup=args.dedup,
                delay=args.delay,
                separate=args.separate,
                committed=True,
                trigger=trigger,
                files_per_hour=args.files_per_hour,
                state_partitions=args.state_partitions,
            )
            supervise(spark, queries)
        finally:
            spark.streams.removeListener(log)
            log.close()
        return
    if args.job == "words":
        write_kv(word_count(word_split_ws(read_lines(spark, args.path))), args.out)
        return
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job == "monitor":
        hour, end = as_of.replace(minute=0, second=0, microsecond=0), as_of + timedelta(microseconds=1)
        layer = args.layer or ("raw-data" if args.separate else None)
        found = monitor_layer(spark, args.root, layer, hour, end, args.prefix, separate=args.separate)
    else:
        found = monitor_errors(spark, args.root, as_of, args.metric, separate=args.separate)
    (write_exposition if args.text else write_snapshot)(found, args.out)


def main() -> None:
    run(use_utc(SparkSession.builder.appName("millrace").getOrCreate()), sys.argv[1:])


if __name__ == "__main__":
    main()
