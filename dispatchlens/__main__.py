"""Command line: feeds, streams, batch runs and reports.

    python -m dispatchlens summary FEEDS [--from DATE] [--to DATE]
    python -m dispatchlens batch   FEEDS RESULTS [--from DATE] [--to DATE]
    python -m dispatchlens stream  --files FEEDS RESULTS CHECKPOINTS [--max-files N]
    python -m dispatchlens stream  --kafka CONNECTION.json ORDERS COURIERS RESULTS CHECKPOINTS
                                   [--max-offsets N]
    python -m dispatchlens publish CONNECTION.json FEEDS ORDERS COURIERS [--checkpoints FOLDER]
    python -m dispatchlens report  NAME RESULTS [--from DATE] [--to DATE] [--rows N | --out FOLDER]

Folders may be any URI Hadoop knows.  CONNECTION.json holds the Kafka options,
such as kafka.bootstrap.servers.  Submit with spark-submit to run on a cluster.
"""

from __future__ import annotations

import argparse
import json

from . import jobs
from .plans.catalog import REPORTS
from .schemas import COURIER_FEED, ORDER_FEED
from .session import create_session, streaming_session
from .sources.kafka import publish, publish_stream, to_records
from .streaming.runner import finish_all, run_until_stopped, start_all


def _arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="dispatchlens", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    parser.add_argument("--master", help="Spark master; leave out under spark-submit")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    def dated(sub: argparse.ArgumentParser) -> argparse.ArgumentParser:
        sub.add_argument("--from", dest="first")
        sub.add_argument("--to", dest="last")
        return sub

    dated(command("summary", "feeds"))
    dated(command("batch", "feeds", "results"))
    publishing = command("publish", "connection", "feeds", "orders", "couriers")
    publishing.add_argument("--checkpoints", help="publish as a stream that remembers its place")
    stream = command("stream", "results", "checkpoints")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--files", metavar="FEEDS")
    source.add_argument("--kafka", nargs=3, metavar=("CONNECTION", "ORDERS", "COURIERS"))
    stream.add_argument("--starting-offsets", default="latest")
    stream.add_argument("--max-offsets", type=int, help="most records of a topic in a batch")
    stream.add_argument("--max-files", type=int, help="most files of a feed in a batch")
    stream.add_argument("--once", action="store_true", help="handle what is there and end")
    stream.add_argument("--interval", help="trigger interval, such as '10 seconds'")
    reports = dated(command("report", "name", "results"))
    reports.add_argument("--rows", type=int, help="print so many rows only")
    reports.add_argument("--out", metavar="FOLDER", help="write the report as parquet")
    args = parser.parse_args(argv)
    if args.command == "report" and args.name not in REPORTS:
        parser.error(f"unknown report {args.name}; one of {', '.join(REPORTS)}")
    return args


def _connection(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def main(argv=None) -> None:
    args = _arguments(argv)
    spark = create_session("dispatchlens", args.master)
    if args.command == "summary":
        feeds = jobs.stored_feeds(spark, args.feeds, first_date=args.first, last_date=args.last)
        for counts in jobs.feed_summary(feeds).values():
            counts.show(truncate=False)
    elif args.command == "batch":
        feeds = jobs.stored_feeds(spark, args.feeds, first_date=args.first, last_date=args.last)
        jobs.run_batch(feeds, args.results)
    elif args.command == "publish":
        connection, streaming = _connection(args.connection), args.checkpoints is not None
        feeds = jobs.stored_feeds(spark, args.feeds, streaming)
        for name, schema, topic in (
            (jobs.ORDERS, ORDER_FEED, args.orders),
            (jobs.COURIERS, COURIER_FEED, args.couriers),
        ):
            if streaming:
                records = to_records(feeds[name], schema)
                finish_all([publish_stream(records, topic, connection, args.checkpoints)])
            else:
                publish(feeds[name], schema, topic, connection)
    elif args.command == "stream":
        session = streaming_session(spark)
        if args.files:
            limit = {"maxFilesPerTrigger": str(args.max_files)} if args.max_files else {}
            feeds = jobs.stored_feeds(session, args.files, streaming=True, **limit)
        else:
            path, *topics = args.kafka
            offsets = args.starting_offsets, args.max_offsets
            feeds = jobs.topic_feeds(session, _connection(path), *topics, *offsets)
        sink = {"available_now": args.once, "interval": args.interval}
        queries = start_all(feeds, args.results, args.checkpoints, **sink)
        if args.once:
            finish_all(queries)
        else:
            run_until_stopped(session, queries)
    elif args.command == "report":
        frame = jobs.report(spark, args.name, args.results, args.first, args.last)
        if args.out:
            frame.write.parquet(args.out)
        elif args.rows is not None:
            frame.show(args.rows, truncate=False)
        else:
            print(*frame.columns, sep="\t")
            for row in frame.toLocalIterator():
                print(*row, sep="\t")


if __name__ == "__main__":
    main()
