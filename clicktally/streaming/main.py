"""The click counting job as a program.

    spark-submit clicktally/streaming/main.py --servers broker:9092 --topic clicks \\
        --table s3a://bucket/index_gid_click_count --checkpoint s3a://bucket/checkpoints/clicks \\
        --zone Asia/Shanghai --group counts --option maxOffsetsPerTrigger=1000000 --every "1 minute"
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from clicktally.config import CLUSTER_CONF, if_exists
from clicktally.schemas import APP_RESTART, INDEX_CLICK_COUNT, INDEX_CLICK_COUNT_SUM
from clicktally.sources.feed import kafka_options, read_clicks
from clicktally.sources.tables import ResultTable
from clicktally.streaming.jobs import start_click_counts, start_rejects


def _named(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not (name and sign):
        raise argparse.ArgumentTypeError(f"{text!r} is not name=value")
    return name, value


def _positions(text: str) -> dict[int, int]:
    return {int(partition): int(offset) for partition, offset in (part.split(":") for part in text.split(","))}


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_argument_group("source")
    source.add_argument("--format", default="kafka", help="kafka, or a file format with key and value")
    source.add_argument("--servers", help="bootstrap servers")
    source.add_argument("--topic")
    source.add_argument("--start", default="latest", choices=["earliest", "latest"])
    source.add_argument("--saved", type=_positions, help="first start only: partition:offset,partition:offset")
    source.add_argument("--group", help="consumer group id")
    source.add_argument("--option", type=_named, action="append", default=[], help="name=value for the source")
    source.add_argument("--path", help="folder of a file source")
    parser.add_argument("--position", default=APP_RESTART)
    parser.add_argument("--zone", required=True, help="time zone of the dates, the same at every start")
    parser.add_argument("--table", required=True, help="folder of the count table")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--rejects", help="folder for rejected records, by default beside the table")
    parser.add_argument(
        "--mode", default="delta", choices=["delta", "update", "complete"], help="all but delta keep every key in state"
    )
    parser.add_argument("--every", default="5 seconds", help="time between batches")
    parser.add_argument("--once", action="store_true", help="take in what is there and stop")
    args = parser.parse_args(argv)
    if args.format == "kafka" and not (args.servers and args.topic):
        parser.error("kafka needs --servers and --topic")
    if args.format != "kafka" and not args.path:
        parser.error("a file source needs --path")
    args.rejects = args.rejects or f"{args.table.rstrip('/')}_rejects"
    return args


def source_options(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    """Saved positions, and leave to go on if they are gone, hold for the first start only."""
    options = {}
    if args.format == "kafka":
        first = if_exists(lambda: spark.read.text(f"{args.checkpoint}/counts/metadata")) is None
        options = kafka_options(args.servers, args.topic, args.start, args.saved if first else None)
        if args.group:
            options["kafka.group.id"] = args.group
    return options | dict(args.option)


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start the count job; rejects come from the same job, or with state from a second one."""
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    feed = read_clicks(spark, args.format, source_options(spark, args), args.path)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.every}
    delta = args.mode == "delta"
    spec = INDEX_CLICK_COUNT_SUM if delta else INDEX_CLICK_COUNT
    counting = start_click_counts(
        feed,
        ResultTable(spec, args.table),
        f"{args.checkpoint}/counts",
        args.position,
        mode=args.mode,
        rejects_path=args.rejects if delta else None,
        trigger=trigger,
    )
    if delta:
        return [counting]
    return [counting, start_rejects(feed, args.rejects, f"{args.checkpoint}/rejects", args.position, trigger)]


def main() -> None:
    args = arguments()
    builder = SparkSession.builder.appName("click-counts")
    for name, value in CLUSTER_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    queries = start(spark, args)
    if args.once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
