"""Run the streams: ``python -m odsflow.streaming clicks|changes --root ... --checkpoint ...``."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from odsflow.schemas import CHANGE_FEEDS, CLICK_TOPIC
from odsflow.session import build_session
from odsflow.sources.topics import read_topic, read_topic_files
from odsflow.streaming import changes, clicks


def _archive(folder: str, spark: SparkSession, _servers: str, topic: str, _limit: int | None = None):
    return read_topic_files(spark, f"{folder}/{topic}")


def start(spark: SparkSession, options: argparse.Namespace) -> list[StreamingQuery]:
    read = partial(_archive, options.archive) if options.archive else read_topic
    trigger = {"availableNow": True} if options.once else {}
    root, checkpoint = options.root, f"{options.checkpoint}/{options.stream}"
    if options.stream == "changes":
        started = changes.start_all(
            spark, options.servers, root, checkpoint, read, options.max_offsets, options.contiguous, **trigger
        )
        return list(started.values())
    limit = 5000 if options.max_offsets is None else options.max_offsets or None
    messages = partial(read, spark, options.servers, CLICK_TOPIC, limit)
    products = None
    if options.enrich:
        # A new object for each batch, which lists the files that are current then.
        products = lambda: changes.keyed_table(spark, root, CHANGE_FEEDS["products"]).read()
    started = [
        clicks.start_valid(messages(), f"{root}/dwd_clickstream_events", checkpoint, products=products, **trigger),
        clicks.start_dead_letters(messages(), f"{root}/ods_clickstream_deadletter", checkpoint, **trigger),
    ]
    started.append(clicks.start_late_rows(messages(), f"{root}/clickstream_late_rows", checkpoint, **trigger))
    if options.windows:
        path = f"{root}/clickstream_window_counts"
        started.append(clicks.start_window_counts(messages(), path, checkpoint, **trigger))
    if options.contiguous:
        started.append(clicks.start_offsets(messages(), f"{root}/clickstream_offsets", checkpoint, **trigger))
    return started


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="odsflow.streaming")
    parser.add_argument("stream", choices=("clicks", "changes"))
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--checkpoint", required=True, help="folder of the checkpoints")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", default="", help="Kafka brokers")
    source.add_argument("--archive", default="", help="folder of archived topics")
    parser.add_argument("--max-offsets", type=int, help="messages per batch, 0 for no bound (5,000 clicks by default)")
    parser.add_argument("--enrich", action="store_true", help="add the product's category to clicks")
    parser.add_argument("--windows", action="store_true", help="also write five-minute counts of clicks")
    parser.add_argument("--contiguous", action="store_true", help="missing offsets are an error (no compacted topics)")
    parser.add_argument("--once", action="store_true", help="stop when all present messages are done")
    return parser.parse_args(arguments)


def main() -> None:
    options = parse()
    spark = build_session(f"odsflow-{options.stream}")
    queries = start(spark, options)
    if options.once:
        for query in queries:
            query.awaitTermination()
    else:
        # A query that fails ends the job, so that it is noticed and restarted.
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
