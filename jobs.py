"""The pipeline's jobs for spark-submit; ``jobs.py --help`` lists them.

Settings (master, memory, shuffle partitions, catalog, packages) belong to spark-submit.
"""

import argparse

from pyspark.sql import SparkSession

from footfall import contract
from footfall.operators import split_csv
from footfall.operators.chunks import DEFAULT_ROWS_PER_FILE
from footfall.plans import build_star, ingest_csv, load_lots
from footfall.streaming import (
    append_new_kpi, decode_events, deliver_events, json_event_log, kafka_event_sink,
    kafka_event_source, rebuild_kpi, run_monitored_kpi,
)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("split-csv", help="cut a CSV into files of exactly N rows")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--rows", type=int, default=DEFAULT_ROWS_PER_FILE)

    job = jobs.add_parser("ingest", help="raw CSV to cleaned Parquet")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--wide", action="store_true", help="read as read_csv_wide does")
    job.add_argument("--partitions", type=int, help="spread the rows of a few big files")

    job = jobs.add_parser("kpi", help="cleaned Parquet to the visit KPI table")
    job.add_argument("source")
    job.add_argument("target")
    job.add_argument("--checkpoint", help="append only files not seen before; else rebuild")
    job.add_argument("--files-per-batch", type=int, default=1000)

    job = jobs.add_parser("monitor", help="the KPI job with progress events")
    job.add_argument("source")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--target", help="where KPI rows go; without it they are only counted")
    job.add_argument("--files-per-batch", type=int, default=1000)
    job.add_argument("--on-error", choices=["skip", "fail"], default="fail")
    job.add_argument("--failed", help="with skip: folder for the names of failed files")
    sink = job.add_mutually_exclusive_group(required=True)
    sink.add_argument("--events", help="folder for events as JSON lines")
    sink.add_argument("--kafka", help="broker list")
    job.add_argument("--topic", default=contract.EVENT_TOPIC)

    job = jobs.add_parser("load-lots", help="KPI folders to the two lot tables")
    job.add_argument("paths", nargs=2)

    job = jobs.add_parser("star", help="lot tables to the star schema")
    job.add_argument("--export-to", help="folder for Parquet copies of the star tables")

    job = jobs.add_parser("listen", help="progress events of a Kafka topic to Parquet")
    job.add_argument("kafka", help="broker list")
    job.add_argument("target")
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--topic", default=contract.EVENT_TOPIC)
    job.add_argument("--max-per-batch", type=int, help="messages per micro-batch")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "split-csv":
        split_csv(spark, args.source, args.target, args.rows)
    elif args.job == "ingest":
        ingest_csv(spark, args.source, args.target, args.wide, args.partitions)
    elif args.job == "kpi" and args.checkpoint:
        append_new_kpi(spark, args.source, args.target, args.checkpoint, args.files_per_batch)
    elif args.job == "kpi":
        rebuild_kpi(spark, args.source, args.target)
    elif args.job == "monitor":
        if args.events:
            emit = json_event_log(args.events)
        else:
            def emit(events):
                kafka_event_sink(events, args.kafka, args.topic).save()
        run_monitored_kpi(spark, args.source, emit, args.checkpoint, args.target,
                          args.files_per_batch, args.on_error, failed=args.failed)
    elif args.job == "load-lots":
        load_lots(spark, args.paths)
    elif args.job == "star":
        build_star(spark, export_to=args.export_to).show(truncate=False)
    elif args.job == "listen":
        messages = kafka_event_source(
            spark, args.kafka, args.topic, max_per_batch=args.max_per_batch).load()
        deliver_events(decode_events(messages, unreadable="texto"), args.target, args.checkpoint).awaitTermination()


def main() -> None:
    args = arguments().parse_args()
    builder = SparkSession.builder.appName(f"footfall {args.job}")
    if args.job in ("load-lots", "star"):
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
