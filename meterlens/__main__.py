"""Command line: ``python -m meterlens <command> ...``.

  pipeline     read stored readings, write the twelve result datasets
  experiment   run the data-size scaling experiment, write its result table
  feed         stream raw CSV feed files into normalised records (JSON files or a topic)
  land         stream records (JSON files or a topic) into the Parquet readings table

Options of a source or sink (topic, broker, document store) are given as
``--option key=value``, once each.
"""

from __future__ import annotations

import argparse
import json

from meterlens.session import build_session


def _option(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not (key and found):
        raise argparse.ArgumentTypeError(f"{text!r} is not key=value")
    return key, value


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="meterlens", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    p.add_argument("--initial-partitions", type=int, default=None,
                   help="shuffle partitions to start from (about shuffled bytes / 128 MB)")
    source = argparse.ArgumentParser(add_help=False)
    source.add_argument("--option", type=_option, action="append", default=[], metavar="KEY=VALUE")
    sub = p.add_subparsers(dest="command", required=True)

    pipe = sub.add_parser("pipeline", parents=[source], help="full analytics job")
    pipe.add_argument("readings", help="stored readings (Parquet unless --format)")
    pipe.add_argument("out", help="results directory")
    pipe.add_argument("--format", default="parquet", help="input format")
    pipe.add_argument("--result-format", default="csv")
    pipe.add_argument("--quartiles", default="approx", choices=["approx", "exact"])
    pipe.add_argument("--unsorted-anomalies", action="store_true",
                      help="skip the global sort of the anomaly records")

    exp = sub.add_parser("experiment", parents=[source], help="scaling experiment")
    exp.add_argument("readings")
    exp.add_argument("out")
    exp.add_argument("--format", default="parquet")
    exp.add_argument("--runs", type=int, default=3)
    exp.add_argument("--sizes", default="25,50,100")
    exp.add_argument("--partitions", type=int, default=None,
                     help="spread the cached input over so many partitions")
    exp.add_argument("--combined", action="store_true", help="one grouping-sets job")

    feed = sub.add_parser("feed", parents=[source], help="raw CSV feed -> JSON records (streaming)")
    feed.add_argument("feed_dir")
    feed.add_argument("records_dir", nargs="?", default=None, help="not for a topic")
    feed.add_argument("--sink-format", default="json", choices=["json", "kafka"])
    feed.add_argument("--batches", action="store_true",
                      help="replayable batches with stored counters; each file bound by its own header")
    feed.add_argument("--checkpoint", default=None)
    feed.add_argument("--max-files-per-trigger", type=int, default=None)
    feed.add_argument("--clean-source", default="off", choices=["off", "archive", "delete"])
    feed.add_argument("--archive-dir", default=None)

    land = sub.add_parser("land", parents=[source], help="JSON records -> Parquet readings (streaming)")
    land.add_argument("records_dir", help="'-' for a topic")
    land.add_argument("readings_dir")
    land.add_argument("--source-format", default="json", choices=["json", "text", "kafka"])
    land.add_argument("--rejects", default=None, help="folder for messages that are no record")
    land.add_argument("--batches", action="store_true",
                      help="replayable batches with stored counters; readings and --rejects in one pass")
    land.add_argument("--checkpoint", default=None)
    land.add_argument("--max-files-per-trigger", type=int, default=None)
    land.add_argument("--clean-source", default="off", choices=["off", "archive", "delete"])
    land.add_argument("--archive-dir", default=None)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master, initial_partitions=args.initial_partitions)
    options = dict(args.option)
    try:
        if args.command == "pipeline":
            from meterlens.plans.pipeline import run_pipeline
            from meterlens.sources import read_readings

            records = read_readings(spark, args.readings, fmt=args.format, options=options)
            counts = run_pipeline(spark, records, args.out, fmt=args.result_format,
                                  method=args.quartiles,
                                  sort_anomalies=not args.unsorted_anomalies)
            print(json.dumps(counts))
        elif args.command == "experiment":
            from meterlens.operators.cleaning import prepare_workload_input
            from meterlens.plans.experiment import scalability_experiment
            from meterlens.sinks import write_result
            from meterlens.sources import read_readings

            prepared = prepare_workload_input(read_readings(spark, args.readings, fmt=args.format, options=options))
            sizes = tuple(int(x) for x in args.sizes.split(","))
            result = scalability_experiment(spark, prepared, sizes=sizes, runs=args.runs,
                                            combined=args.combined, partitions=args.partitions)
            write_result(result, args.out, single_file=True)
            result.show(truncate=False)
        elif args.command in ("feed", "land") and args.batches:
            from meterlens.streaming import stream_feed_batches, stream_land_batches

            common = {
                "checkpoint": args.checkpoint,
                "max_files_per_trigger": args.max_files_per_trigger,
                "clean_source": args.clean_source,
                "archive_dir": args.archive_dir,
            }
            if args.command == "feed":
                query = stream_feed_batches(spark, args.feed_dir, args.records_dir, **common)
            else:
                source = None if args.records_dir == "-" else args.records_dir
                rejects = args.rejects or f"{args.readings_dir.rstrip('/')}_rejected"
                query = stream_land_batches(spark, source, args.readings_dir, rejects,
                                            source_format=args.source_format,
                                            source_options=options, **common)
            query.awaitTermination()
        elif args.command == "feed":
            from meterlens.streaming import stream_feed_to_records

            stream_feed_to_records(spark, args.feed_dir, args.records_dir,
                                   checkpoint=args.checkpoint,
                                   sink_format=args.sink_format, sink_options=options,
                                   max_files_per_trigger=args.max_files_per_trigger,
                                   clean_source=args.clean_source,
                                   archive_dir=args.archive_dir,
                                   ).awaitTermination()
        elif args.command == "land":
            from meterlens.streaming import stream_land_readings, stream_rejected_messages

            source = None if args.records_dir == "-" else args.records_dir
            if args.rejects:  # first: the landing query may archive or delete its files
                stream_rejected_messages(spark, source, args.rejects,
                                         source_format=args.source_format,
                                         source_options=options).awaitTermination()
            stream_land_readings(spark, source, args.readings_dir,
                                 checkpoint=args.checkpoint,
                                 source_format=args.source_format, source_options=options,
                                 max_files_per_trigger=args.max_files_per_trigger,
                                 clean_source=args.clean_source,
                                 archive_dir=args.archive_dir,
                                 ).awaitTermination()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
