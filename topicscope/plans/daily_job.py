"""Batch job: record files in, daily top-k topics out as JSON lines.

    spark-submit -m topicscope.plans.daily_job <input paths/globs> <output dir>

Options: ``--k``, ``--ties include|cut``, ``--match equals|contains|none``,
``--stop-topic`` (repeatable), ``--mode``, ``--reader typed|lines``.

``--reader lines`` applies the positional line rules instead of the typed
scan: a line counts when it has more than 23 fields after trailing empty ones
are dropped, the day is sliced from field 1, an empty name list yields one
blank topic; with it the defaults become ``--match contains --ties cut``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators.topics import DEFAULT_STOP_TOPICS, daily_top_topics_nested
from ..session import size_scan, size_shuffle
from ..sinks.json import write_json_lines
from ..sources.gkg import gkg_line_records, gkg_records, read_gkg, read_lines


def daily_report(spark: SparkSession, inputs, k: int = 10, ties: str = "include",
                 stop_topics=DEFAULT_STOP_TOPICS, match: str = "equals",
                 reader: str = "typed") -> DataFrame:
    """(data, result[]) per day from record files."""
    if reader == "typed":
        records = gkg_records(read_gkg(spark, inputs))
    elif reader == "lines":
        records = gkg_line_records(read_lines(spark, inputs))
    else:
        raise ValueError(f"unknown reader {reader!r}")
    return daily_top_topics_nested(records, k, ties, stop_topics=stop_topics, match=match)


def run(spark: SparkSession, inputs, output: str, mode: str = "errorifexists",
        size_partitions: bool = True, **opts) -> None:
    if size_partitions:
        paths = [inputs] if isinstance(inputs, str) else inputs
        size_scan(spark, paths)
        size_shuffle(spark, paths)
    write_json_lines(daily_report(spark, inputs, **opts), output, mode)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("inputs", nargs="+")
    ap.add_argument("output")
    ap.add_argument("--k", type=int, default=10)
    ap.add_argument("--reader", default="typed", choices=["typed", "lines"])
    ap.add_argument("--ties", choices=["include", "cut"])
    ap.add_argument("--match", choices=["equals", "contains", "none"])
    ap.add_argument("--stop-topic", action="append")
    ap.add_argument("--mode", default="errorifexists")
    args = ap.parse_args(argv)
    from ..session import build_session
    spark = build_session()
    stops = tuple(args.stop_topic) if args.stop_topic else DEFAULT_STOP_TOPICS
    lines = args.reader == "lines"
    run(spark, args.inputs, args.output, args.mode, k=args.k,
        ties=args.ties or ("cut" if lines else "include"), stop_topics=stops,
        match=args.match or ("contains" if lines else "equals"), reader=args.reader)
    spark.stop()


if __name__ == "__main__":
    main()
