"""Command line of the streaming job: ``python -m tidemark.plans.job rows ...``.

Submit it to a cluster with this package in ``--py-files``, and the Kafka connector
in ``--packages`` where messages come from a topic.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import dictionary
from tidemark.operators.dictionary import Dictionaries
from tidemark.plans import rows
from tidemark.session import new_dir, prepare
from tidemark.sinks import stores, table
from tidemark.sources import messages, metadata
from tidemark.streaming import jobs

MODES = {
    "rows": "metric rows and quarantine to the log",
    "keep-all": "the same, with rows that have no environment or host kept",
    "json": "rows as JSON texts",
    "windows": "rows once per sliding window",
    "rollup": "metrics merged over sliding windows",
    "open-rollup": "the same, each window again whenever it changes",
    "batches": "rows batch by batch, with dictionaries read anew",
    "store": "the last row per key of each batch, upserted into a keyed store",
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description=__doc__)
    out.add_argument("mode", choices=MODES)
    out.add_argument("--name", default="Default Handler")
    out.add_argument("--path", help="folder the output is appended to")
    out.add_argument("--bad", help="folder for records set aside, in modes that do not keep them")
    out.add_argument("--checkpoint", required=True, help="folder all executors share")
    out.add_argument("--interval", default=jobs.INTERVAL, help="'once' takes in what is there")
    source = out.add_argument_group("messages")
    source.add_argument("--files", help="folder of message files instead of a topic")
    source.add_argument("--files-schema", default="message_id bigint, value string")
    source.add_argument("--files-format", default="parquet")
    source.add_argument("--max-files", type=int)
    source.add_argument("--brokers", default=messages.BROKERS)
    source.add_argument("--topic", default=messages.TOPIC)
    source.add_argument("--group", default=messages.GROUP)
    source.add_argument("--starting", default="latest")
    source.add_argument("--max-offsets", type=int)
    source.add_argument("--min-partitions", type=int)
    meaning = out.add_argument_group("reading")
    meaning.add_argument("--codec", default="gzip", choices=["gzip", "zlib", "none", "plain"])
    meaning.add_argument("--zone", default="UTC", help="zone of the time buckets")
    meaning.add_argument("--env-key", default="environment")
    meaning.add_argument("--app-key", default="appname")
    meaning.add_argument("--default-env", help="environment of rows that have none")
    meaning.add_argument("--carry", action="append", default=[], metavar="NAME[:TYPE]", help="field of an event to take along")
    meaning.add_argument("--extra", metavar="COLUMN", help="column for all fields of an event that the wire schema lacks, as a variant")
    meaning.add_argument("--delay", default="10 minutes", help="how late a row may be for a rollup")
    names = out.add_argument_group("dictionaries")
    names.add_argument("--metric-ids", help="files of (ID, NAME) rows")
    names.add_argument("--jdbc-url", help="database with the metric table, instead of files")
    names.add_argument("--metric-table", default=metadata.METRIC_TABLE)
    names.add_argument("--hierarchy", required=True, help="files of (rowkey, qualifier) rows")
    names.add_argument("--hierarchy-format", default="parquet")
    names.add_argument("--hierarchy-option", action="append", default=[], metavar="KEY=VALUE")
    store = out.add_argument_group("keyed store")
    store.add_argument("--format", default=stores.KEYED_FORMAT)
    store.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="such as table=...")
    store.add_argument("--write-mode", default="overwrite", help="what the format takes to mean upsert")
    store.add_argument("--order", action="append", default=[], help="columns by which the last row of a key is known")
    store.add_argument("--keep", help="event time over which the last write of a key holds across batches, such as '1 day'")
    store.add_argument("--as-json", action="store_true", help="pass rows through JSON texts, without METRIC")
    out.add_argument("--show", type=int, default=0, help="print the first rows of each batch")
    return out


def _pairs(given: Sequence[str], mark: str = "=", other: str | None = None) -> dict[str, str]:
    """KEY=VALUE arguments; without a value they take ``other``, where there is one."""
    out = {}
    for text in given:
        key, found, value = text.partition(mark)
        if not found and other is None:
            raise SystemExit(f"{text!r} is not of the form KEY{mark}VALUE")
        out[key] = value if found else other
    return out


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return messages.file_messages(
            spark, args.files, args.files_schema, args.files_format, args.max_files
        )
    return messages.kafka_messages(
        spark,
        brokers=args.brokers,
        topic=args.topic,
        group=args.group,
        starting=args.starting,
        max_offsets=args.max_offsets,
        min_partitions=args.min_partitions,
    )


def _dictionaries(spark: SparkSession, args: argparse.Namespace, folder: str | None = None) -> Dictionaries:
    if args.jdbc_url:
        ids = metadata.metric_ids_from_jdbc(spark, args.jdbc_url, args.metric_table)
    elif args.metric_ids:
        ids = metadata.metric_ids_from_files(spark, args.metric_ids)
    else:
        raise SystemExit("give --metric-ids or --jdbc-url")
    hierarchy = metadata.hierarchy_from_files(
        spark, args.hierarchy, args.hierarchy_format, **_pairs(args.hierarchy_option)
    )
    return dictionary.resolve(ids, hierarchy, folder or new_dir(spark, "dictionaries"))


def _fresh(spark: SparkSession, args: argparse.Namespace) -> Callable[[], Dictionaries]:
    """Dictionaries read anew for each batch; those of the batch before, which is over, go."""
    held: list[str] = []

    def resolve() -> Dictionaries:
        folder = new_dir(spark, "dictionaries")
        found = _dictionaries(spark, args, folder)
        if held:
            table.remove(spark, held.pop())
        held.append(folder)
        return found

    return resolve


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """Start the query that the arguments describe."""
    if not args.path and args.mode != "store":
        raise SystemExit("give --path")
    if args.mode == "store" and not args.order:
        raise SystemExit("give --order, to know the last row of a key")
    options = rows.Options(
        codec=args.codec,
        zone=args.zone,
        env_key=args.env_key,
        app_key=args.app_key,
        datasources=args.mode not in ("rollup", "open-rollup"),
        default_env=args.default_env,
        require_place=args.mode != "keep-all",
        carry=tuple(_pairs(args.carry, ":", "string").items()),
        extra=args.extra,
    )
    source = _messages(spark, args)
    interval = None if args.interval == "once" else args.interval
    if args.mode == "batches":
        write = jobs.batch_writer(_fresh(spark, args), args.path, options, args.show)
        return jobs.start_batches(source, write, args.checkpoint, interval)
    if args.mode == "store" and args.keep:
        if args.as_json or args.show:
            raise SystemExit("--keep puts rows as they come: leave out --as-json and --show")
        return jobs.start_store(
            source, _dictionaries(spark, args), args.order, args.checkpoint, interval, options, args.keep,
            args.format, args.write_mode, **_pairs(args.option),
        )
    if args.mode == "store":
        write = jobs.store_writer(
            _fresh(spark, args), args.order, options, args.as_json,
            args.format, args.write_mode, args.show, **({"bad": args.bad} if args.bad else {}), **_pairs(args.option),
        )
        return jobs.start_batches(source, write, args.checkpoint, interval)
    begin = {
        "json": jobs.start_row_json,
        "windows": jobs.start_window_rows,
        "rollup": jobs.start_rollup,
        "open-rollup": jobs.start_open_rollup,
    }.get(args.mode, jobs.start_rows)
    if args.bad:
        jobs.start_quarantine(source, args.bad, f"{args.checkpoint}-bad", interval, options)
    late = {"delay": args.delay} if args.mode.endswith("rollup") else {}
    found = _dictionaries(spark, args)
    query = begin(source, found, args.path, args.checkpoint, interval, options, **late)
    if args.show:
        if interval is None:  # the peek takes in what is there, too
            query.awaitTermination()
        jobs.start_peek(spark, args.path, args.show, f"{args.checkpoint}-show", interval)
    return query


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = prepare(SparkSession.builder.appName(args.name).getOrCreate())
    start(spark, args)
    for query in spark.streams.active:
        query.awaitTermination()


if __name__ == "__main__":
    main()
