"""Programs for spark-submit.

    spark-submit --py-files podium.zip podium/jobs.py medallion --landing ... --root ...

Master, memory, connector and driver packages are given to spark-submit.
Database passwords come from the environment variable ``PODIUM_DB_PASSWORD``.
"""

import argparse
import os
import sys
import threading
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from podium.operators.ledger import FRESH_SECONDS, is_fresh
from podium.plans import (
    bronze_to_silver,
    consume_epochs,
    consume_topic,
    enrich_epochs,
    enrich_stream,
    landing_to_bronze,
    publish_table,
    record_medal_count,
    record_medal_count_jdbc,
    run_medallion,
    silver_to_gold,
)
from podium.sources import read_jdbc, read_topic
from podium.sources.jdbc import PARTITION_COLUMN, RESULT_COLUMN
from podium.sources.topic import MAX_OFFSETS_PER_TRIGGER
from podium.streaming import FeedWatch, Stop, to_console, to_jdbc, to_table, to_topic

PASSWORD = "PODIUM_DB_PASSWORD"


def database(args: argparse.Namespace, table: str) -> dict[str, str]:
    """Arguments of ``read_jdbc`` and ``write_jdbc`` for a table."""
    return {
        "url": args.url,
        "table": table,
        "driver": args.driver,
        "user": args.user,
        "password": os.environ.get(PASSWORD),
    }


def table(
    spark: SparkSession, args: argparse.Namespace, name: str, column: str | None
) -> DataFrame:
    """A table of the database, or Parquet files where no database is given.

    It is read in ranges of the column that was asked for, or else of ``column``.
    """
    if args.url is None:
        return spark.read.parquet(name)
    return read_jdbc(
        spark,
        **database(args, name),
        partition_column=args.partition_column or column,
        num_partitions=args.num_partitions,
        equal_counts=args.equal_counts,
    )


def options(args: argparse.Namespace) -> dict[str, str]:
    """Connector options, given as ``--option key=value``."""
    return dict(pair.split("=", 1) for pair in args.option)


def servers(args: argparse.Namespace) -> list[str]:
    return args.servers.split(",") if args.servers else []


def run_landing(spark, args):
    schemas = dict(pair.split("=", 1) for pair in args.schema)
    landing_to_bronze(
        spark, args.landing, args.root, schemas=schemas, preview_rows=args.preview
    )


def run_silver(spark, args):
    bronze_to_silver(spark, args.root, preview_rows=args.preview)


def run_gold(spark, args):
    silver_to_gold(spark, args.root, preview_rows=args.preview)


def run_layers(spark, args):
    schemas = dict(pair.split("=", 1) for pair in args.schema)
    run_medallion(
        spark, args.landing, args.root, schemas=schemas, preview_rows=args.preview
    )


def run_publish(spark, args):
    publish_table(
        table(spark, args, args.table, RESULT_COLUMN),
        args.topic,
        servers(args),
        args.format,
        preview_rows=args.preview,
        **options(args),
    )


def waited(spark, args, query_of, fail_on_data_loss: bool) -> None:
    """Start a query and wait for its end, for a signal or for the marker file."""
    stop = Stop(args.stop_file)
    main_thread = threading.current_thread() is threading.main_thread()
    with stop.on_signals() if main_thread else nullcontext():
        query = query_of(stop)
        with FeedWatch(spark, query, args.checkpoint, fail_on_data_loss) as watch:
            stop.wait(query, spark)
    print(f"messages read: {watch.read}, lost: {watch.lost}, files gone: {len(watch.missing)}")


def run_enrich(spark, args):
    sinks = []
    if args.out_topic:
        told = {
            "epoch_column": args.epoch_column,
            "rows_column": args.rows_column,
            "log": args.log and f"{args.log}/topic",
        }
        sinks.append(
            to_topic(args.out_topic, servers(args), args.format, **told, **options(args))
        )
    if args.out_table and args.url:
        access = database(args, args.out_table)
        log = args.log and f"{args.log}/table"
        sinks.append(to_jdbc(**access, epoch_column=args.epoch_column, log=log))
    elif args.out_table:
        sinks.append(to_table(args.out_table, args.snapshot))
    messages = read_topic(
        spark,
        args.topic,
        servers(args),
        args.format,
        args.max_per_trigger,
        **options(args),
    )
    given = {
        "unwrap": args.unwrap,
        "country_from": args.country_from,
        "drop_missing": not args.keep_missing,
        "available_now": args.available_now,
        "together": args.together,
    }

    def started(stop: Stop):
        if args.anew:
            if args.console:
                sinks.insert(0, to_console())
            return enrich_epochs(
                messages,
                lambda: table(spark, args, args.bio, PARTITION_COLUMN),
                sinks,
                args.checkpoint,
                stop=stop,
                **given,
            )
        return enrich_stream(
            messages,
            table(spark, args, args.bio, PARTITION_COLUMN),
            sinks,
            args.checkpoint,
            console=args.console,
            stop=stop,
            **given,
        )

    waited(spark, args, started, fail_on_data_loss=True)


def run_consume(spark, args):
    messages = read_topic(
        spark,
        args.topic,
        servers(args),
        args.format,
        args.max_per_trigger,
        fail_on_data_loss=False,
        **options(args),
    )

    def started(stop: Stop):
        if args.last_epoch:
            return consume_epochs(
                messages, args.path, args.checkpoint, unwrap=args.unwrap, stop=stop
            )
        return consume_topic(
            messages, unwrap=args.unwrap, path=args.path, checkpoint=args.checkpoint, stop=stop
        )

    waited(spark, args, started, fail_on_data_loss=False)


def run_ledger(spark, args):
    pairs = [tuple(pair.split("=", 1)) for pair in args.pair]
    if args.url is None:
        results = table(spark, args, args.table, RESULT_COLUMN)
        if args.catalog:
            fresh = record_medal_count(results, pairs, table=args.ledger)
        else:
            fresh = record_medal_count(results, pairs, path=args.ledger)
    else:
        fresh = record_medal_count_jdbc(
            spark, pairs, database(args, args.table), database(args, args.ledger)
        )
    print("fresh" if fresh else "stale")


def run_check(spark, args):
    args.partition_column = None
    entries = spark.table(args.ledger) if args.catalog else table(spark, args, args.ledger, None)
    fresh = is_fresh(entries, args.seconds)
    print("fresh" if fresh else "stale")
    return 0 if fresh else 1


def parser() -> argparse.ArgumentParser:
    layers = argparse.ArgumentParser(add_help=False)
    layers.add_argument("--root", required=True, help="folder of the layers")
    layers.add_argument("--preview", type=int, default=0, help="rows to print")

    landing = argparse.ArgumentParser(add_help=False)
    landing.add_argument("--landing", required=True, help="folder of the CSV files")
    landing.add_argument(
        "--schema", action="append", default=[], help="table=DDL; saves the inference pass"
    )

    db = argparse.ArgumentParser(add_help=False)
    db.add_argument("--url", help="JDBC URL; without it, tables are Parquet paths")
    db.add_argument("--driver")
    db.add_argument("--user")
    db.add_argument("--partition-column", help="key in whose ranges a table is read")
    db.add_argument("--num-partitions", type=int, help="ranges; as many as cores without it")

    db.add_argument(
        "--equal-counts", action="store_true", help="ranges of equally many rows, not of equal width"
    )

    stoppable = argparse.ArgumentParser(add_help=False)
    stoppable.add_argument("--stop-file", help="ends the stream between epochs once it is there")

    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--topic", required=True)
    topic.add_argument("--servers", help="brokers, separated by commas")
    topic.add_argument("--format", default="kafka", choices=["kafka", "text", "parquet"])
    topic.add_argument(
        "--option", action="append", default=[], help="key=value for the connector"
    )

    commands = argparse.ArgumentParser(prog="podium")
    sub = commands.add_subparsers(required=True, dest="command")

    def add(name, run, *parents):
        command = sub.add_parser(name, parents=parents)
        command.set_defaults(run=run)
        return command

    add("landing-to-bronze", run_landing, landing, layers)
    add("bronze-to-silver", run_silver, layers)
    add("silver-to-gold", run_gold, layers)
    add("medallion", run_layers, landing, layers)

    publish = add("publish", run_publish, db, topic)
    publish.add_argument("--table", required=True)
    publish.add_argument("--preview", type=int, default=0)

    enrich = add("enrich", run_enrich, db, topic, stoppable)
    enrich.add_argument("--bio", required=True, help="table of biographies")
    enrich.add_argument("--checkpoint", required=True)
    enrich.add_argument("--out-topic")
    enrich.add_argument("--out-table")
    enrich.add_argument("--epoch-column", help="adds the epoch's number under this name")
    enrich.add_argument("--rows-column", help="adds the epoch's number of rows under this name")
    enrich.add_argument("--log", help="folder that notes the epochs written, so none is repeated")
    enrich.add_argument("--together", action="store_true", help="write the sinks at the same time")
    enrich.add_argument(
        "--anew", action="store_true", help="read the biographies anew in each epoch"
    )
    enrich.add_argument("--snapshot", default="append", choices=["append", "replace"])
    enrich.add_argument("--country-from", default="bio", choices=["bio", "event"])
    enrich.add_argument("--keep-missing", action="store_true")
    enrich.add_argument("--max-per-trigger", type=int)
    enrich.add_argument("--available-now", action="store_true")
    enrich.add_argument("--unwrap", action="store_true")
    enrich.add_argument("--console", action="store_true")

    consume = add("consume", run_consume, topic, stoppable)
    consume.add_argument(
        "--last-epoch", action="store_true", help="keep the last whole result at --path"
    )
    consume.add_argument("--max-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    consume.add_argument("--unwrap", action="store_true")
    consume.add_argument("--path", help="Parquet to write; the console without it")
    consume.add_argument("--checkpoint")

    ledger = add("ledger", run_ledger, db)
    ledger.add_argument("--table", required=True, help="table of results")
    ledger.add_argument("--ledger", required=True)
    ledger.add_argument("--catalog", action="store_true", help="the ledger is a catalog table")
    ledger.add_argument("--pair", action="append", required=True, help="label=medal")

    check = add("ledger-check", run_check, db)
    check.add_argument("--ledger", required=True)
    check.add_argument("--catalog", action="store_true", help="the ledger is a catalog table")
    check.add_argument("--seconds", type=int, default=FRESH_SECONDS)
    return commands


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"podium {args.command}").getOrCreate()
    return args.run(spark, args) or 0


if __name__ == "__main__":
    sys.exit(main())
