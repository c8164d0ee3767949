"""Command line of the jobs, for ``spark-submit`` or ``python -m linewatch``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from linewatch.operators.riders import PENDING_DAYS
from linewatch.plans import jobs
from linewatch.session import build_session
from linewatch.sources.lookups import RIDER_TABLE, read_riders_jdbc
from linewatch.sources.topics import MAX_OFFSETS_PER_TRIGGER, Sasl, kafka_options, read_topic

TOPICS = ("rail", "weather", "forecast")


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="linewatch", description="Rail-disruption analytics jobs")
    parser.add_argument("--database", required=True, help="database of all tables")
    parser.add_argument("--lookups", default="", help="folder of the station and route files")
    parser.add_argument("--checkpoints", default="", help="folder of the stream checkpoints")
    steps = parser.add_subparsers(dest="step", required=True)

    bronze = steps.add_parser("bronze", help="drain the topics")
    bronze.add_argument("--bootstrap", required=True)
    for topic in TOPICS:
        bronze.add_argument(f"--{topic}-topic")
    bronze.add_argument("--starting", default="earliest")
    bronze.add_argument("--max-offsets", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="per micro-batch, 0 for no limit")
    bronze.add_argument("--skip-lost", action="store_true", help="go on when the broker has lost records")
    bronze.add_argument("--protocol", default="SASL_SSL")
    bronze.add_argument("--mechanism", default="PLAIN")
    bronze.add_argument("--key", default="")
    bronze.add_argument("--secret", default="")
    bronze.add_argument("--secret-conf", help="session setting that holds the secret, which stays out of the process list")

    silver = steps.add_parser("silver", help="clean what is new in bronze")
    silver.add_argument("--everything", action="store_true", help="read all of bronze again")

    gold = steps.add_parser("gold", help="enrich, measure, collect alerts")
    gold.add_argument("--since", type=date.fromisoformat, help="first day to work on")
    gold.add_argument("--changes", action="store_true", help="only the days that silver has changed since the last such run")

    cluster = steps.add_parser("cluster", help="rewrite settled days in curve order")
    cluster.add_argument("--day", type=date.fromisoformat, action="append", help="a day to rewrite; all without one")

    riders = steps.add_parser("riders", help="refresh the preference snapshot")
    riders.add_argument("--url", required=True, help="JDBC address")
    riders.add_argument("--table", default=RIDER_TABLE)
    riders.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option, such as partitionColumn, lowerBound, upperBound, numPartitions, driver or user")
    riders.add_argument("--password-conf", help="session setting that holds the password")

    deliveries = steps.add_parser("deliveries", help="log delivery results and mark their alerts")
    deliveries.add_argument("--results", required=True, help="table with notification_id and delivered")
    deliveries.add_argument("--since", type=date.fromisoformat, help="first day of notifications to look at")
    deliveries.add_argument("--final", action="store_true", help="what has no result yet has failed")

    dispatch = steps.add_parser("dispatch", help="draft pending notifications")
    dispatch.add_argument("--lookback-days", type=int, default=PENDING_DAYS)
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    at = jobs.Layout(args.database, args.lookups, args.checkpoints)
    jobs.create_tables(spark, at)
    if args.step == "bronze":
        secret = spark.conf.get(args.secret_conf) if args.secret_conf else args.secret
        sasl = Sasl(args.key, secret, args.protocol, args.mechanism)
        topics = {
            f"{t}_bronze": read_topic(
                spark, kafka_options(args.bootstrap, name, args.starting, args.max_offsets or None, sasl, not args.skip_lost)
            )
            for t in TOPICS
            if (name := getattr(args, f"{t}_topic"))
        }
        jobs.run_bronze(spark, at, topics)
    elif args.step == "silver":
        (jobs.run_silver if args.everything else jobs.stream_silver)(spark, at)
    elif args.step == "gold":
        if args.changes:
            jobs.run_gold_changes(spark, at)
        else:
            jobs.run_gold(spark, at, args.since)
    elif args.step == "cluster":
        jobs.run_clustering(spark, at, set(args.day) if args.day else None)
    elif args.step == "riders":
        options = dict(o.split("=", 1) for o in args.option)
        if args.password_conf:
            options["password"] = spark.conf.get(args.password_conf)
        jobs.run_riders(spark, at, read_riders_jdbc(spark, args.url, args.table, **options))
    elif args.step == "deliveries":
        jobs.record_deliveries(spark, at, spark.table(args.results), args.final, args.since)
    else:
        jobs.run_dispatch(spark, at, lookback_days=args.lookback_days)


if __name__ == "__main__":
    options = arguments()
    run(build_session(f"linewatch-{options.step}"), options)
