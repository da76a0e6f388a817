"""Command line for spark-submit: the athlete jobs.

    spark-submit run_job.py batch --landing DIR --lake DIR
    spark-submit --packages <topic connector>,<JDBC driver> --properties-file connections.conf run_job.py stream

Connections come from Spark settings, whose values Spark hides in its logs where the name says password:
spark.tiermill.jdbc.{url,user,password,driver} and spark.tiermill.topic.{servers,user,password}.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tiermill.plans import athlete_jobs
from tiermill.plans.athletes import REPORT
from tiermill.plans.medallion import run_medallion, to_bronze, to_gold, to_silver
from tiermill.sources.jdbc import DEFAULT_DRIVER, JdbcConnection, KeyRange
from tiermill.sources.topics import TopicConnection
from tiermill.streaming.pipelines import PRINTED

SETTINGS = "spark.tiermill"
DATASETS = (REPORT.dimension, REPORT.facts)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Run one of the athlete jobs.")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "silver", "gold", "batch"):
        job = jobs.add_parser(name)
        job.add_argument("--lake", required=True, help="folder of the bronze, silver and gold layers")
        job.add_argument("--show", action="store_true", help="print the first rows of each table")
        job.add_argument("--versions", action="store_true", help="replace layers by complete new versions, not in place")
        if name in ("bronze", "batch"):
            job.add_argument("--landing", required=True, help="folder of the CSV files")
    for name in ("publish", "stream"):
        job = jobs.add_parser(name)
        bounds = ("COLUMN", "LOWER", "UPPER", "PARTS")
        reading = job.add_mutually_exclusive_group(required=True)
        reading.add_argument("--split", nargs=4, metavar=bounds, help="read the table in parts")
        reading.add_argument("--one-task", action="store_true", help="read the table in one task; for small tables")
        if name == "publish":
            job.add_argument("--changes", metavar="DIR", help="send only what changed since the last run, remembered in DIR")
        if name == "stream":
            progress = job.add_mutually_exclusive_group(required=True)
            progress.add_argument("--checkpoint", help="shared folder from which a restart goes on")
            progress.add_argument("--trial", action="store_true", help="keep no progress; a restart begins anew")
            job.add_argument("--max-per-batch", type=int, help="messages per micro-batch")
            held = job.add_mutually_exclusive_group()
            held.add_argument("--hold", type=int, metavar="PARTITIONS", default=athlete_jobs.HELD_PARTITIONS)
            held.add_argument("--fresh", action="store_true", help="read the bios anew in every micro-batch")
            job.add_argument("--hot", nargs="*", default=(), metavar="ATHLETE", help="athletes with very many results")
            following = job.add_argument_group("following", "find hot athletes and changes of the bios while running")
            following.add_argument("--follow", action="store_true", help="needs --checkpoint; keeps a ledger of the sinks")
            following.add_argument("--share", type=float, default=0.02, help="share of the messages that makes an athlete hot")
            following.add_argument("--bio-version", metavar="QUERY", help="subquery whose one row differs when the bios changed")
            job.add_argument("--batch-column", help="column of the output table for the micro-batch number")
    jobs.add_parser("tail").add_argument("--max-per-batch", type=int, default=PRINTED, help="messages per micro-batch")
    return parser


def database(spark: SparkSession) -> JdbcConnection:
    def setting(name: str, default: str | None = None) -> str | None:
        return spark.conf.get(f"{SETTINGS}.jdbc.{name}", default)

    return JdbcConnection(
        spark.conf.get(f"{SETTINGS}.jdbc.url"), setting("user"), setting("password"), setting("driver", DEFAULT_DRIVER)
    )


def broker(spark: SparkSession) -> TopicConnection:
    def setting(name: str) -> str | None:
        return spark.conf.get(f"{SETTINGS}.topic.{name}", None)

    return TopicConnection(spark.conf.get(f"{SETTINGS}.topic.servers"), setting("user"), setting("password"))


def main(argv: list[str] | None = None) -> None:
    parser = arguments()
    args = parser.parse_args(argv)
    if getattr(args, "follow", False) and (args.trial or args.fresh or args.hot):
        parser.error("--follow needs --checkpoint and finds hot athletes itself; it takes no --trial, --fresh or --hot")
    spark = SparkSession.builder.appName(f"athletes-{args.job}").getOrCreate()
    split = None
    if getattr(args, "split", None):
        column, lower, upper, parts = args.split
        split = KeyRange(column, lower, upper, int(parts))
    if args.job == "bronze":
        to_bronze(spark, args.landing, args.lake, DATASETS, args.show, args.versions)
    elif args.job == "silver":
        to_silver(spark, args.lake, DATASETS, args.show, args.versions)
    elif args.job == "gold":
        to_gold(spark, args.lake, REPORT, show=args.show, versioned=args.versions)
    elif args.job == "batch":
        run_medallion(spark, args.landing, args.lake, REPORT, show=args.show, versioned=args.versions)
    elif args.job == "publish":
        state = [args.changes] if args.changes else []
        athlete_jobs.publish_results(spark, database(spark), broker(spark), split, *state)
    elif args.job == "stream" and args.follow:
        athlete_jobs.follow_results(
            spark,
            database(spark),
            broker(spark),
            args.checkpoint,
            split,
            args.max_per_batch,
            args.hold,
            args.share,
            args.bio_version,
            args.batch_column,
        ).awaitTermination()
    elif args.job == "stream":
        query = athlete_jobs.stream_results(
            spark,
            database(spark),
            broker(spark),
            args.checkpoint,
            split,
            args.max_per_batch,
            None if args.fresh else args.hold,
            args.hot,
            args.batch_column,
        )
        query.awaitTermination()
    else:
        athlete_jobs.tail_output(spark, broker(spark), args.max_per_batch).awaitTermination()


if __name__ == "__main__":
    main()
