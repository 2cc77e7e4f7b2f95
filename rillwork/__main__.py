"""Run a job on files: ``python -m rillwork JOB ...`` or through ``spark-submit``.

The session is the one the cluster gives; shared intermediate data goes to the
folder named in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.operators import history, logs, sessions, timeseries
from rillwork.plans import all_queries
from rillwork.plans.registry import Tables
from rillwork.sources import files

# Layouts of the input files.
PRICE_COLUMNS = "stockId INT, timeStamp INT, stockPrice STRING"
INFO_COLUMNS = "stockId INT, stockName STRING, stockCategory STRING"
CHANGE_COLUMNS = "prodid INT, lastupdatedate STRING, indicator STRING"
CLICK_COLUMNS = ("click_time", "user_id")


def moving_average(spark: SparkSession, args) -> DataFrame:
    """Moving average of prices per stock, with the stock's info where given."""
    prices = timeseries.readable(files.read_csv(spark, args.prices, PRICE_COLUMNS), "stockPrice")
    if args.key is not None:
        prices = prices.filter(F.col("stockId") == args.key)
    averages = timeseries.moving_average(prices, "stockId", ["timeStamp"], "stockPrice", args.size)
    if args.info is None:
        return averages
    info = files.read_csv(spark, args.info, INFO_COLUMNS)
    return timeseries.moving_average_with(averages, info, "stockId", "stockId", ["stockName", "stockCategory"])


def clicks(spark: SparkSession, args) -> DataFrame:
    """Tab-separated clicks with their session."""
    read = files.read_fields(spark, args.clicks, CLICK_COLUMNS)
    timed = read.withColumn("click_time", F.col("click_time").try_cast("timestamp"))
    # Clicks of one user at one time are alike, so any order among them will do.
    tied = timed.withColumn("tie", F.lit(0))
    return sessions.sessionize(tied, "user_id", "click_time", "tie", args.idle, args.cap).drop("tie")


def merge(spark: SparkSession, args) -> DataFrame:
    """Base table and changes as a history."""
    base, changes = (files.read_csv(spark, p, CHANGE_COLUMNS) for p in (args.base, args.changes))
    return history.merge_history(base, changes, "prodid", "lastupdatedate", "indicator")


def log_report(spark: SparkSession, args) -> DataFrame:
    """Share of each API in a load-balancer log."""
    return logs.api_share(logs.balancer_log(files.read_lines(spark, args.lines)))


def registered(spark: SparkSession, args) -> DataFrame:
    """A registered query over a folder of tables."""
    return all_queries()[args.name].run(Tables(spark, args.tables))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rillwork", description=__doc__)
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *inputs: str):
        one = jobs.add_parser(name, help=run.__doc__)
        for given in inputs:
            one.add_argument(given)
        one.add_argument("output", help="folder for the result as CSV")
        one.add_argument("--one-file", action="store_true", help="a single file, for small results")
        one.set_defaults(run=run)
        return one

    average = job("moving-average", moving_average, "prices")
    average.add_argument("--size", type=int, default=3)
    average.add_argument("--info")
    average.add_argument("--key", type=int)
    session = job("sessions", clicks, "clicks")
    session.add_argument("--idle", type=int, default=60 * 60)
    session.add_argument("--cap", type=int, default=2 * 60 * 60)
    job("merge-history", merge, "base", "changes")
    job("log-report", log_report, "lines")
    job("query", registered, "name", "tables")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("rillwork").getOrCreate()
    files.write_csv(args.run(spark, args), args.output, one_file=args.one_file)


if __name__ == "__main__":
    main()
