"""Jobs for spark-submit: ``python -m barloom.jobs JOB ...``.

    ingest-history FILES TABLE [--kind stock|index] [--cutoff DATE] [--keep-copies]
    ingest-today DATE [--stock-files F --stock-table T] [--index-files F --index-table T]
    backfill BARS INDICATORS
    refresh BARS INDICATORS STATE
    daily BARS INDICATORS DATE [--state STATE]
    stream-ingest FILES TABLE CHECKPOINT
    stream-indicators BARS INDICATORS CHECKPOINT

Paths are those of the cluster's shared stores. The session is the one that spark-submit sets up; run
alone, a local one.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date

from pyspark import SparkConf
from pyspark.sql import SparkSession

from barloom.plans.incremental import ingest_history, ingest_today, run_backfill, run_daily, run_refresh
from barloom.session import local_session
from barloom.streaming.jobs import stream_indicators, stream_ingest


def _day(text: str) -> date:
    return date.fromisoformat(text)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="python -m barloom.jobs", description="Keeps bar and indicator tables up to date.")
    jobs = out.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        made = jobs.add_parser(name)
        for path in paths:
            made.add_argument(path)
        return made

    history = job("ingest-history", "files", "table")
    history.add_argument("--kind", choices=("stock", "index"), default="stock")
    history.add_argument("--cutoff", type=_day, help="leave out dates up to this one")
    history.add_argument("--keep-copies", action="store_true", help="load deliveries that repeat another one, too")
    today = job("ingest-today")
    today.add_argument("date", type=_day)
    for kind in ("stock", "index"):
        today.add_argument(f"--{kind}-files")
        today.add_argument(f"--{kind}-table")
    job("backfill", "bars", "indicators")
    job("refresh", "bars", "indicators", "state")
    daily = job("daily", "bars", "indicators")
    daily.add_argument("date", type=_day)
    daily.add_argument("--state", help="go on from the states stored here")
    job("stream-ingest", "files", "table", "checkpoint")
    job("stream-indicators", "bars", "indicators", "checkpoint")
    return out


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Runs a job to its end."""
    if args.job == "ingest-history":
        ingest_history(spark, args.files, args.table, args.kind, args.cutoff, not args.keep_copies)
    elif args.job == "ingest-today":
        for kind in ("stock", "index"):
            if (getattr(args, f"{kind}_files") is None) != (getattr(args, f"{kind}_table") is None):
                raise ValueError(f"{kind} files need a table and the other way round")
        ingest_today(spark, args.date, args.stock_files, args.stock_table, args.index_files, args.index_table)
    elif args.job == "backfill":
        run_backfill(spark, args.bars, args.indicators)
    elif args.job == "refresh":
        run_refresh(spark, args.bars, args.indicators, args.state)
    elif args.job == "daily":
        run_daily(spark, args.bars, args.indicators, args.date, args.state)
    elif args.job == "stream-ingest":
        stream_ingest(spark, args.files, args.table, args.checkpoint).awaitTermination()
    else:
        stream_indicators(spark, args.bars, args.indicators, args.checkpoint).awaitTermination()


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    # spark-submit names the master; without one the job runs on this machine.
    submitted = SparkSession.getActiveSession() is not None or SparkConf().contains("spark.master")
    spark = SparkSession.builder.getOrCreate() if submitted else local_session()
    run(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
