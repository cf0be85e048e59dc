"""The daily job for spark-submit: take in new price files, log the run, stop."""

import argparse
import datetime
import json
import sys

from pyspark.sql import SparkSession

from barloom.schemas import CSV_HEADER
from barloom.streaming.daily_ingest import read_runs, run_daily


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--landing", required=True, help="folder of fetch_date=/symbol=/*.csv")
    parser.add_argument("--store", required=True, help="folder of the history and the run table")
    parser.add_argument("--run-date", required=True, type=datetime.date.fromisoformat)
    parser.add_argument("--max-files", type=int, help="files per batch (default: all in one)")
    parser.add_argument("--period", choices=["year", "month"], default="year")
    parser.add_argument("--header", action="append", help="header line of the files; may be given several times")
    parser.add_argument("--by-name", action="store_true", help="find each file's columns by its own header, in any order")
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("daily prices").getOrCreate()
    run_id = run_daily(
        spark, given.landing, given.store, given.run_date, given.max_files, given.period,
        tuple(given.header or [CSV_HEADER]), given.by_name,
    )
    run = read_runs(spark, given.store).where(f"run_id = '{run_id}'").first()
    print(json.dumps(run.asDict(), default=str))
    return 1 if run.status == "failed" else 0


if __name__ == "__main__":
    sys.exit(main())
