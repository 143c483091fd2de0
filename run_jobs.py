"""Command line of the jobs, for spark-submit.

    spark-submit run_jobs.py ingest --raw RAW --logs LOGS
    spark-submit run_jobs.py reputation|volume|attacks|scans|timeline|all --logs LOGS --results RESULTS
    spark-submit run_jobs.py serving --results RESULTS --serving SERVING [--previous EARLIER]
"""

import argparse

from pyspark.sql import SparkSession

from logvigil.plans.jobs import ANALYSES, ingest, load_serving
from logvigil.sources import read_logs

#: Rows of a table that are printed; what is longer is stored as a whole and said to be longer.
SHOWN = 50


def _arguments():
    parser = argparse.ArgumentParser(description="Jobs over security logs")
    jobs = parser.add_subparsers(dest="job", required=True)
    logs = argparse.ArgumentParser(add_help=False)
    logs.add_argument("--logs", required=True, help="root of the day folders")
    logs.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    logs.add_argument(
        "--quoted-newlines", action="store_true", help="fields of the CSV logs hold newlines: one task a file"
    )
    job = jobs.add_parser("ingest", parents=[logs], help="split raw CSV by date")
    job.add_argument("--raw", required=True)
    job.add_argument("--reports", help="folder for the inventory and the summary")
    job.add_argument(
        "--split-files", action="store_true", help="no field holds a newline and all headers are alike"
    )
    job.add_argument(
        "--in-time-order", action="store_true", help="the input is sorted by time: do not shuffle"
    )
    for name in (*ANALYSES, "all"):
        job = jobs.add_parser(name, parents=[logs])
        job.add_argument("--results", required=True)
    job = jobs.add_parser("serving", help="load the serving tables")
    job.add_argument("--results", required=True)
    job.add_argument("--serving", required=True)
    job.add_argument("--previous", help="earlier serving tables to put the new cells over")
    return parser.parse_args()


def _show(name, result):
    if result.rows:
        print(f"{name}: {result.rows}")
    if result.advice:
        print(f"{name}: {result.advice}")
    if result.counters:
        print(f"{name}: {result.counters}")
    for title, table in result.tables.items():
        rows = table.count()
        print(title if rows <= SHOWN else f"{title}: the first {SHOWN} of {rows} rows; all are stored")
        table.show(SHOWN, truncate=False)


def main():
    arguments = _arguments()
    spark = SparkSession.builder.appName(f"logvigil {arguments.job}").getOrCreate()
    if arguments.job == "ingest":
        result = ingest(
            spark,
            arguments.raw,
            arguments.logs,
            arguments.format,
            arguments.in_time_order,
            quoted_newlines=False if arguments.split_files else None,
            reports_root=arguments.reports,
        )
        _show("ingest", result)
    elif arguments.job == "serving":
        result = load_serving(spark, arguments.results, arguments.serving, arguments.previous)
        _show("serving", result)
    else:
        logs = read_logs(spark, arguments.logs, arguments.format, arguments.quoted_newlines)
        names = ANALYSES if arguments.job == "all" else [arguments.job]
        for name in names:
            _show(name, ANALYSES[name](spark, logs, arguments.results))
    spark.stop()


if __name__ == "__main__":
    main()
