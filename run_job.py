"""Command line of the lake jobs, for spark-submit.

    spark-submit run_job.py observations --lake hdfs:///lake --sources live
    spark-submit run_job.py business --lake hdfs:///lake --scope live
"""

from __future__ import annotations

import argparse
from datetime import date

from wxlake.plans import lake as jobs
from wxlake.session import build_session
from wxlake.streaming import live


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    steps = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        step = steps.add_parser(name, help=text)
        step.add_argument("--lake", required=True, help="root folder of the lake")
        return step

    step = job("observations", "raw daily files and live messages to observations")
    step.add_argument("--sources", default="all", choices=["all", *jobs.SOURCES])
    step.add_argument("--start", type=date.fromisoformat)
    step.add_argument("--end", type=date.fromisoformat)
    step.add_argument("--complete-only", action="store_true")
    for name in ("hourly", "grid"):
        job(name, f"raw {name} files to their table").add_argument(
            "--complete-only", action="store_true"
        )
    job("alerts", "raw alert maps to their table")
    step = job("business", "index, rankings, runs, live status")
    step.add_argument("--scope", default="full", choices=["live", "full"])
    step.add_argument("--since", type=date.fromisoformat, help="first day that changed, for the live status")
    step.add_argument("--renormalise-missing", action="store_true")
    step.add_argument("--max-elevation", type=float, default=jobs.Limits.max_elevation)
    job("grid-index", "index per cell").add_argument("--years", default="")
    step = job("comparison", "live against official, runs against alerts")
    step.add_argument("--max-elevation", type=float, default=jobs.Limits.max_elevation)
    step.add_argument("--min-hours", type=int, default=jobs.Limits.min_hours)
    step.add_argument("--min-points", type=int, default=jobs.Limits.min_points)
    step.add_argument("--archive-start", default=jobs.Limits.archive_start)
    job("report", "samples and counts of the tables")
    streams = {
        "landing": "stream of messages to the raw layer",
        "live-table": "stream of messages to the newest row of each city",
        "live-changes": "stream of messages to a log of the cities that change",
        "publish": "a business table to a topic",
    }
    for name, text in streams.items():
        step = job(name, text)
        step.add_argument("--servers", required=True)
        step.add_argument("--topic", required=True)
    step.add_argument("--table", default="live_status")
    return parser.parse_args(argv)


STREAMS = {"landing": jobs.start_landing, "live-table": jobs.start_live_table, "live-changes": jobs.start_live_changes}


def run(spark, args: argparse.Namespace) -> None:
    lake = jobs.Lake(args.lake)
    if args.job == "observations":
        sources = jobs.SOURCES if args.sources == "all" else (args.sources,)
        print(jobs.build_observations(spark, lake, sources, args.start, args.end, args.complete_only), "rows")
    elif args.job == "hourly":
        print(jobs.build_hourly(spark, lake, args.complete_only), "rows")
    elif args.job == "grid":
        print(jobs.build_grid(spark, lake, args.complete_only), "rows")
    elif args.job == "alerts":
        print(jobs.build_alerts(spark, lake), "rows")
    elif args.job in STREAMS:
        messages = live.kafka_source(spark, args.servers, args.topic)
        STREAMS[args.job](lake, messages).awaitTermination()
    elif args.job == "publish":
        live.publish(spark.read.parquet(lake.business(args.table)), args.servers, args.topic)
    elif args.job == "report":
        tables = {**jobs.layer_report(spark, lake), **jobs.business_report(spark, lake)}
        for title, table in tables.items():
            print(title)
            table.show(truncate=False)
    else:
        given = {k: v for k, v in vars(args).items() if k in jobs.Limits.__dataclass_fields__}
        limits = jobs.Limits(**given)
        built = {
            "business": lambda: jobs.build_business_tables(
                spark, lake, args.scope, limits, renormalise_missing=args.renormalise_missing, since=args.since),
            "grid-index": lambda: jobs.build_grid_tables(spark, lake, args.years),
            "comparison": lambda: jobs.build_comparison(spark, lake, limits),
        }[args.job]()
        jobs.table_counts(spark, lake, built).show(truncate=False)


if __name__ == "__main__":
    given = arguments()
    run(build_session(f"wxlake-{given.job}"), given)
