"""Run the jobs with spark-submit or ``python -m martloom``.

    extract    --database raw --zone <folder> --as-of 2025-10-22 [--jdbc-url <url>]
    sales      --zone <folder> --as-of 2025-10-22 --mart <folder>
    marketing  --zone <folder> --as-of 2025-10-22 --mart <folder>
    publish    --mart <sales folder> --marketing-mart <marketing folder>

``extract`` reads all tables of a database of the session. With ``--jdbc-url`` it
reads all base tables of that schema of a relational database instead, in ranges
of a key. The database's user, password and driver come from
``spark.martloom.jdbc.user``, ``.password`` and ``.driver``, or from
``MARTLOOM_JDBC_USER``, ``_PASSWORD`` and ``_DRIVER``. It ends with 1 if a table failed.

``sales`` and ``marketing`` look at the zone first and name every table that is
missing or was not written to its end. A CSV zone is read once: its tables are staged as
columnar files, and beside the mart remain ``_load_report``, rows and nulls of each column,
and ``_quarantine``, every cell that did not parse, with its line and file. From a Parquet
zone only the columns that the mart needs are read, and those that must not be null for
the report.

With ``--versioned`` mart tables are written as versions (``martloom.versions``): those
before stay readable until, and after, new ones are complete.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping
from dataclasses import fields
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.labels import SegmentThresholds
from martloom.plans.extract import extract_snapshot
from martloom.plans.marts import MARKETING_INPUTS, SALES_INPUTS, build_marketing_mart, build_sales_mart
from martloom.plans.shared import release_shared, shared_path
from martloom.schemas import MARKETING_MART, ROW_KEYS, SALES_MART
from martloom.sinks import publish
from martloom.sources.manifest import require_whole
from martloom.sources.readers import list_jdbc_tables, load_snapshot, null_report, read_jdbc_split
from martloom.sources.snapshots import CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY, find_snapshot, list_tables
from martloom.sources.staging import quarantine, stage_snapshot, staging_report
from martloom.versions import publish_versions


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="martloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    extract = jobs.add_parser("extract", help="write the raw snapshot of a day")
    extract.add_argument("--database", required=True)
    extract.add_argument("--keep-older", action="store_true")
    extract.add_argument("--jdbc-url")
    extract.add_argument("--partitions", type=int, default=10_000, help="most ranges of one database table")
    extract.add_argument("--rows-per-partition", type=int, default=1_000_000)
    extract.add_argument("--file-format", choices=("csv", "parquet"), default="csv")
    extract.add_argument("--manifest", action="store_true", help="list what each file holds, for --verify")
    extract.add_argument("--first-day", type=date.fromisoformat, default=CALENDAR_FIRST_DAY)
    extract.add_argument("--last-day", type=date.fromisoformat, default=CALENDAR_LAST_DAY)

    sales = jobs.add_parser("sales", help="build the sales mart from a snapshot")
    sales.add_argument("--week-rule", choices=("shifted_iso", "sunday"), default="shifted_iso")
    sales.add_argument("--pre-aggregate", action="store_true", help="sum sales and stock before they meet")
    sales.add_argument("--match-week-start", action="store_true", help="match returns by the week's first day too")

    marketing = jobs.add_parser("marketing", help="build the marketing mart from a snapshot")
    marketing.add_argument("--churn-days", type=int, default=300)
    marketing.add_argument("--partition-daily-by-year", action="store_true")
    marketing.add_argument("--order-key", nargs="+", default=["order_number"])
    for limit in fields(SegmentThresholds):
        marketing.add_argument(
            f"--{limit.name.replace('_', '-')}", type=type(limit.default), default=limit.default
        )

    for job in (sales, marketing):
        job.add_argument("--mart", required=True, help="folder of the mart tables")
        job.add_argument("--max-null-keys", type=int, help="fail if a column that must not be null has more nulls")
        job.add_argument("--max-rejected-rows", type=int, help="fail if a CSV table has more rows that do not parse")
        job.add_argument("--verify", action="store_true", help="compare all files with their manifests first")
        job.add_argument("--versioned", action="store_true", help="write mart tables as versions")
    for job in (extract, sales, marketing):
        job.add_argument("--zone", required=True, help="folder of the raw snapshots")
        job.add_argument("--as-of", required=True, type=date.fromisoformat)

    publishing = jobs.add_parser("publish", help="make the mart tables available to SQL")
    publishing.add_argument("--mart", required=True)
    publishing.add_argument("--marketing-mart", required=True)
    publishing.add_argument("--versioned", action="store_true", help="the marts were written with --versioned")
    publishing.add_argument("--version", type=int, help="version of all tables; negative counts from the latest")
    return parser.parse_args(argv)


def _sources(spark: SparkSession, args: argparse.Namespace) -> dict:
    if not args.jdbc_url:
        names = list_tables(spark, args.database)
        return {name: partial(spark.table, f"{args.database}.{name}") for name in names}
    names = list_jdbc_tables(spark, args.jdbc_url, args.database)
    read = partial(read_jdbc_split, spark, args.jdbc_url)
    return {n: partial(read, f"{args.database}.{n}", args.partitions, args.rows_per_partition) for n in names}


def _load(spark: SparkSession, paths: Mapping[str, str], args: argparse.Namespace) -> dict[str, DataFrame]:
    """The raw frames of a snapshot; leaves the load report and quarantine, stops on too many nulls or rejects."""
    mart = args.mart.rstrip("/")
    if all(path.endswith(".csv") for path in paths.values()):
        folder = shared_path(spark, "staged")
        raw, staged = stage_snapshot(spark, paths, folder)
        report = staging_report(spark, staged)
        quarantine(spark, folder, paths).write.mode("overwrite").parquet(f"{mart}/_quarantine")
    else:
        raw = load_snapshot(spark, paths)
        keys = [null_report(df.select(*ROW_KEYS[name])).withColumn("table_name", F.lit(name)) for name, df in raw.items()]
        report = reduce(DataFrame.unionByName, keys).withColumn("rejected_rows", F.lit(None).cast("long"))
    report.write.mode("overwrite").parquet(f"{mart}/_load_report")
    stored = spark.read.parquet(f"{mart}/_load_report")
    required = F.struct("table_name", "column").isin([F.struct(F.lit(t), F.lit(c)) for t in raw for c in ROW_KEYS[t]])
    checks = (
        ("null keys", args.max_null_keys, stored.where(required), "nulls"),
        ("rejected rows", args.max_rejected_rows, stored, "rejected_rows"),
    )
    for what, most, rows, counted in checks:
        if most is not None:
            lost = rows.where(F.col(counted) > most).orderBy("table_name", "column").collect()
            if lost:
                told = ", ".join(f"{r.table_name}.{r.column}: {r[counted]} of {r.rows}" for r in lost)
                raise ValueError(f"more than {most} {what}: {told}")
    return raw


def main(argv: list[str] | None = None) -> int:
    """Run a job; 0, or 1 if a table of an extract failed."""
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"martloom-{args.job}").getOrCreate()
    if args.job == "extract":
        report = extract_snapshot(
            spark,
            _sources(spark, args),
            args.as_of,
            args.zone,
            args.keep_older,
            args.file_format,
            args.first_day,
            args.last_day,
            args.manifest,
        )
        report.show(1000, truncate=False)
        return int(report.where("status <> 'exported'").count() > 0)
    if args.job == "publish":
        for mart, names in ((args.mart, SALES_MART), (args.marketing_mart, MARKETING_MART)):
            if args.versioned:
                publish_versions(spark, mart, names, args.version, as_tables=True)
            else:
                publish(spark, mart, names, as_tables=True)
        return 0
    inputs = SALES_INPUTS if args.job == "sales" else MARKETING_INPUTS
    found = find_snapshot(spark, args.zone, inputs, args.as_of)
    paths = {name: found[name] for name in inputs}
    if args.verify:
        require_whole(spark, paths)
    raw = _load(spark, paths, args)
    if args.job == "sales":
        build_sales_mart(
            raw, args.mart, args.week_rule, args.pre_aggregate, args.match_week_start, versioned=args.versioned
        )
    else:
        limits = SegmentThresholds(**{f.name: getattr(args, f.name) for f in fields(SegmentThresholds)})
        build_marketing_mart(
            raw,
            args.mart,
            limits,
            args.churn_days,
            args.partition_daily_by_year,
            tuple(args.order_key),
            versioned=args.versioned,
        )
    release_shared(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
