"""Command line: run the daily warehouse load as a Spark job.

    spark-submit --py-files starloom.zip starloom/cli.py \\
        --source-database oltp --target s3://warehouse/sales --load-date 2024-02-01

or, with the source tables stored as datasets under one root:

    python -m starloom.cli --source-root /data/oltp --source-format parquet \\
        --target /data/warehouse --load-date 2024-02-01

The session comes from the submitting environment (master, checkpoint
directory, shuffle partitions); only unset settings get the package's
defaults.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from starloom import conf
from starloom.plans.daily_run import run_daily
from starloom.session import RECOMMENDED_CONF, ensure_checkpoint_dir
from starloom.sources.publish import truncate_load
from starloom.sources.tables import table_reader


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("starloom-daily")
    spark = builder.getOrCreate()
    # Only SQL settings can change at run time; core ones come from submission.
    for key, value in RECOMMENDED_CONF.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starloom", description=__doc__.splitlines()[0])
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--source-database", help="catalog database holding the source tables")
    src.add_argument("--source-root", help="directory holding one dataset per source table")
    parser.add_argument("--source-format", default="parquet")
    parser.add_argument("--target", required=True, help="warehouse root directory")
    parser.add_argument("--load-date", default=dt.date.today().isoformat(),
                        help="load date (yyyy-MM-dd); fixed dates make runs replayable")
    parser.add_argument("--run-id", default=None)
    parser.add_argument("--fact-version", choices=("current", "as_of"), default="current",
                        help="dimension version a fact row points to")
    parser.add_argument("--source-flag", default=conf.DELETED_FLAG,
                        help="the source's soft-delete column")
    parser.add_argument("--source-metadata", default="",
                        help="comma-separated replication columns to drop")
    parser.add_argument("--mirror-format", default=None,
                        help="copy every table with this connector, e.g. jdbc")
    parser.add_argument("--mirror-prefix", default="", help="put before table names in the copy")
    parser.add_argument("--mirror-option", action="append", default=[], metavar="KEY=VALUE",
                        help="connector option; repeatable")
    args = parser.parse_args(argv)

    spark = _session()
    read = table_reader(spark, database=args.source_database, fmt=args.source_format,
                        root=args.source_root, flag=args.source_flag,
                        metadata=[c for c in args.source_metadata.split(",") if c])
    options = dict(o.split("=", 1) for o in args.mirror_option)

    def mirror(name, df):
        truncate_load(df, f"{args.mirror_prefix}{name}", args.mirror_format, options)
    result = run_daily(spark, read, args.target, args.load_date, run_id=args.run_id,
                       fact_version=args.fact_version,
                       mirror=mirror if args.mirror_format else None)
    print(json.dumps({"run_id": result.run_id, "rows": result.rows,
                      "watermarks": {k: str(v) for k, v in result.watermarks.items()},
                      "fact_partitions_written": [str(p) for p in result.rewritten_partitions]}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
