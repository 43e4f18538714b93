"""Run the lake: ``python -m lakestrata --root R --general G --us U [--steps load trusted refined] [--verify]``.

Under ``spark-submit`` the session comes from the submit options; the
runtime settings of ``tune_for_scale`` are applied unless ``--no-tune``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from lakestrata.plans.lake import GENERAL, US, LakePaths, run_lake
from lakestrata.session import tune_for_scale


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="lakestrata", description=__doc__)
    p.add_argument("--root", required=True, help="lake root (raw/, trusted/, refined/ below)")
    p.add_argument("--general", required=True, nargs="+",
                   help="folder(s) of general daily CSV files")
    p.add_argument("--us", required=True, nargs="+",
                   help="folder(s) of us daily CSV files")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--date-format", action="append", default=[],
                   help="extra pattern for dates the ISO cast cannot read")
    p.add_argument("--date-column", default="Last_Update", help="raw column that gives the date (or DATE_KEY)")
    p.add_argument("--steps", nargs="+", default=["load", "trusted", "refined"],
                   choices=["load", "trusted", "refined"], help="zones to bring up to date")
    p.add_argument("--verify", action="store_true", help="report invariant violations")
    p.add_argument("--no-tune", action="store_true", help="keep the session's settings")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("lakestrata").getOrCreate()
    if not args.no_tune:
        tune_for_scale(spark)
    sources = {GENERAL: args.general, US: args.us}
    sources = {k: v[0] if len(v) == 1 else v for k, v in sources.items()}
    out = run_lake(spark, LakePaths(args.root), sources,
                   fmt=args.format, date_formats=args.date_format, date_column=args.date_column,
                   steps=args.steps, verify=args.verify)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
