"""Command line: run a load and print its result as one JSON line.

    spark-submit --py-files tidemark.zip -m tidemark run --raw s3a://raw/retail --lake s3a://lake/retail
    python -m tidemark {reference,initial,incremental,run,count} --raw RAW --lake LAKE
        [--other-eval-set fail|skip] [--infer-schema] [--format parquet|delta]
        [--zero-copy-silver] [--skip-unchanged-raw]

``count`` prints the Bronze orders row count and the mode it implies; ``run``
picks the initial or incremental load from it. A failed quality gate prints
its report and exits with status 2.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys

from pyspark.sql import SparkSession

from .operators.quality import QualityGateError
from .plans.pipeline import Pipeline
from .sinks import Lakehouse


def _result_json(result) -> str:
    out = dataclasses.asdict(result)
    out["quality"] = {t: [r for r in rs if r["violations"]] for t, rs in out["quality"].items()}
    out["rows"] = result.rows
    return json.dumps(out)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("command", choices=["reference", "initial", "incremental", "run", "count"])
    ap.add_argument("--raw", required=True, help="raw zone holding the five CSV sources")
    ap.add_argument("--lake", required=True, help="root folder of the bronze/silver/gold layers")
    ap.add_argument("--other-eval-set", choices=["fail", "skip"], default="fail")
    ap.add_argument("--infer-schema", action="store_true")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--zero-copy-silver", action="store_true",
                    help="serve Silver transaction tables as committed Bronze batches")
    ap.add_argument("--skip-unchanged-raw", action="store_true",
                    help="do not skip unchanged raw files recorded in the manifest")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    p = Pipeline(spark, Lakehouse(spark, args.lake, fmt=args.format), args.raw,
                 other_eval_set=args.other_eval_set, infer_schema=args.infer_schema,
                 silver_copy=not args.zero_copy_silver,
                 skip_unchanged_raw=args.skip_unchanged_raw)
    if args.command == "count":
        n = p.bronze_row_count()
        print(json.dumps({"row_count": n, "mode": "initial" if n == 0 else "incremental"}))
        return 0
    load = {"reference": p.reference_load, "initial": p.initial_load,
            "incremental": p.incremental_load, "run": p.run}[args.command]
    try:
        print(_result_json(load()))
    except QualityGateError as err:
        print(str(err), file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
