"""Benchmark: the medallion pipeline and its operators at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write a Spark event log there).
Setup (not timed) turns the test tables into the pipeline's raw CSV drops
(initial drop = oldest 90% of orders, full drop = all) and into parquet
copies of the source tables. Timed:

  reference_load    products/aisles/departments -> bronze, gated silver, gold dims
  initial_load      orders + lines (initial drop) -> bronze, gated silver, gold fact, mark
  incremental_load  full drop: only orders above the mark and their lines
  no_new_data       rerun of the incremental load: guard only
  fact_join         lines x orders x products over the whole tables (noop sink)
  dq_orders / dq_order_products   single-pass gate evaluation over the whole tables
  star_join         fact x product/aisle/department dimensions (noop sink)

Before timing, the same loads run once on the sf0.001 tables (untimed, own
folder) so the numbers reflect a warm JVM rather than first-use class
loading and code generation.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.checks.queries import split_point  # noqa: E402
from tidemark.operators import gold, quality  # noqa: E402
from tidemark.plans import rulesets  # noqa: E402
from tidemark.plans.pipeline import NO_NEW_DATA, SUCCESS, Pipeline  # noqa: E402
from tidemark.session import fresh_dir, local_session  # noqa: E402
from tidemark.sinks import Lakehouse  # noqa: E402
from tidemark.sources import driver_tables as dt  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):     # per-step stage metrics, see scripts/stage_report.py
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cpus, max(cpus, 8), app_name="tidemark-bench", extra=extra)

    root = fresh_dir(spark, "bench")
    split = split_point(spark, sf_dir)
    dt.write_raw_zone(spark, sf_dir, f"{root}/raw-initial", "clean", max_order_id=split)
    dt.write_raw_zone(spark, sf_dir, f"{root}/raw-full", "clean")
    for name in ("orders", "order_products_prior", "products", "aisles", "departments"):
        dt.TABLES[name](spark, sf_dir, "dirty").write.parquet(f"{root}/src/{name}")
    src = {n: spark.read.parquet(f"{root}/src/{n}")
           for n in ("orders", "order_products_prior", "products", "aisles", "departments")}
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        try:
            warm = fresh_dir(spark, "bench-warmup")
            dt.write_raw_zone(spark, warm_dir, f"{warm}/raw-initial", "clean",
                              max_order_id=split_point(spark, warm_dir))
            dt.write_raw_zone(spark, warm_dir, f"{warm}/raw-full", "clean")
            w_store = Lakehouse(spark, f"{warm}/lake")
            Pipeline(spark, w_store, f"{warm}/raw-initial", other_eval_set="skip").reference_load()
            Pipeline(spark, w_store, f"{warm}/raw-initial", other_eval_set="skip").run()
            Pipeline(spark, w_store, f"{warm}/raw-full", other_eval_set="skip").run()
        except Exception as e:  # the warm-up is optional; the timed run still happens
            print(f"warm-up skipped: {type(e).__name__}: {e}", file=sys.stderr)
    src["orders"].count()

    store = Lakehouse(spark, f"{root}/lake")
    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        try:
            fn()
        except Exception as e:  # recorded, the other queries still run
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            return
        times[name] = round(time.perf_counter() - t0, 3)

    def expect(status):
        def check(result):
            assert result.status == status, result
        return check

    initial = Pipeline(spark, store, f"{root}/raw-initial", other_eval_set="skip")
    full = Pipeline(spark, store, f"{root}/raw-full", other_eval_set="skip")
    timed("reference_load", lambda: expect(SUCCESS)(initial.reference_load()))
    timed("initial_load", lambda: expect(SUCCESS)(initial.initial_load()))
    timed("incremental_load", lambda: expect(SUCCESS)(full.incremental_load()))
    timed("no_new_data", lambda: expect(NO_NEW_DATA)(full.incremental_load()))

    prior = src["orders"].filter(F.col("eval_set") == "prior")

    def fact():
        return gold.build_fact(src["order_products_prior"], prior, src["products"])

    def run_noop(build):          # building the plan counts: it makes the size checks
        build().write.format("noop").mode("overwrite").save()
    timed("fact_join", lambda: run_noop(fact))
    timed("dq_orders", lambda: quality.collect_results(prior, rulesets.orders_rules()))
    timed("dq_order_products", lambda: quality.collect_results(
        src["order_products_prior"], rulesets.order_products_rules()))
    timed("star_join", lambda: run_noop(lambda: gold.star(
        fact(), src["products"], src["aisles"], src["departments"])))

    out = {"metric": "medallion_pipeline_total", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
