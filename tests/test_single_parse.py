"""One parse of every raw file a run, gates observed on the landing writes, and
reloads that readers do not notice before they are complete."""

import json
import os
import subprocess
import sys

import pytest

from tidemark.operators import quality
from tidemark.operators.quality import QualityGateError, Watched, collect_results
from tidemark.plans import rulesets
from tidemark.plans.pipeline import FACT_TABLE, SUCCESS, Pipeline
from tidemark.sinks import Lakehouse
from tidemark.sources import driver_tables as dt
from tidemark.sources import schemas

from conftest import SF_SMALL, line_row, order_row, write_raw

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LOADS = """
import sys
sys.path.insert(0, {repo!r}); sys.path.insert(0, {repo!r} + "/tests")
from conftest import line_row, order_row, write_raw
from tidemark.plans.pipeline import Pipeline
from tidemark.session import local_session
from tidemark.sinks import Lakehouse
spark = local_session(2, 2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r},
                                   "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
                                   "spark.checkpoint.dir": {work!r},
                                   "spark.sql.maxMetadataStringLength": "1000"}})
store = Lakehouse(spark, {work!r} + "/lake")
for name, n in (("first", 6), ("second", 9), ("third", 12)):
    raw = write_raw({work!r} + "/" + name, [order_row(i) for i in range(1, n + 1)],
                    [line_row(i, 1) for i in range(1, n + 1)])
    p = Pipeline(spark, store, raw, skip_unchanged_raw=name == "third")
    if name == "first":
        p.reference_load()
    assert p.run().hi == n
spark.stop()
"""


def test_each_raw_file_is_read_once_a_run(tmp_path):
    log, work = tmp_path / "log", tmp_path / "work"
    log.mkdir(), work.mkdir()
    done = subprocess.run([sys.executable, "-c", LOADS.format(repo=REPO, log=str(log), work=str(work))],
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    scans = {}
    for name in os.listdir(log):
        for line in open(log / name):
            event = json.loads(line)
            if event["Event"].endswith("SparkListenerSQLExecutionStart"):
                plan = event["physicalPlanDescription"]
                for run in ("first", "second", "third"):
                    for raw in ("orders.csv", "order_products__prior.csv", "products.csv", "aisles.csv"):
                        here = plan.count(f"/{run}/{raw}]") if "Scan csv" in plan else 0
                        scans[run, raw] = scans.get((run, raw), 0) + here
    assert {k: v for k, v in scans.items() if v} == {
        (run, raw): 1 for run in ("first", "second", "third") for raw in ("orders.csv", "order_products__prior.csv")
    } | {("first", "products.csv"): 1, ("first", "aisles.csv"): 1}


@pytest.mark.parametrize("table, variant", [*((t, "broken") for t in rulesets.RULESETS),
                                            ("orders", "dirty"), ("order_products_prior", "dirty")])
def test_observed_counts_equal_the_aggregate(spark, workdir, table, variant):
    df, rules = dt.TABLES[table](spark, SF_SMALL, variant), rulesets.RULESETS[table]()
    watched = Watched(rules)
    watched.over(df).write.parquet(f"{workdir}/t")
    counts = watched.counts
    landed = spark.read.parquet(f"{workdir}/t")
    assert counts["rows"] == landed.count()
    mine = sorted(tuple(r) for r in quality.evaluate(landed, rules, counts=counts).collect())
    want = sorted(tuple(getattr(r, c) for c in quality.RESULT_COLUMNS) for r in collect_results(df, rules))
    assert mine == want
    assert variant != "broken" or sum(r[3] > 0 for r in mine) > 2


def test_observed_counts_of_some_rows_and_missing_columns(spark, workdir):
    df = spark.createDataFrame([(1, "prior", -1), (2, "train", -1), (None, None, -1)],
                               "order_id int, eval_set string, user_id int")
    watched = Watched(rulesets.orders_rules(), where="eval_set = 'prior'")
    watched.over(df).write.parquet(f"{workdir}/t")
    counts = watched.counts
    assert counts["rows"] == 1
    results = quality.evaluate(df.filter("eval_set = 'prior'"), rulesets.orders_rules(), counts=counts).collect()
    by_rule = {(r.rule_kind, r.column_name): r.violations for r in results}
    assert by_rule["positive", "user_id"] == 1 and by_rule["not_null", "order_id"] == 0
    assert by_rule["not_null", "order_dow"] is None and by_rule["type", "order_dow"] == 1


def drop(workdir, name, n, dow=1):
    return write_raw(f"{workdir}/{name}", [order_row(i, dow=dow) for i in range(1, n + 1)],
                     [line_row(i, p) for i in range(1, n + 1) for p in (1, 2)])


def served(p):
    """What readers see of each transactional table."""
    return {(layer, t): sorted(r.order_id for r in p.committed(layer, t, s).collect())
            for layer, t, s in (("bronze", "orders", schemas.ORDERS), ("silver", "orders", schemas.ORDERS),
                                ("silver", "order_products_prior", schemas.ORDER_PRODUCTS),
                                ("gold", FACT_TABLE, p.fact().schema))}


@pytest.mark.parametrize("copy", [True, False])
def test_a_forced_reload_is_invisible_until_it_succeeds(spark, workdir, monkeypatch, copy):
    store = Lakehouse(spark, f"{workdir}/lake")
    p = Pipeline(spark, store, drop(workdir, "a", 5), silver_copy=copy)
    p.reference_load()
    p.run()
    before = served(p)
    assert before["gold", FACT_TABLE] == sorted([1, 2, 3, 4, 5] * 2)

    bad = Pipeline(spark, store, drop(workdir, "bad", 7, dow=9), silver_copy=copy)
    with pytest.raises(QualityGateError, match="ORDERS DATA QUALITY CHECK FAILED"):
        bad.initial_load(force=True)
    assert served(p) == before and p.marks.current("orders.csv") == (0, 5)
    p.register_tables()
    assert spark.sql("SELECT COUNT(*) FROM gold.fact_order_products").first()[0] == 10
    assert p.bronze_row_count() == 5 and p.choose_mode() == "incremental"

    # a reload that breaks at its last write, with every layer but the mark written
    again = Pipeline(spark, store, drop(workdir, "good", 7), silver_copy=copy)
    advance = again.marks.advance

    def broken(*args):
        raise OSError("no mark")
    monkeypatch.setattr(again.marks, "advance", broken)
    with pytest.raises(OSError):
        again.initial_load(force=True)
    assert served(p) == before

    # an increment between them still works on the committed epoch
    more = Pipeline(spark, store, drop(workdir, "more", 6), silver_copy=copy)
    r = more.run()
    assert (r.mode, r.lo, r.hi) == ("incremental", 5, 6)
    assert served(p)["gold", FACT_TABLE] == sorted([1, 2, 3, 4, 5, 6] * 2)

    monkeypatch.setattr(again.marks, "advance", advance)
    held = p.fact()                                    # a reader that planned before the switch
    r = again.initial_load(force=True)
    assert (r.status, r.mode, r.lo, r.hi) == (SUCCESS, "initial", 0, 7)
    assert p.marks.current("orders.csv") == (1, 7)
    assert served(p)["gold", FACT_TABLE] == sorted(list(range(1, 8)) * 2)
    assert held.count() == 12
    assert store.read("gold", FACT_TABLE).count() == 12 + 14      # the replaced rows are still there
    last = Pipeline(spark, store, drop(workdir, "last", 8), silver_copy=copy)
    assert last.run().hi == 8
    assert store.read("gold", FACT_TABLE).count() == 16           # and gone after the next load
    assert served(p)["gold", FACT_TABLE] == sorted(list(range(1, 9)) * 2)


def test_a_forced_reload_may_bring_other_types(spark, workdir):
    store = Lakehouse(spark, f"{workdir}/lake")
    good = write_raw(f"{workdir}/a", [order_row(i) for i in (1, 2, 3)], [line_row(i, 1) for i in (1, 2, 3)])
    p = Pipeline(spark, store, good, infer_schema=True)
    p.reference_load()
    p.run()
    ints = write_raw(f"{workdir}/b", [order_row(i, days="5") for i in (1, 2, 3, 4)], [line_row(i, 1) for i in (1, 2, 3, 4)])
    with pytest.raises(QualityGateError, match="expected double, found int"):
        Pipeline(spark, store, ints, infer_schema=True).initial_load(force=True)
    assert p.fact().count() == 3
    assert Pipeline(spark, store, ints).initial_load(force=True).hi == 4
    assert p.fact().count() == 4 and dict(p.fact().dtypes)["days_since_prior_order"] == "double"


def test_staging_is_gone_after_a_run(spark, workdir):
    store = Lakehouse(spark, f"{workdir}/lake")
    p = Pipeline(spark, store, drop(workdir, "a", 3), skip_unchanged_raw=True)
    p.reference_load()
    p.run()
    assert not store.exists("staging", "orders") and not store.exists("staging", "order_products_prior")
    assert p.run().status == "NO_NEW_DATA" and not store.exists("staging", "orders")
