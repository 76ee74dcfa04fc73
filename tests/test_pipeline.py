"""The five documented scenarios and the batch traps, on hand-written drops."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityGateError
from tidemark.plans.pipeline import FACT_TABLE, NO_NEW_DATA, SUCCESS, Pipeline
from tidemark.sinks import Lakehouse
from tidemark.sources import schemas

from conftest import line_row, order_row, write_raw


def orders_upto(n, start=1, non_prior=()):
    return [order_row(i, "train" if i in non_prior else "prior", user=1 + i % 3,
                      number=1 + i // 3, dow=i % 7, hour=i % 24,
                      days="" if i < 4 else f"{i % 30}.0")
            for i in range(start, n + 1)]


def lines_upto(n, start=1):
    return [line_row(i, p, cart=p, reordered=(i + p) % 2)
            for i in range(start, n + 1) for p in (1, 2, 3) if (i + p) % 4]


def new_pipeline(spark, workdir, raw, mode="fail"):
    return Pipeline(spark, Lakehouse(spark, workdir + "/lake"), raw, other_eval_set=mode)


def run_drop(spark, workdir, name, orders, lines, mode="fail", **kw):
    raw = write_raw(f"{workdir}/{name}", orders, lines, **kw)
    return new_pipeline(spark, workdir, raw, mode)


def keys(df):
    return sorted((r["order_id"], r["product_id"]) for r in df.collect())


def table_sizes(p):
    s = p.store
    return {
        (layer, t): s.read(layer, t).count()
        for layer in ("bronze", "silver") for t in ("orders", "order_products_prior")
    } | {("gold", FACT_TABLE): s.read("gold", FACT_TABLE).count()}


@pytest.fixture()
def loaded(spark, workdir):
    """Reference load + initial load of orders 1..12."""
    p = run_drop(spark, workdir, "raw1", orders_upto(12), lines_upto(12))
    p.reference_load()
    assert p.choose_mode() == "initial"
    r = p.run()
    assert (r.status, r.mode, r.lo, r.hi) == (SUCCESS, "initial", 0, 12)
    return p


def test_initial_then_incremental(spark, workdir, loaded):
    assert loaded.choose_mode() == "incremental"
    p = run_drop(spark, workdir, "raw2", orders_upto(15), lines_upto(15))
    r = p.run()
    assert (r.status, r.mode, r.lo, r.hi, r.new_orders) == (SUCCESS, "incremental", 12, 15, 3)
    assert r.rows == {"orders": 3, "order_products_prior": len(lines_upto(15, start=13))}
    assert p.marks.get("orders.csv") == 15 == p.marks.get("order_products__prior.csv")
    fact = p.fact()
    assert fact.columns == list(schemas.FACT_COLUMNS)
    expect = sorted((o, pid) for o in range(1, 16) for pid in (1, 2, 3) if (o + pid) % 4)
    assert keys(fact) == expect
    # only the new orders' rows were appended, in their own batch partition
    inc = p.store.read("gold", FACT_TABLE, batch=12)
    assert {r["order_id"] for r in inc.collect()} == {13, 14, 15}
    # star schema and SQL serving
    assert p.star().count() == len(expect)
    p.register_views()
    assert spark.sql("SELECT COUNT(*) AS row_count FROM bronze_orders").first()[0] == 15
    names = p.register_tables()
    assert "gold.fact_order_products" in names and "control.watermark" in names
    assert spark.sql("SELECT COUNT(*) AS row_count FROM bronze.orders").first()[0] == 15
    marks = spark.sql("SELECT last_watermark FROM control.watermark "
                      "WHERE file_name = 'orders.csv'").first()[0]
    assert marks == 15


def test_no_new_data_leaves_tables_unchanged(spark, workdir, loaded):
    before = table_sizes(loaded)
    r = loaded.incremental_load()
    assert (r.status, r.new_orders) == (NO_NEW_DATA, 0)
    assert loaded.initial_load().status == NO_NEW_DATA
    assert table_sizes(loaded) == before and loaded.marks.get("orders.csv") == 12


def test_failed_gate_keeps_mark_and_retry_has_no_duplicates(spark, workdir, loaded):
    bad = orders_upto(12) + [order_row(13, dow=9), *orders_upto(15, start=14)]
    p = run_drop(spark, workdir, "raw-bad", bad, lines_upto(15))
    with pytest.raises(QualityGateError) as err:
        p.run()
    assert str(err.value) == ("ORDERS INCREMENTAL DATA QUALITY CHECK FAILED:\n"
                              "- Found 1 invalid order_dow values")
    assert p.marks.get("orders.csv") == 12
    assert p.fact().count() == loaded.fact().count()          # gold unchanged for readers
    good = run_drop(spark, workdir, "raw-good", orders_upto(15), lines_upto(15))
    r = good.run()
    assert (r.status, r.lo, r.hi) == (SUCCESS, 12, 15)
    for layer in ("bronze", "silver"):
        ids = [x["order_id"] for x in good.store.read(layer, "orders").collect()]
        assert sorted(ids) == list(range(1, 16))
    k = keys(good.fact())
    assert len(k) == len(set(k))


def test_non_prior_order_fails_by_default_and_is_skipped_on_request(spark, workdir, loaded):
    drop = orders_upto(15, non_prior={14})
    p = run_drop(spark, workdir, "raw-np", drop, lines_upto(15))
    with pytest.raises(QualityGateError, match="Found 1 rows where eval_set is not 'prior'"):
        p.incremental_load()
    p2 = run_drop(spark, workdir, "raw-np2", drop, lines_upto(15), mode="skip")
    r = p2.incremental_load()
    assert (r.status, r.hi) == (SUCCESS, 15)
    assert 14 not in {x["order_id"] for x in p2.fact().collect()}


def test_trailing_non_prior_order_does_not_stall_skip_mode(spark, workdir, loaded):
    drop = orders_upto(16, non_prior={16})
    p = run_drop(spark, workdir, "raw-t", drop, lines_upto(16), mode="skip")
    assert p.incremental_load().hi == 15
    assert p.incremental_load().status == NO_NEW_DATA


def test_early_line_is_loaded_once(spark, workdir):
    p = run_drop(spark, workdir, "e1", orders_upto(12), lines_upto(13))   # line of 13 early
    p.reference_load()
    p.run()
    assert 13 not in {r["order_id"] for r in p.fact().collect()}
    p = run_drop(spark, workdir, "e2", orders_upto(14), lines_upto(14))
    p.run()
    k = keys(p.fact())
    assert len(k) == len(set(k)) and sum(1 for o, _ in k if o == 13) == 2


def test_late_line_is_never_loaded(spark, workdir, loaded):
    late = lines_upto(15) + [line_row(10, 2, cart=9)]     # (10, 2) after mark 12
    p = run_drop(spark, workdir, "late", orders_upto(15), late)
    p.run()
    rows = [r for r in p.fact().collect() if r["order_id"] == 10 and r["product_id"] == 2]
    assert rows == []
    late = [(r["order_id"], r["product_id"]) for r in p.late_lines().collect()]
    assert late == [(10, 2)]


def test_orphan_lines_are_dropped_silently(spark, workdir):
    lines = lines_upto(5) + [line_row(3, 99), line_row(77, 1)]
    p = run_drop(spark, workdir, "orph", orders_upto(5), lines)
    p.reference_load()
    assert p.run().status == SUCCESS
    assert keys(p.fact()) == sorted((o, pid) for o in range(1, 6) for pid in (1, 2, 3)
                                    if (o + pid) % 4)
    assert {r["reason"]: r["lines"] for r in p.orphans().collect()} == {
        "unknown_order": 0, "unknown_product": 1}     # order 77 is above the clamp


def test_empty_orders_and_missing_mark(spark, workdir):
    p = run_drop(spark, workdir, "empty", [], [])
    p.reference_load()
    assert p.marks.get("orders.csv") == 0
    r = p.run()
    assert (r.mode, r.status) == ("initial", NO_NEW_DATA)


def test_failed_initial_load_is_rerouted_without_duplicates(spark, workdir):
    bad = orders_upto(5) + [order_row(6, user=-3)]
    p = run_drop(spark, workdir, "i-bad", bad, lines_upto(6))
    p.reference_load()
    with pytest.raises(QualityGateError, match="Found 1 invalid user_id values"):
        p.run()
    assert p.choose_mode() == "incremental"                   # Bronze already filled
    good = run_drop(spark, workdir, "i-good", orders_upto(6), lines_upto(6))
    r = good.run()
    assert (r.mode, r.status, r.lo, r.hi) == ("incremental", SUCCESS, 0, 6)
    ids = sorted(x["order_id"] for x in good.store.read("bronze", "orders").collect())
    assert ids == list(range(1, 7))


def test_reference_failure_stops_later_tables(spark, workdir):
    p = run_drop(spark, workdir, "ref-bad", orders_upto(3), lines_upto(3),
                 products=["1, ,1,1", "2,Bananas,2,1", "2,Dup,2,1"])
    with pytest.raises(QualityGateError) as err:
        p.reference_load()
    assert str(err.value) == ("PRODUCTS DATA QUALITY CHECK FAILED:\n"
                              "- Found 1 duplicate product_id values\n"
                              "- Found 1 empty product_name values")
    assert not p.store.exists("silver", "aisles")
    with pytest.raises(RuntimeError, match="reference_load"):
        p.run()


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=2, max_value=9), st.integers(min_value=1, max_value=8))
def test_initial_plus_incrementals_equal_one_full_load(spark, a, gap):
    from tidemark.session import fresh_dir
    n, first, second = 20, a, min(a + gap, 19)
    work = fresh_dir(spark, "prop")
    full = run_drop(spark, work + "/full", "raw", orders_upto(n), lines_upto(n))
    full.reference_load()
    full.run()
    step = None
    for i, upto in enumerate((first, second, n)):
        step = run_drop(spark, work + "/steps", f"raw{i}", orders_upto(upto), lines_upto(upto))
        if i == 0:
            step.reference_load()
        step.run()
    cols = list(schemas.FACT_COLUMNS)
    a_rows = sorted(tuple(r) for r in full.fact().select(*cols).collect())
    b_rows = sorted(tuple(r) for r in step.fact().select(*cols).collect())
    assert a_rows == b_rows
    assert step.marks.get("orders.csv") == n
    assert step.fact().groupBy("order_id", "product_id").count() \
        .filter(F.col("count") > 1).count() == 0


def test_inferred_types_are_gated_and_appends_are_conformed(spark, workdir, loaded):
    from tidemark.sinks.store import SchemaMismatchError, conform
    # a batch of first orders: days_since_prior_order all empty -> inferred as string
    drop = [order_row(i, days="") for i in (13, 14)]
    raw = write_raw(f"{workdir}/inf", drop, lines_upto(14, start=13))
    p = Pipeline(spark, loaded.store, raw, infer_schema=True)
    with pytest.raises(QualityGateError, match="days_since_prior_order: expected double, "
                                               "found string"):
        p.incremental_load()
    assert p.marks.get("orders.csv") == 12
    # corrected drop: the retry lands at the same mark
    fixed = write_raw(f"{workdir}/inf2", [order_row(i, days="3.0") for i in (13, 14)],
                      lines_upto(14, start=13))
    r = Pipeline(spark, loaded.store, fixed, infer_schema=True).incremental_load()
    assert (r.status, r.lo, r.hi) == (SUCCESS, 12, 14)
    table = loaded.store.table_schema("silver", "orders")
    ok = spark.createDataFrame([(1, 1, "prior", 1, 1, 1, 2)], "order_id int, user_id int, "
                               "eval_set string, order_number int, order_dow int, "
                               "order_hour_of_day int, days_since_prior_order int")
    assert dict(conform(ok, table).dtypes)["days_since_prior_order"] == "double"
    with pytest.raises(SchemaMismatchError):
        conform(ok.withColumn("order_id", ok["order_id"].cast("string")), table)
    with pytest.raises(SchemaMismatchError):
        conform(ok.withColumn("extra", ok["order_id"]), table)


def test_failed_inferred_initial_is_retried_at_the_same_mark(spark, workdir):
    ints = [order_row(i, days="5") for i in range(1, 5)]          # days infer as int
    p = Pipeline(spark, Lakehouse(spark, workdir + "/lake"),
                 write_raw(f"{workdir}/a", ints, lines_upto(4)), infer_schema=True)
    p.reference_load()
    with pytest.raises(QualityGateError, match="expected double, found int"):
        p.run()
    fixed = [order_row(i, days="5.0") for i in range(1, 5)]
    q = Pipeline(spark, p.store, write_raw(f"{workdir}/b", fixed, lines_upto(4)),
                 infer_schema=True)
    r = q.run()
    assert (r.mode, r.status, r.lo, r.hi) == ("incremental", SUCCESS, 0, 4)
    assert sorted(x["order_id"] for x in q.store.read("bronze", "orders").collect()) == [1, 2, 3, 4]
    assert dict(q.fact().dtypes)["days_since_prior_order"] == "double"


def test_reference_failure_in_a_later_table_promotes_the_earlier_ones(spark, workdir):
    p = run_drop(spark, workdir, "ref-mid", orders_upto(3), lines_upto(3),
                 aisles=["1,spices", "1,again"])
    with pytest.raises(QualityGateError, match="^AISLES DATA QUALITY CHECK FAILED:\n"
                                               "- Found 1 duplicate aisle_id values$"):
        p.reference_load()
    assert p.store.exists("silver", "products")
    assert not p.store.exists("silver", "aisles") and not p.store.exists("silver", "departments")
    assert not p.store.exists("gold", "dim_product")


def test_zero_copy_silver_serves_the_same_tables(spark, workdir):
    drops = [("z1", orders_upto(8), lines_upto(8)),
             ("z2bad", orders_upto(8) + [order_row(9, dow=9), *orders_upto(11, start=10)],
              lines_upto(11)),
             ("z2", orders_upto(11), lines_upto(11))]
    out = {}
    for copy in (True, False):
        store = Lakehouse(spark, f"{workdir}/lake-{copy}")
        for i, (name, orders, lines) in enumerate(drops):
            p = Pipeline(spark, store, write_raw(f"{workdir}/{name}-{copy}", orders, lines),
                         silver_copy=copy)
            if i == 0:
                p.reference_load()
            if name.endswith("bad"):
                with pytest.raises(QualityGateError):
                    p.run()
            else:
                assert p.run().status == SUCCESS
        p.register_tables()
        out[copy] = (
            sorted(tuple(r) for r in p.committed("silver", "orders", schemas.ORDERS).collect()),
            sorted(tuple(r) for r in p.committed("silver", "order_products_prior",
                                                 schemas.ORDER_PRODUCTS).collect()),
            sorted(tuple(r) for r in p.fact().collect()),
            spark.sql("SELECT COUNT(*) FROM silver.order_products_prior").first()[0],
        )
        assert p.store.exists("silver", "orders") == copy
    assert out[True] == out[False]
    assert [r[0] for r in out[False][0]] == list(range(1, 12))


def test_sql_views_hide_an_unfinished_batch(spark, workdir, loaded):
    committed_lines = loaded.committed("bronze", "order_products_prior",
                                       schemas.ORDER_PRODUCTS).count()
    bad_lines = lines_upto(15) + [line_row(14, 3, cart=0)]       # fails the lines gate
    p = run_drop(spark, workdir, "raw-badlines", orders_upto(15), bad_lines)
    with pytest.raises(QualityGateError, match="invalid add_to_cart_order"):
        p.run()
    assert p.store.read("bronze", "order_products_prior", batch=12).count() > 0   # landed
    p.register_tables()
    assert spark.sql("SELECT COUNT(*) FROM bronze.order_products_prior").first()[0] \
        == committed_lines
    assert spark.sql("SELECT max(order_id) FROM gold.fact_order_products").first()[0] == 12
