"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They read the driver's test tables through the adapter
(``tidemark.sources.driver_tables``) and run the library's operators over
the whole tables. Pipeline queries run the real loads into a fresh folder
under the shared work folder, once per data folder and application.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, quality
from ..operators.watermark import guard_frame, high_water_frame, newer_than
from ..plans import rulesets
from ..plans.pipeline import FACT_TABLE, LoadResult, Pipeline
from ..session import fresh_dir
from ..sinks.store import Lakehouse
from ..sources import driver_tables as dt
from ..sources import registry, schemas
from ..sources.csv import found_types, read_csv, write_csv

SPLIT_SHARE = 0.9   # the initial load sees the oldest 90% of order ids


def split_point(spark: SparkSession, sf_dir: str) -> int:
    """floor(0.9 * number of orders): last order id of the initial raw drop (clean ids)."""
    n = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet").count()
    return math.floor(SPLIT_SHARE * n)


def dirty_mark(spark: SparkSession, sf_dir: str) -> int:
    """The mark used with dirty ids (0-based): the same orders as the split."""
    return split_point(spark, sf_dir) - 1


def _prior(df: DataFrame) -> DataFrame:
    return df.filter(F.col("eval_set") == F.lit(rulesets.PRIOR))


# -- projections, filters, aggregates ------------------------------------------------
def fact_full(spark, sf_dir):
    o, l, p = (dt.orders(spark, sf_dir), dt.order_lines(spark, sf_dir), dt.products(spark, sf_dir))
    return gold.build_fact(l, _prior(o), p)


def fact_incremental(spark, sf_dir):
    """The batch's fact: lines and prior orders above the mark, all products."""
    mark = dirty_mark(spark, sf_dir)
    lines = newer_than(dt.order_lines(spark, sf_dir), "order_id", mark)
    orders = newer_than(_prior(dt.orders(spark, sf_dir)), "order_id", mark)
    return gold.build_fact(lines, orders, dt.products(spark, sf_dir))


def fact_incremental_equals_full(spark, sf_dir):
    """Fact up to the mark appended with the batch's fact (bag union) = the full fact."""
    mark = dirty_mark(spark, sf_dir)
    lines, orders = dt.order_lines(spark, sf_dir), _prior(dt.orders(spark, sf_dir))
    products = dt.products(spark, sf_dir)
    upto = gold.build_fact(lines.filter(F.col("order_id") <= F.lit(mark)),
                           orders.filter(F.col("order_id") <= F.lit(mark)), products)
    batch = gold.build_fact(newer_than(lines, "order_id", mark),
                            newer_than(orders, "order_id", mark), products)
    return upto.unionByName(batch)


def _plain_orders(spark, sf_dir):
    """Orders without the per-customer sequence: the scan stays prunable."""
    return dt.orders(spark, sf_dir, sequence=False)


def bronze_orders(spark, sf_dir):
    return _prior(dt.orders(spark, sf_dir))


def new_orders(spark, sf_dir):
    return newer_than(dt.orders(spark, sf_dir), "order_id", dirty_mark(spark, sf_dir))


def new_order_products(spark, sf_dir):
    return newer_than(dt.order_lines(spark, sf_dir), "order_id", dirty_mark(spark, sf_dir))


def high_water_raw(spark, sf_dir):
    return high_water_frame(_plain_orders(spark, sf_dir), "order_id")


def high_water_prior(spark, sf_dir):
    return high_water_frame(_prior(_plain_orders(spark, sf_dir)), "order_id")


def bronze_row_count(spark, sf_dir):
    bronze = _prior(_plain_orders(spark, sf_dir))
    bronze.createOrReplaceTempView("tidemark_bronze_orders")
    return spark.sql("SELECT COUNT(*) AS row_count FROM tidemark_bronze_orders")


def load_decision(spark, sf_dir):
    """Mode (by Bronze rows) and guard (raw orders above the mark) in one aggregate."""
    mark = dirty_mark(spark, sf_dir)
    is_prior = F.col("eval_set") == F.lit(rulesets.PRIOR)
    g = guard_frame(_plain_orders(spark, sf_dir), "order_id", mark, hi_where=is_prior,
                    extra=[F.count_if(is_prior).alias("row_count")])
    return g.select(
        "row_count",
        Pipeline.mode_for(F.col("row_count")).alias("load_mode"),
        F.lit(mark).cast("bigint").alias("last_watermark"),
        "current_max", "new_rows", "batch_hi",
        Pipeline.status_for(F.col("new_rows")).alias("guard_status"),
    )


def dup_keys_order_products(spark, sf_dir):
    lines = dt.order_lines(spark, sf_dir)
    return (lines.groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
            .filter(F.col("n") > 1))


def orphan_lines(spark, sf_dir):
    return gold.orphan_lines(dt.order_lines(spark, sf_dir), _prior(dt.orders(spark, sf_dir)),
                             dt.products(spark, sf_dir))


# -- data quality -----------------------------------------------------------------
def _dq(table: str, variant: str = "dirty", scope: str = "all"):
    def run(spark, sf_dir):
        df = dt.TABLES[table](spark, sf_dir, variant)
        if table == "orders" and scope == "prior":
            df = _prior(df)
        if table == "orders" and scope == "new":
            df = newer_than(df, "order_id", dirty_mark(spark, sf_dir))
        return quality.evaluate(df, rulesets.RULESETS[table]())
    return run


def dq_types_orders(spark, sf_dir):
    """Orders read from CSV with malformed cells (a word, a wide id, a letter in the
    day gap) and without ``order_dow``: the type rules fire."""
    path = fresh_dir(spark, "csv-types") + "/orders.csv"
    k = F.col("order_id")
    cells = dt.orders(spark, sf_dir).withColumns({
        "order_id": F.when(k % 53 == 0, F.concat(F.lit("abc"), k.cast("string"))).otherwise(k.cast("string")),
        "user_id": F.when(k % 59 == 0, F.lit("3000000000")).otherwise(F.col("user_id").cast("string")),
        "days_since_prior_order": F.when(k % 61 == 0, F.lit("x"))
        .otherwise(F.col("days_since_prior_order").cast("string"))}).drop("order_dow")
    write_csv(cells, path)
    seen = Observation()
    df = read_csv(spark, path, schemas.ORDERS, observation=seen)
    df.agg(F.count("*")).collect()
    return quality.evaluate(df, rulesets.orders_rules(), found_types=found_types(seen))


def _inferred(table: str, edits: dict[str, str]):
    """A table read by the inferring reader, its columns rewritten (SQL) so that their types
    are not the demanded ones."""
    def run(spark, sf_dir):
        path = fresh_dir(spark, "csv-inferred") + "/t.csv"
        df = dt.TABLES[table](spark, sf_dir)
        write_csv(df.selectExpr(*(f"{edits.get(c, c)} AS {c}" for c in df.columns)), path)
        return quality.evaluate(read_csv(spark, path), rulesets.RULESETS[table]())
    return run


def late_lines(spark, sf_dir):
    """Lines that arrive for orders the mark has passed (one for every 13th order), beside the
    loaded ones and lines of orders above the mark."""
    p = _pipeline(spark, sf_dir)
    root = fresh_dir(spark, "late")
    lines, k = dt.order_lines(spark, sf_dir, "clean"), F.col("order_id")
    extra = (dt.orders(spark, sf_dir, "clean", sequence=False).filter(k % 13 == 0)
             .select("order_id", (k + 1_000_000).alias("product_id"), F.lit(1).alias("add_to_cart_order"),
                     F.lit(0).alias("reordered")))
    write_csv(lines.unionByName(extra), registry.ORDER_PRODUCTS.path(root))
    return Pipeline(spark, p.store, root, other_eval_set="skip").late_lines()


# -- dimensions, star, preview ------------------------------------------------------
def _dim(table: str):
    def run(spark, sf_dir):
        return gold.build_dim(dt.TABLES[table](spark, sf_dir, "dirty"))
    return run


def star_join(spark, sf_dir):
    fact = fact_full(spark, sf_dir)
    return gold.star(fact, dt.products(spark, sf_dir), dt.aisles(spark, sf_dir),
                     dt.departments(spark, sf_dir))


def preview_fact(spark, sf_dir):
    """The preview is any ten rows, so what can be checked is returned: how many
    rows it has and how many of them are in the fact."""
    fact = fact_full(spark, sf_dir)
    key = ["order_id", "product_id", "add_to_cart_order"]
    shown = gold.preview(fact, 10).withColumn("_no", F.monotonically_increasing_id())
    known = fact.select(*key).distinct().withColumn("_known", F.lit(True))
    return shown.join(known, key, "left").agg(F.count("*").alias("preview_rows"),
                                              F.count_if("_known").alias("in_fact"))


# -- CSV sources --------------------------------------------------------------------
def csv_orders(spark, sf_dir):
    path = fresh_dir(spark, "csv-orders") + "/orders.csv"
    write_csv(dt.orders(spark, sf_dir), path)
    return read_csv(spark, path, schemas.ORDERS)


def quoted_products(spark, sf_dir) -> DataFrame:
    """Products whose names carry a comma and doubled quotes: ``name, "Brand#7"``."""
    parts = dt.parts(spark, sf_dir, "dirty")       # carries the brand as ``aisle``
    return parts.select(
        "product_id",
        F.concat(F.col("product_name"), F.lit(', "'), F.col("aisle"), F.lit('"'))
        .alias("product_name"),
        "aisle_id", "department_id")


def csv_products_quoted(spark, sf_dir):
    path = fresh_dir(spark, "csv-products") + "/products.csv"
    write_csv(quoted_products(spark, sf_dir), path, quoted=True)
    return read_csv(spark, path, schemas.PRODUCTS, quoted=True)


# -- pipeline runs ------------------------------------------------------------------
_RUNS: dict[tuple[str, str], tuple[str, dict[str, LoadResult]]] = {}


def pipeline_store(spark: SparkSession, sf_dir: str) -> tuple[Lakehouse, str]:
    """Reference load, initial load (ids <= split) and incremental load (all ids)
    of the clean adapter, run once per (application, data folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = fresh_dir(spark, "pipeline")
        split = split_point(spark, sf_dir)
        raw_initial, raw_full = f"{root}/raw-initial", f"{root}/raw-full"
        dt.write_raw_zones(spark, sf_dir, {raw_initial: split, raw_full: None}, "clean")
        store = Lakehouse(spark, f"{root}/lake")
        Pipeline(spark, store, raw_initial, other_eval_set="skip").reference_load()
        first = Pipeline(spark, store, raw_initial, other_eval_set="skip").run()
        second = Pipeline(spark, store, raw_full, other_eval_set="skip").run()
        assert (first.mode, second.mode) == ("initial", "incremental"), (first, second)
        third = Pipeline(spark, store, raw_full, other_eval_set="skip").run()
        _RUNS[key] = root, {"initial": first, "incremental": second, "no_new_data": third}
    root, _ = _RUNS[key]
    return Lakehouse(spark, f"{root}/lake"), root


def _pipeline(spark, sf_dir) -> Pipeline:
    store, root = pipeline_store(spark, sf_dir)
    return Pipeline(spark, store, f"{root}/raw-full", other_eval_set="skip")


def _guard(run_name: str):
    """What the guard of a real load decided: one row."""
    def run(spark, sf_dir):
        pipeline_store(spark, sf_dir)
        r = _RUNS[spark.sparkContext.applicationId, sf_dir][1][run_name]
        return spark.range(1).select(
            F.lit(r.status).alias("status"), F.lit(r.mode).alias("load_mode"),
            F.lit(int(r.lo)).cast("bigint").alias("mark_before"), F.lit(int(r.hi)).cast("bigint").alias("mark_after"),
            F.lit(int(r.new_orders)).cast("bigint").alias("new_orders"))
    return run


def watermark_updated_at(spark, sf_dir):
    """Every control row carries a time not in the future, later moves later times."""
    log = _pipeline(spark, sf_dir).marks.history()
    return (log.groupBy("file_name")
            .agg((F.count_if(F.col("updated_at") <= F.current_timestamp()) == F.count("*")).alias("all_past"),
                 (F.max_by("updated_at", "seq") == F.max("updated_at")).alias("in_order")))


def pipeline_gate_failure(spark, sf_dir):
    """Default ``other_eval_set="fail"``: the incremental batch brings non-prior
    orders, so the gate must fail and the mark must stay; returns the gate's
    per-rule report of that failed run."""
    store, root = pipeline_store(spark, sf_dir)
    strict = Lakehouse(spark, fresh_dir(spark, "strict") + "/lake")
    first = Pipeline(spark, strict, f"{root}/raw-initial")
    first.reference_load()
    first.run()
    mark = first.marks.get(registry.ORDERS.file_name)
    try:
        Pipeline(spark, strict, f"{root}/raw-full").run()
    except quality.QualityGateError as err:
        if first.marks.get(registry.ORDERS.file_name) != mark:
            raise AssertionError("the mark moved after a failed gate") from err
        rows = [tuple(r.__dict__[c] for c in quality.RESULT_COLUMNS) for r in err.results]
        return spark.createDataFrame(rows, "rule_no int, rule_kind string, column_name string, "
                                           "violations bigint, message string")
    raise AssertionError("the incremental gate should have failed on non-prior orders")


def pipeline_fact(spark, sf_dir):
    return _pipeline(spark, sf_dir).fact()


def pipeline_fact_increment(spark, sf_dir):
    p = _pipeline(spark, sf_dir)
    first_mark = (p.marks.history().filter(F.col("seq") == 1)
                  .agg(F.max("last_watermark")).first()[0])
    return p.store.read("gold", FACT_TABLE, schema=p.fact().schema, batch=first_mark)


def _marks_at(seq: int):
    def run(spark, sf_dir):
        log = _pipeline(spark, sf_dir).marks.history()
        return log.filter(F.col("seq") == seq).select("file_name", "last_watermark")
    return run


def pipeline_star(spark, sf_dir):
    return _pipeline(spark, sf_dir).star()


def pipeline_layer_counts(spark, sf_dir):
    p = _pipeline(spark, sf_dir)
    p.register_tables()
    names = [("bronze", "orders"), ("bronze", "order_products_prior"),
             ("silver", "orders"), ("silver", "order_products_prior"),
             ("gold", "fact_order_products"),
             ("bronze", "products"), ("bronze", "aisles"), ("bronze", "departments"),
             ("silver", "products"), ("silver", "aisles"), ("silver", "departments"),
             ("gold", "dim_product"), ("gold", "dim_aisle"), ("gold", "dim_department")]
    sql = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, COUNT(*) AS row_count "
        f"FROM {layer}.{table}" for layer, table in names)
    return spark.sql(sql)


def stored_sizes(spark, sf_dir):
    """Rows and largest key of each layer, by aggregates pushed down to file footers."""
    return _pipeline(spark, sf_dir).stored_sizes()


QUERIES = {
    "fact_full": fact_full,
    "fact_incremental": fact_incremental,
    "fact_incremental_equals_full": fact_incremental_equals_full,
    "bronze_orders": bronze_orders,
    "new_orders": new_orders,
    "new_order_products": new_order_products,
    "high_water_raw": high_water_raw,
    "high_water_prior": high_water_prior,
    "bronze_row_count": bronze_row_count,
    "load_decision": load_decision,
    "dup_keys_order_products": dup_keys_order_products,
    "orphan_lines": orphan_lines,
    "dq_orders": _dq("orders", scope="prior"),
    "dq_orders_incremental": _dq("orders", scope="new"),
    "dq_order_products": _dq("order_products_prior"),
    "dq_products": _dq("products"),
    "dq_aisles": _dq("aisles"),
    "dq_departments": _dq("departments"),
    "dq_corrupt_orders": _dq("orders", "corrupt", scope="prior"),
    "dq_corrupt_orders_incremental": _dq("orders", "corrupt", scope="new"),
    "dq_corrupt_order_products": _dq("order_products_prior", "corrupt"),
    "dq_corrupt_products": _dq("products", "corrupt"),
    "dq_broken_orders": _dq("orders", "broken"),
    "dq_broken_order_products": _dq("order_products_prior", "broken"),
    "dq_broken_products": _dq("products", "broken"),
    "dq_broken_aisles": _dq("aisles", "broken"),
    "dq_broken_departments": _dq("departments", "broken"),
    "dq_types_orders": dq_types_orders,
    "dq_types_orders_inferred": _inferred("orders", {
        "user_id": "'2020-01-01'", "eval_set": "'1'", "order_number": "order_number + 0.5",
        "order_dow": "order_dow > 3", "order_hour_of_day": "concat('2020-01-01 ', order_hour_of_day, ':30:00')"}),
    "dq_types_order_products": _inferred("order_products_prior", {
        "order_id": "'2020-01-01'", "product_id": "product_id + 0.5",
        "add_to_cart_order": "add_to_cart_order + 3000000000", "reordered": "reordered = 1"}),
    "dq_types_products": _inferred("products", {
        "product_id": "concat('P', product_id)", "product_name": "product_id", "aisle_id": "aisle_id + 0.5",
        "department_id": "'2020-01-01 10:00:00'"}),
    "dq_types_aisles": _inferred("aisles", {"aisle_id": "'true'", "aisle": "aisle_id"}),
    "dq_types_departments": _inferred("departments", {
        "department_id": "department_id + 0.25", "department": "'2021-05-06'"}),
    "late_lines": late_lines,
    "dq_clean_orders": _dq("orders", "clean", scope="prior"),
    "dq_clean_order_products": _dq("order_products_prior", "clean"),
    "dim_product": _dim("products"),
    "dim_aisle": _dim("aisles"),
    "dim_department": _dim("departments"),
    "star_join": star_join,
    "preview_fact": preview_fact,
    "csv_orders": csv_orders,
    "csv_products_quoted": csv_products_quoted,
    "pipeline_fact": pipeline_fact,
    "pipeline_gate_failure": pipeline_gate_failure,
    "pipeline_fact_increment": pipeline_fact_increment,
    "pipeline_star": pipeline_star,
    "pipeline_layer_counts": pipeline_layer_counts,
    "stored_sizes": stored_sizes,
    "guard_initial": _guard("initial"),
    "guard_incremental": _guard("incremental"),
    "guard_no_new_data": _guard("no_new_data"),
    "watermark_updated_at": watermark_updated_at,
    "watermark_after_initial": _marks_at(1),
    "watermark_after_incremental": _marks_at(2),
}
