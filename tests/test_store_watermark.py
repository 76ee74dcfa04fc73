"""Batch partitions, committed visibility and the control log."""

from pyspark.sql import functions as F

from tidemark.operators.watermark import WatermarkLog, guard_frame, high_water, newer_than, within
from tidemark.sinks import Lakehouse

SCHEMA = "k int, v string"


def test_missing_mark_is_zero_and_advance_is_atomic(spark, workdir):
    log = WatermarkLog(Lakehouse(spark, workdir))
    assert log.get("orders.csv") == 0
    log.advance(["orders.csv", "order_products__prior.csv"], 12)
    log.advance(["orders.csv", "order_products__prior.csv"], 30)
    assert log.get("orders.csv") == 30 and log.get("order_products__prior.csv") == 30
    cur = {r["file_name"]: r["last_watermark"] for r in log.table().collect()}
    assert cur == {"orders.csv": 30, "order_products__prior.csv": 30}
    assert sorted(r["seq"] for r in log.history().collect()) == [1, 1, 2, 2]
    log.reset(["orders.csv"], 0)
    assert log.get("orders.csv") == 0


def test_retry_replaces_its_own_batch(spark, workdir):
    store = Lakehouse(spark, workdir)
    first = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    store.replace(first, "bronze", "t", load_lo=0)
    batch = spark.createDataFrame([(3, "c"), (4, "d")], SCHEMA)
    store.write_batch(batch, "bronze", "t", 2)
    store.write_batch(batch, "bronze", "t", 2)          # retry
    got = sorted(r["k"] for r in store.read("bronze", "t").collect())
    assert got == [1, 2, 3, 4]


def test_empty_retry_removes_stale_rows(spark, workdir):
    store = Lakehouse(spark, workdir)
    store.replace(spark.createDataFrame([(1, "a")], SCHEMA), "bronze", "t", load_lo=0)
    store.write_batch(spark.createDataFrame([(5, "x")], SCHEMA), "bronze", "t", 1)
    store.write_batch(spark.createDataFrame([], SCHEMA), "bronze", "t", 1)
    assert [r["k"] for r in store.read("bronze", "t").collect()] == [1]


def test_committed_read_hides_unfinished_batch(spark, workdir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    store = Lakehouse(spark, workdir)
    store.replace(spark.createDataFrame([(1, "a")], SCHEMA), "silver", "t", load_lo=0)
    store.write_batch(spark.createDataFrame([(7, "b")], SCHEMA), "silver", "t", 5)
    assert store.read("silver", "t", schema=schema, committed_below=5).count() == 1
    assert store.read("silver", "t", schema=schema, committed_below=6).count() == 2
    assert store.read("silver", "t", schema=schema, batch=5).first()["k"] == 7
    plan = store.read("silver", "t", schema=schema, batch=5)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_lo" in plan


def test_missing_table_reads_empty(spark, workdir):
    from tidemark.sources import schemas
    store = Lakehouse(spark, workdir)
    assert store.read("gold", "nope", schema=schemas.AISLES).count() == 0
    assert store.row_count("bronze", "orders") == 0 and not store.exists("bronze", "orders")


def test_interval_filters_and_null_keys(spark):
    df = spark.createDataFrame([(None,), (3,), (10,), (12,), (13,)], "order_id int")
    keys = lambda d: sorted((r[0] for r in d.collect()), key=lambda x: (x is None, x))  # noqa
    assert keys(newer_than(df, "order_id", 10)) == [12, 13]
    assert keys(within(df, "order_id", 10, 12)) == [12]
    assert keys(within(df, "order_id", None, 12)) == [3, 10, 12, None]
    assert high_water(df, "order_id") == 13
    assert high_water(df.filter(F.col("order_id") < 0), "order_id") is None
    g = guard_frame(df, "order_id", 10, hi_where=F.col("order_id") < 13).first()
    assert (g["new_rows"], g["current_max"], g["batch_hi"]) == (2, 13, 12)
