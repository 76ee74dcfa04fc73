"""What the stored files allow: counts from footers, skipped row groups, broadcasts
bounded by what a dimension decodes to."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold
from tidemark.plans.pipeline import FACT_TABLE, Pipeline
from tidemark.sinks import Lakehouse
from tidemark.sources import schemas

from conftest import line_row, order_row, write_raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lake(spark, workdir):
    raw = write_raw(f"{workdir}/raw", [order_row(i) for i in range(1, 9)], [line_row(i, 1) for i in range(1, 9)])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    p.reference_load()
    p.run()
    return p


def test_counts_and_largest_keys_come_from_footers(spark, lake):
    frame = lake.store.footer_frame("silver", "orders", "order_id", epoch=0, committed_below=8)
    text = plan(frame)
    assert "PushedAggregation: [COUNT(*), MAX(order_id)]" in text and "PushedGroupBy: [load_epoch, load_lo]" in text
    assert "load_lo" in text and "load_epoch" in text              # partition filters, no data filter
    assert frame.collect()[0].asDict() == {"row_count": 8, "high_water": 8}
    assert lake.store.row_count("silver", "orders") == 8
    assert lake.store.row_count("silver", "orders", epoch=3) == 0 and lake.store.row_count("no", "table") == 0
    assert lake.store.footer_frame("silver", "orders", "order_id", epoch=3).first()["high_water"] is None
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_stored_sizes_are_those_of_committed_rows(spark, workdir, lake):
    raw = write_raw(f"{workdir}/bad", [order_row(i) for i in range(1, 12)],
                    [line_row(i, 1) for i in range(1, 11)] + [line_row(11, 1, cart=0)])
    with pytest.raises(ValueError, match="add_to_cart_order"):
        Pipeline(spark, lake.store, raw).run()
    want = {(layer, t): (8, 8) for layer, t in (("bronze", "orders"), ("bronze", "order_products_prior"),
                                              ("silver", "orders"), ("silver", "order_products_prior"),
                                              ("gold", FACT_TABLE))}
    assert {(r.layer, r.table_name): (r.row_count, r.high_water) for r in lake.stored_sizes().collect()} == want
    assert lake.bronze_row_count() == 11                            # with what the failed run landed


def test_a_filter_inside_a_batch_skips_row_groups(spark, workdir):
    import glob

    import pyarrow.parquet as pq
    store = Lakehouse(spark, f"{workdir}/lake")
    lines = spark.range(0, 200_000, 1, 2).select(
        (F.hash("id") % 100_000 + 100_000).cast("int").alias("order_id"), F.col("id").cast("int").alias("product_id"),
        F.lit(1).alias("add_to_cart_order"), F.lit(0).alias("reordered"))
    before = spark.sparkContext._jsc.hadoopConfiguration().get("parquet.block.size")
    spark.sparkContext._jsc.hadoopConfiguration().setInt("parquet.block.size", 64 << 10)
    try:
        store.write_batch(lines, "silver", "order_products_prior", 0, schemas.ORDER_PRODUCTS, sort_by="order_id")
    finally:
        if before is None:
            spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
        else:
            spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", before)
    folder = store.batch_path("silver", "order_products_prior", 0).removeprefix("file:")
    groups = []
    for name in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        assert [s.min for s in stats] == sorted(s.min for s in stats)
        groups += [(s.min, s.max) for s in stats]
    assert len(groups) >= 8
    top = max(b for _, b in groups)
    mark = top - 20_000
    assert sum(b > mark for _, b in groups) < len(groups) / 3       # the rest need not be read
    read = store.read("silver", "order_products_prior", schemas.ORDER_PRODUCTS, batch=0, epoch=0)
    assert read.filter(F.col("order_id") > mark).count() == lines.filter(F.col("order_id") > mark).count()


def test_sorted_writes_need_no_shuffle(spark, workdir, lake):
    files = spark.read.parquet(lake.store.batch_path("gold", FACT_TABLE, 0))
    assert [r.order_id for r in files.coalesce(1).collect()] == sorted(r.order_id for r in files.collect())


def test_a_compressible_dimension_is_not_broadcast(spark, workdir):
    path = f"{workdir}/dim"
    (spark.range(20_000).select(F.col("id").cast("int").alias("product_id"),
                                F.repeat(F.lit("same name "), 100).alias("product_name")).write.parquet(path))
    dim = spark.read.parquet(path)
    assert gold.estimated_bytes(dim) < 4 << 20                      # the files are small
    [(rows, size)] = gold.measured(dim)
    assert rows == 20_000 and size == 20_000 * (1000 + 24)
    probe = spark.range(10).select(F.col("id").cast("int").alias("product_id"))

    def hinted(df):
        return "broadcast" in probe.join(df, "product_id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert not hinted(gold.bounded_broadcast(dim, max_bytes=4 << 20))
    assert not hinted(gold.bounded_broadcast(dim, max_bytes=4 << 20, rows=20_000))
    assert hinted(gold.bounded_broadcast(dim, max_bytes=32 << 20))
    keys = dim.select("product_id")
    assert hinted(gold.bounded_broadcast(keys, max_bytes=4 << 20, rows=20_000))


def test_all_dimensions_are_measured_in_one_job(spark):
    frames = [spark.range(n).select(F.col("id").alias("k"), F.lit("é").alias("v")) for n in (0, 3, 7)]
    assert gold.measured(*frames) == [(n, n * (24 + 2)) for n in (0, 3, 7)]
