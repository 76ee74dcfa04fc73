"""Steps whose time or memory once grew too fast on large tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.plans import rulesets
from tidemark.sources import driver_tables as dt
from tidemark.sources import registry
from tidemark.sources.csv import cell_kind, read_source

SMALL = "/root/testdata/sf0.001"


def test_merged_lines_take_more_tasks_as_they_grow(spark, monkeypatch):
    monkeypatch.setattr(dt, "ROWS_PER_TASK", 100)
    lines = dt.order_lines(spark, SMALL, "clean")
    per_task = [r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 3 * spark.sparkContext.defaultParallelism and max(per_task) < 400
    assert lines.count() == lines.select("order_id", "product_id").distinct().count()


def test_zones_share_one_computation(spark, workdir, monkeypatch):
    calls, whole = [], dt.sequence_within
    monkeypatch.setattr(dt, "sequence_within", lambda *a: calls.append(a) or whole(*a))
    dt.write_raw_zones(spark, SMALL, {f"{workdir}/old": 700, f"{workdir}/all": None})
    assert len(calls) == 1
    for spec in registry.REGISTRY.values():
        want = dt.TABLES[spec.table](spark, SMALL, "clean")
        for zone in ("old", "all"):
            if zone == "old" and spec.kind == "transaction":
                want_here = want.filter("order_id <= 700")
            else:
                want_here = want
            got = read_source(spark, spec, f"{workdir}/{zone}")
            assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want_here.collect()))


def test_no_cast_that_must_fail_is_tried(spark):
    assert "as int" not in str(cell_kind(F.col("c"))).lower()
    schema = T.StructType([T.StructField("order_id", T.DateType()), T.StructField("product_id", T.TimestampType()),
                           T.StructField("add_to_cart_order", T.LongType()), T.StructField("reordered", T.IntegerType())])
    df = spark.range(3).selectExpr("DATE'2020-01-01' AS order_id", "TIMESTAMP'2020-01-01 00:00:00' AS product_id",
                                   "CASE id WHEN 0 THEN -5L WHEN 1 THEN 3000000000L ELSE -3000000000L END "
                                   "AS add_to_cart_order", "0 AS reordered")
    assert [f.name for f in df.schema] == [f.name for f in schema]
    value = quality._typed(df, rulesets.order_products_rules())
    assert not any("try_cast" in value(c).lower() for c in ("order_id", "product_id", "add_to_cart_order"))
    found = {(r.rule_kind, r.column_name): r.violations
             for r in quality.collect_results(df, rulesets.order_products_rules())}
    assert found["positive", "order_id"] == 0 and found["positive", "product_id"] == 0
    assert found["positive", "add_to_cart_order"] == 1
