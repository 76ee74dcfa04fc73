"""Adapter: the TPC-H-like test tables seen as the retail-orders sources.

Three variants:

* ``dirty``   - plain mapping; breaks some rules by nature (ids of 0,
  repeated (order_id, product_id) pairs);
* ``clean``   - ids shifted by one and lines merged per (order_id, product_id),
  so every gate passes; used for pipeline runs;
* ``corrupt`` - dirty plus injected violations of value rules;
* ``broken``  - dirty plus the edits of ``BROKEN``: every rule but the types is
  violated, keys that repeat included.

``order_number`` is the order's position in its customer's history and
``days_since_prior_order`` the day gap to the previous one. Both need the
customer's orders in sequence; since one customer may own a large share of
all orders, the sequence is computed on range partitions of
(customer, date, key) instead of one window per customer (see
:func:`sequence_within`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_dir, shared_dir
from . import registry
from .csv import write_csv

VARIANTS = ("dirty", "clean", "corrupt", "broken")

# Variant ``broken``: (column, modulus, value) edits where the row's own key is a
# multiple of the modulus; the first that applies to a column wins.
BROKEN = {
    "orders": ("order_id", [
        ("order_id", 83, None), ("order_id", 113, 7), ("user_id", 97, None), ("user_id", 89, 0),
        ("eval_set", 79, None), ("order_number", 73, None), ("order_number", 109, 0),
        ("order_dow", 71, None), ("order_dow", 101, 7), ("order_hour_of_day", 67, None),
        ("order_hour_of_day", 107, 24)]),
    "order_products_prior": ("order_id + product_id", [
        ("order_id", 83, None), ("order_id", 101, 0), ("product_id", 89, None), ("product_id", 103, 0),
        ("add_to_cart_order", 97, None), ("add_to_cart_order", 131, 0), ("reordered", 137, None),
        ("reordered", 127, 2)]),
    "products": ("product_id", [
        ("product_id", 83, None), ("product_id", 101, 0), ("product_id", 47, 1), ("product_name", 89, None),
        ("product_name", 53, " "), ("aisle_id", 97, None), ("aisle_id", 59, 0), ("department_id", 61, None),
        ("department_id", 67, -1)]),
    "aisles": ("aisle_id", [
        ("aisle_id", 7, None), ("aisle_id", 5, 0), ("aisle_id", 6, 1), ("aisle", 9, None), ("aisle", 4, " ")]),
    "departments": ("department_id", [
        ("department_id", 5, None), ("department_id", 4, 0), ("department_id", 3, 1), ("department", 5, None),
        ("department", 2, "")]),
}


def break_rules(df: DataFrame, table: str) -> DataFrame:
    """The edits of ``BROKEN`` applied to the dirty table."""
    key, edits = BROKEN[table]
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        for column, modulus, value in reversed(edits):
            if column == name:
                c = F.when(F.expr(key) % modulus == 0, F.lit(value).cast(kind)).otherwise(c)
        out.append(c.alias(name))
    return df.select(*out)

# Fixed values of the adapter: order status -> eval_set, part type -> department id.
EVAL_SET_BY_STATUS = {"F": "prior", "O": "train", "P": "test"}
DEPARTMENT_BY_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5,
                      "STANDARD": 6}
BRAND_NUMBER_FROM = 7          # 'Brand#17' -> 17
HOURS = 24
ROWS_PER_TASK = 500_000        # rows that a task merges by key, about


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out


def sequence_within(df: DataFrame, group: str, order: list[str], carry: str) -> DataFrame:
    """Add ``_seq`` (1-based position in the group by ``order``) and ``_prev``
    (``carry`` of the previous row of the group, NULL for the first).

    Equals ``row_number()`` / ``lag()`` over ``partitionBy(group).orderBy(order)``
    but no task ever holds a whole group: rows are range-partitioned on
    (group, *order) - a huge group spans many partitions - and checkpointed so
    the partition id is stable. Each (partition, group) segment is numbered
    locally; a per-group prefix sum over segment sizes (at most one row per
    partition and group) supplies the offsets and the boundary ``lag``.
    ``order`` must be unique within a group.
    """
    shared_dir(df.sparkSession)
    # No explicit count: AQE may coalesce small ranges, and coalescing only
    # merges adjacent ranges, so partition ids stay in range order.
    ranged = (df.repartitionByRange(group, *order)
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    seg_w = Window.partitionBy("_pid", group).orderBy(*order)
    local = (ranged.withColumn("_rn", F.row_number().over(seg_w))
             .withColumn("_lag", F.lag(carry).over(seg_w)))
    # The segment's last ``carry``: a plain (hash-aggregatable) max when the
    # carried column leads the order, else the value at the largest order.
    last = F.max(carry) if carry == order[0] else F.max_by(carry, F.struct(*order))
    segments = (ranged.groupBy("_pid", group)
                .agg(F.count("*").alias("_n"), last.alias("_last")))
    grp_w = Window.partitionBy(group).orderBy("_pid")
    before = grp_w.rowsBetween(Window.unboundedPreceding, -1)
    segments = segments.select(
        "_pid", group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.lag("_last").over(grp_w).alias("_prev_last"))
    return (local.join(segments, ["_pid", group])
            .withColumn("_seq", F.col("_rn") + F.col("_off"))
            .withColumn("_prev", F.when(F.col("_rn") == 1, F.col("_prev_last"))
                        .otherwise(F.col("_lag")))
            .drop("_pid", "_rn", "_lag", "_off", "_prev_last"))


def orders(spark: SparkSession, sf_dir: str, variant: str = "dirty",
           sequence: bool = True) -> DataFrame:
    """``sequence=False`` leaves out ``order_number`` and ``days_since_prior_order``: a plain,
    prunable projection without a shuffle."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_orderdate")
    if not sequence:
        shift = 1 if variant == "clean" else 0
        return o.select(
            (F.col("o_orderkey") + shift).cast("int").alias("order_id"),
            (F.col("o_custkey") + shift).cast("int").alias("user_id"),
            _lookup(F.col("o_orderstatus"), EVAL_SET_BY_STATUS).alias("eval_set"),
            (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
            (F.col("o_orderkey") % HOURS).cast("int").alias("order_hour_of_day"))
    s = sequence_within(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate")
    shift = 1 if variant == "clean" else 0
    out = s.select(
        (F.col("o_orderkey") + shift).cast("int").alias("order_id"),
        (F.col("o_custkey") + shift).cast("int").alias("user_id"),
        _lookup(F.col("o_orderstatus"), EVAL_SET_BY_STATUS).alias("eval_set"),
        F.col("_seq").cast("int").alias("order_number"),
        (F.dayofweek("o_orderdate") - 1).cast("int").alias("order_dow"),
        (F.col("o_orderkey") % HOURS).cast("int").alias("order_hour_of_day"),
        F.datediff(F.col("o_orderdate"), F.col("_prev")).cast("double")
        .alias("days_since_prior_order"),
    )
    if variant == "broken":
        return break_rules(out, "orders")
    if variant == "corrupt":
        k = F.col("order_id")
        out = out.select(
            "order_id",
            F.when(k % 97 == 0, F.lit(None).cast("int")).otherwise(F.col("user_id"))
            .alias("user_id"),
            "eval_set",
            F.when(k % 109 == 0, F.lit(0)).otherwise(F.col("order_number")).alias("order_number"),
            F.when(k % 101 == 0, F.lit(7)).when(k % 103 == 0, F.lit(-1))
            .otherwise(F.col("order_dow")).alias("order_dow"),
            F.when(k % 107 == 0, F.lit(24)).otherwise(F.col("order_hour_of_day"))
            .alias("order_hour_of_day"),
            "days_since_prior_order",
        )
    return out


def order_lines(spark: SparkSession, sf_dir: str, variant: str = "dirty") -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    shift = 1 if variant == "clean" else 0
    out = li.select(
        (F.col("l_orderkey") + shift).cast("int").alias("order_id"),
        (F.col("l_partkey") + shift).cast("int").alias("product_id"),
        F.col("l_linenumber").cast("int").alias("add_to_cart_order"),
        F.when(F.col("l_returnflag") == F.lit("R"), F.lit(1)).otherwise(F.lit(0))
        .alias("reordered"),
    )
    if variant == "clean":
        # dealt by the key before it is merged: the tasks grow in number, not in what they hold
        tasks = max(spark.sparkContext.defaultParallelism, li.count() // ROWS_PER_TASK + 1)
        out = out.repartition(tasks, "order_id", "product_id").groupBy("order_id", "product_id").agg(
            F.min("add_to_cart_order").alias("add_to_cart_order"),
            F.max("reordered").alias("reordered"))
    if variant == "broken":
        return break_rules(out, "order_products_prior")
    if variant == "corrupt":
        s = F.col("order_id") + F.col("product_id")
        out = out.select(
            "order_id", "product_id",
            F.when(s % 131 == 0, F.lit(0)).otherwise(F.col("add_to_cart_order"))
            .alias("add_to_cart_order"),
            F.when(s % 127 == 0, F.lit(2)).when(s % 137 == 0, F.lit(None).cast("int"))
            .otherwise(F.col("reordered")).alias("reordered"),
        )
    return out


def parts(spark: SparkSession, sf_dir: str, variant: str = "dirty") -> DataFrame:
    """Products with their aisle and department labels, one row per part."""
    shift = 1 if variant == "clean" else 0
    p = _table(spark, sf_dir, "part")
    return p.select(
        (F.col("p_partkey") + shift).cast("int").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.substr(F.col("p_brand"), F.lit(BRAND_NUMBER_FROM)).cast("int").alias("aisle_id"),
        _lookup(F.col("p_type"), DEPARTMENT_BY_TYPE).cast("int").alias("department_id"),
        F.col("p_brand").alias("aisle"),
        F.col("p_type").alias("department"),
    )


def products(spark: SparkSession, sf_dir: str, variant: str = "dirty") -> DataFrame:
    out = parts(spark, sf_dir, variant).select("product_id", "product_name", "aisle_id",
                                                "department_id")
    if variant == "broken":
        return break_rules(out, "products")
    if variant == "corrupt":
        k = F.col("product_id")
        out = out.select(
            "product_id",
            F.when(k % 113 == 0, F.lit(" ")).when(k % 89 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("product_name")).alias("product_name"),
            "aisle_id", "department_id")
    return out


def aisles(spark: SparkSession, sf_dir: str, variant: str = "dirty") -> DataFrame:
    out = parts(spark, sf_dir, variant).select("aisle_id", "aisle").distinct()
    return break_rules(out, "aisles") if variant == "broken" else out


def departments(spark: SparkSession, sf_dir: str, variant: str = "dirty") -> DataFrame:
    out = parts(spark, sf_dir, variant).select("department_id", "department").distinct()
    return break_rules(out, "departments") if variant == "broken" else out


TABLES = {
    "orders": orders,
    "order_products_prior": order_lines,
    "products": products,
    "aisles": aisles,
    "departments": departments,
}


def write_raw_zone(spark: SparkSession, sf_dir: str, raw_root: str, variant: str = "clean",
                   max_order_id: int | None = None) -> None:
    """Write the five raw CSV sources; ``max_order_id`` keeps only older transactions."""
    write_raw_zones(spark, sf_dir, {raw_root: max_order_id}, variant)


def write_raw_zones(spark: SparkSession, sf_dir: str, zones: dict[str, int | None],
                    variant: str = "clean") -> None:
    """The raw CSV sources of several zones (root -> ``max_order_id``); what they share, the
    orders' sequence and the merged lines, is computed once."""
    for spec in registry.REGISTRY.values():
        df = TABLES[spec.table](spark, sf_dir, variant)
        path = None
        if len(zones) > 1:
            path = fresh_dir(spark, f"raw-{spec.table}")
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        for root, max_order_id in zones.items():
            own = df
            if max_order_id is not None and spec.kind == "transaction":
                own = df.filter(F.col("order_id") <= F.lit(max_order_id))
            write_csv(own, spec.path(root), quoted=spec.quoted)
        if path is not None:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
