"""Gold star schema: the order-product fact and the dimensions.

Join strategy for scale. The fact is ``lines x orders x products``:

* products is a dimension; it is broadcast only if a count and the size of its
  decoded rows (one partial row per task; files may be far smaller than what they
  decode to) prove it small, and only the three columns the fact needs are shipped. The broadcast join runs map-side in
  the scan stage of the lines, so lines of unknown products are dropped
  before any shuffle;
* lines x orders is big x big on ``order_id`` (orders are unique per key
  after the gate): a sort-merge join whose hot keys AQE's skew-join splits
  (the orders side of a key is a single row, so replicating it is cheap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import job_label
from ..sources.schemas import FACT_COLUMNS

DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 << 20


def counted_rows(df: DataFrame) -> int:
    """Rows of ``df``; each task sends one number."""
    with job_label(df.sparkSession, "row count"):
        return df.count()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (for file scans: file sizes, scaled to the columns)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _fixed_width(df: DataFrame) -> int:
    """Bytes of a decoded row without what its variable columns point to: a word a column
    and one for the nulls."""
    return 8 * (len(df.columns) + 1)


def _variable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]


def measured(*frames: DataFrame) -> list[tuple[int, int]]:
    """(rows, bytes of the decoded rows) of each frame, all in one job; each task sends one row."""
    parts = []
    for k, df in enumerate(frames):
        held = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in _variable(df)]
        text = F.coalesce(F.sum(sum(held[1:], held[0]).cast("long")), F.lit(0)) if held else F.lit(0)
        parts.append(df.agg(F.count("*").alias("n"), text.cast("long").alias("b")).withColumn("k", F.lit(k)))
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    with job_label(frames[0].sparkSession, "sizes"):
        found = {r["k"]: (r["n"], r["b"]) for r in everything.collect()}
    return [(found[k][0], found[k][1] + found[k][0] * _fixed_width(df)) for k, df in enumerate(frames)]


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      rows: int | None = None,
                      max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                      size: tuple[int, int] | None = None) -> DataFrame:
    """Broadcast hint only when the side holds at most ``max_rows`` rows and its decoded
    rows at most ``max_bytes``.

    Beyond the bounds the frame is returned unhinted and the planner picks a
    shuffle join. ``rows`` passes a count already made by the caller (enough where no
    column is of variable width), ``size`` what :func:`measured` gave.
    """
    if size is None and estimated_bytes(df) > max_bytes:
        return df                     # already its files are larger
    if size is None:
        size = measured(df)[0] if rows is None or _variable(df) else (rows, rows * _fixed_width(df))
    return F.broadcast(df) if size[0] <= max_rows and size[1] <= max_bytes else df


def build_fact(lines: DataFrame, orders: DataFrame, products: DataFrame,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               product_rows: int | None = None) -> DataFrame:
    """Inner joins lines-orders on order_id and lines-products on product_id.

    Unmatched lines are dropped silently (no referential rule exists).
    ``product_rows`` is a bound on the products already measured by the caller.
    """
    dims = bounded_broadcast(products.select("product_id", "aisle_id", "department_id"),
                             broadcast_max_rows, rows=product_rows)
    order_cols = orders.select("order_id", "user_id", "order_number", "order_dow",
                               "order_hour_of_day", "days_since_prior_order")
    line_cols = lines.select("order_id", "product_id", "add_to_cart_order", "reordered")
    return (line_cols.join(dims, on="product_id", how="inner")
            .join(order_cols, on="order_id", how="inner")
            .select(*FACT_COLUMNS))


def orphan_lines(lines: DataFrame, orders: DataFrame, products: DataFrame,
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """What the fact's inner joins drop silently, as counts per reason.

    Rows ``(reason, lines)``: lines whose ``order_id`` has no order, and lines
    whose ``product_id`` has no product (a line may count under both). One scan
    of the lines, left-joined with the size-checked products and the orders.
    """
    keys = lines.select("order_id", "product_id")
    known_order = orders.select("order_id").distinct().withColumn("_order", F.lit(True))
    known_product = bounded_broadcast(products.select("product_id").distinct()
                                      .withColumn("_product", F.lit(True)), broadcast_max_rows)
    return (keys.join(known_product, "product_id", "left").join(known_order, "order_id", "left")
            .agg(F.count_if(F.col("_order").isNull()).alias("o"),
                 F.count_if(F.col("_product").isNull()).alias("p"))
            .select(F.inline(F.array(
                F.struct(F.lit("unknown_order").alias("reason"), F.col("o").alias("lines")),
                F.struct(F.lit("unknown_product").alias("reason"), F.col("p").alias("lines"))))))


def build_dim(silver: DataFrame) -> DataFrame:
    """Dimensions are identity copies of their Silver tables."""
    return silver


def star(fact: DataFrame, dim_product: DataFrame, dim_aisle: DataFrame,
         dim_department: DataFrame,
         broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Fact linked to its dimensions by product, aisle and department keys."""
    dims = [dim_product.select("product_id", "product_name"), dim_aisle.select("aisle_id", "aisle"),
            dim_department.select("department_id", "department")]
    p, a, d = (bounded_broadcast(df, broadcast_max_rows, size=size) for df, size in zip(dims, measured(*dims)))
    return (fact.join(p, "product_id", "inner").join(a, "aisle_id", "inner")
            .join(d, "department_id", "inner")
            .select(*FACT_COLUMNS, "product_name", "aisle", "department"))


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows in no particular order (a quick look at a result)."""
    return df.limit(n)
