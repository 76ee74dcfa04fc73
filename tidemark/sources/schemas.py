"""Table schemas of the retail-orders model.

The types are the ones the quality gate demands (Spark ``dtypes`` strings):
``int`` ids and counters, ``string`` labels, one nullable ``double``.
"""

from __future__ import annotations

from pyspark.sql import types as T

_I, _S, _D = T.IntegerType(), T.StringType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDERS = _schema(
    ("order_id", _I),
    ("user_id", _I),
    ("eval_set", _S),
    ("order_number", _I),
    ("order_dow", _I),
    ("order_hour_of_day", _I),
    ("days_since_prior_order", _D),
)

ORDER_PRODUCTS = _schema(
    ("order_id", _I),
    ("product_id", _I),
    ("add_to_cart_order", _I),
    ("reordered", _I),
)

PRODUCTS = _schema(
    ("product_id", _I),
    ("product_name", _S),
    ("aisle_id", _I),
    ("department_id", _I),
)

AISLES = _schema(("aisle_id", _I), ("aisle", _S))

DEPARTMENTS = _schema(("department_id", _I), ("department", _S))

# Gold fact at order-product grain, in output order.
FACT_COLUMNS = (
    "order_id",
    "product_id",
    "user_id",
    "aisle_id",
    "department_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "add_to_cart_order",
    "reordered",
)

# Control rows: one per transaction file; ``seq`` orders the append-only log.
WATERMARK = T.StructType([
    T.StructField("file_name", T.StringType(), False),
    T.StructField("last_watermark", T.LongType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
    T.StructField("seq", T.LongType(), False),
    T.StructField("epoch", T.LongType(), True),
])

# Batch partition columns of transactional tables: the epoch (how often the history
# was reloaded from scratch) and, in it, the mark the batch started at.
EPOCH_COLUMN = "load_epoch"
BATCH_COLUMN = "load_lo"


def type_map(schema: T.StructType) -> dict[str, str]:
    """``{column: dtype string}`` as ``DataFrame.dtypes`` reports it."""
    return {f.name: f.dataType.simpleString() for f in schema.fields}
