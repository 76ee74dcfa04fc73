"""Source registry: which raw file feeds which table, and along which path.

The five raw files split into a *transaction* path (loaded initially, then
incrementally by the order-id mark) and a *reference* path (always a full
refresh).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import schemas


@dataclass(frozen=True)
class SourceSpec:
    file_name: str          # raw file (or folder of part files) under the raw root
    table: str              # table name in every layer
    schema: T.StructType
    key: tuple[str, ...]    # uniqueness key checked by the gate
    kind: str               # "transaction" | "reference"
    quoted: bool = False    # RFC-4180 doubled quotes inside fields

    def path(self, raw_root: str) -> str:
        return f"{raw_root.rstrip('/')}/{self.file_name}"


ORDERS = SourceSpec("orders.csv", "orders", schemas.ORDERS, ("order_id",), "transaction")
ORDER_PRODUCTS = SourceSpec("order_products__prior.csv", "order_products_prior",
                            schemas.ORDER_PRODUCTS, ("order_id", "product_id"), "transaction")
PRODUCTS = SourceSpec("products.csv", "products", schemas.PRODUCTS, ("product_id",),
                      "reference", quoted=True)
AISLES = SourceSpec("aisles.csv", "aisles", schemas.AISLES, ("aisle_id",), "reference")
DEPARTMENTS = SourceSpec("departments.csv", "departments", schemas.DEPARTMENTS,
                         ("department_id",), "reference")

REGISTRY: dict[str, SourceSpec] = {
    s.file_name: s for s in (ORDERS, ORDER_PRODUCTS, PRODUCTS, AISLES, DEPARTMENTS)
}


def transaction_sources() -> list[SourceSpec]:
    return [s for s in REGISTRY.values() if s.kind == "transaction"]


def reference_sources() -> list[SourceSpec]:
    return [s for s in REGISTRY.values() if s.kind == "reference"]
