"""The rule sets of the five tables, in evaluation order.

Order per table: type of every column, required NULLs, key uniqueness, then
the value rules. Each set is plain data and can be extended or replaced.
The lists below (which columns each rule covers, in which order) are fixed
values: reports must list the same rules in the same order.
"""

from __future__ import annotations

from ..functions.rules import (Rule, equals, in_range, in_set, not_blank, not_null, positive,
                               types_of, unique)
from ..sources import schemas

# Gate titles, the accepted eval_set and the value domains.
TITLES = {
    "orders": "ORDERS",
    "order_products_prior": "ORDER_PRODUCTS",
    "products": "PRODUCTS",
    "aisles": "AISLES",
    "departments": "DEPARTMENTS",
}
PRIOR = "prior"
DOW_RANGE = (0, 6)
HOUR_RANGE = (0, 23)
REORDERED_VALUES = (0, 1)


def orders_rules() -> list[Rule]:
    return [
        *types_of(schemas.ORDERS),
        *(not_null(c) for c in ("order_id", "user_id", "eval_set", "order_number",
                                 "order_dow", "order_hour_of_day")),
        unique("order_id"),
        in_range("order_dow", *DOW_RANGE),
        in_range("order_hour_of_day", *HOUR_RANGE),
        positive("order_number"),
        positive("user_id"),
        equals("eval_set", PRIOR),
    ]


def order_products_rules() -> list[Rule]:
    return [
        *types_of(schemas.ORDER_PRODUCTS),
        *(not_null(c) for c in ("order_id", "product_id", "add_to_cart_order", "reordered")),
        unique("order_id", "product_id"),
        in_set("reordered", *REORDERED_VALUES),
        positive("add_to_cart_order"),
        positive("order_id"),
        positive("product_id"),
    ]


def products_rules() -> list[Rule]:
    return [
        *types_of(schemas.PRODUCTS),
        *(not_null(c) for c in ("product_id", "product_name", "aisle_id", "department_id")),
        unique("product_id"),
        positive("product_id"),
        positive("aisle_id"),
        positive("department_id"),
        not_blank("product_name"),
    ]


def aisles_rules() -> list[Rule]:
    return [
        *types_of(schemas.AISLES),
        *(not_null(c) for c in ("aisle_id", "aisle")),
        unique("aisle_id"),
        positive("aisle_id"),
        not_blank("aisle"),
    ]


def departments_rules() -> list[Rule]:
    return [
        *types_of(schemas.DEPARTMENTS),
        *(not_null(c) for c in ("department_id", "department")),
        unique("department_id"),
        positive("department_id"),
        not_blank("department"),
    ]


RULESETS = {
    "orders": orders_rules,
    "order_products_prior": order_products_rules,
    "products": products_rules,
    "aisles": aisles_rules,
    "departments": departments_rules,
}
