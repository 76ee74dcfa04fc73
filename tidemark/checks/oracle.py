"""DuckDB oracle SQL for every registered query with an SQL equivalent.

The driver's test tables are pre-registered as views; the adapter is
re-expressed here as SQL CTEs, and each rule predicate is written in SQL
(three-valued logic: ``count(*) FILTER (WHERE p)`` skips NULL predicates).
"""

from __future__ import annotations

from ..functions.rules import Rule
from ..plans import rulesets
from ..sources import driver_tables as dt
from ..sources import registry
from ..sources.schemas import FACT_COLUMNS

MARK = "(SELECT CAST(floor(0.9 * count(*)) AS BIGINT) - 1 FROM orders)"
SPLIT = "(SELECT CAST(floor(0.9 * count(*)) AS BIGINT) FROM orders)"


def _lit(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _case(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {_lit(k)} THEN {_lit(v) if isinstance(v, str) else v}"
                     for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def orders_sql(variant: str = "dirty") -> str:
    s = 1 if variant == "clean" else 0
    base = f"""SELECT CAST(o_orderkey + {s} AS INTEGER) AS order_id,
        CAST(o_custkey + {s} AS INTEGER) AS user_id,
        {_case('o_orderstatus', dt.EVAL_SET_BY_STATUS)} AS eval_set,
        CAST(row_number() OVER w AS INTEGER) AS order_number,
        CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
        CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
        CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE)
            AS days_since_prior_order
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
    if variant != "corrupt":
        return base
    return f"""SELECT order_id,
        CASE WHEN order_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
        eval_set,
        CASE WHEN order_id % 109 = 0 THEN 0 ELSE order_number END AS order_number,
        CASE WHEN order_id % 101 = 0 THEN 7 WHEN order_id % 103 = 0 THEN -1
             ELSE order_dow END AS order_dow,
        CASE WHEN order_id % 107 = 0 THEN 24 ELSE order_hour_of_day END AS order_hour_of_day,
        days_since_prior_order
      FROM ({base}) b"""


def lines_sql(variant: str = "dirty") -> str:
    s = 1 if variant == "clean" else 0
    base = f"""SELECT CAST(l_orderkey + {s} AS INTEGER) AS order_id,
        CAST(l_partkey + {s} AS INTEGER) AS product_id,
        CAST(l_linenumber AS INTEGER) AS add_to_cart_order,
        CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS reordered
      FROM lineitem"""
    if variant == "clean":
        return f"""SELECT order_id, product_id, min(add_to_cart_order) AS add_to_cart_order,
        max(reordered) AS reordered FROM ({base}) b GROUP BY order_id, product_id"""
    if variant == "corrupt":
        return f"""SELECT order_id, product_id,
        CASE WHEN (order_id + product_id) % 131 = 0 THEN 0 ELSE add_to_cart_order END
            AS add_to_cart_order,
        CASE WHEN (order_id + product_id) % 127 = 0 THEN 2
             WHEN (order_id + product_id) % 137 = 0 THEN NULL ELSE reordered END AS reordered
      FROM ({base}) b"""
    return base


def parts_sql(variant: str = "dirty") -> str:
    s = 1 if variant == "clean" else 0
    return f"""SELECT CAST(p_partkey + {s} AS INTEGER) AS product_id, p_name AS product_name,
        CAST(substr(p_brand, {dt.BRAND_NUMBER_FROM}) AS INTEGER) AS aisle_id,
        CAST({_case('p_type', dt.DEPARTMENT_BY_TYPE)} AS INTEGER) AS department_id,
        p_brand AS aisle, p_type AS department
      FROM part"""


def products_sql(variant: str = "dirty") -> str:
    base = f"SELECT product_id, product_name, aisle_id, department_id FROM ({parts_sql(variant)}) q"
    if variant != "corrupt":
        return base
    return f"""SELECT product_id,
        CASE WHEN product_id % 113 = 0 THEN ' ' WHEN product_id % 89 = 0 THEN NULL
             ELSE product_name END AS product_name,
        aisle_id, department_id FROM ({base}) b"""


def aisles_sql(variant: str = "dirty") -> str:
    return f"SELECT DISTINCT aisle_id, aisle FROM ({parts_sql(variant)}) q"


def departments_sql(variant: str = "dirty") -> str:
    return f"SELECT DISTINCT department_id, department FROM ({parts_sql(variant)}) q"


def broken_sql(source: str, table: str, columns: list[tuple[str, str]]) -> str:
    """The edits of the adapter's ``BROKEN`` on a dirty table."""
    key, edits = dt.BROKEN[table]
    out = []
    for name, kind in columns:
        whens = " ".join(
            f"WHEN ({key}) % {m} = 0 THEN " + ("NULL" if v is None else _lit(v) if isinstance(v, str) else str(v))
            for c, m, v in edits if c == name)
        out.append(f"CAST(CASE {whens} ELSE {name} END AS {kind}) AS {name}" if whens else name)
    return f"SELECT {', '.join(out)} FROM ({source}) b"


TABLE_SQL = {
    "orders": orders_sql,
    "order_products_prior": lines_sql,
    "products": products_sql,
    "aisles": aisles_sql,
    "departments": departments_sql,
}


def fact_sql(variant: str = "dirty") -> str:
    cols = {"user_id": "o", "order_number": "o", "order_dow": "o", "order_hour_of_day": "o",
            "days_since_prior_order": "o", "aisle_id": "p", "department_id": "p"}
    select = ", ".join(f"{cols.get(c, 'l')}.{c}" for c in FACT_COLUMNS)
    return f"""SELECT {select}
      FROM ({lines_sql(variant)}) l
      JOIN (SELECT * FROM ({orders_sql(variant)}) x WHERE eval_set = 'prior') o
        ON l.order_id = o.order_id
      JOIN ({products_sql(variant)}) p ON l.product_id = p.product_id"""


def star_sql(variant: str = "dirty", fact: str | None = None) -> str:
    fact = fact or fact_sql(variant)
    cols = ", ".join(f"f.{c}" for c in FACT_COLUMNS)
    return f"""SELECT {cols}, p.product_name, a.aisle, d.department
      FROM ({fact}) f
      JOIN ({products_sql(variant)}) p ON f.product_id = p.product_id
      JOIN ({aisles_sql(variant)}) a ON f.aisle_id = a.aisle_id
      JOIN ({departments_sql(variant)}) d ON f.department_id = d.department_id"""


# -- data quality ---------------------------------------------------------------------
# The 59 rules in order, spelled out here once more so that a limit or a text
# changed by mistake in the library shows. (kind, column, SQL of a violation or the type, text)
_NULLS = "{c} contains {n} NULL values"
_INVALID = "Found {n} invalid {c} values"
_EMPTY = "Found {n} empty {c} values"
_TWICE = "Found {n} duplicate {c} values"
_TYPE = "Wrong data type for {c}: expected {e}, found {a}"

SPELLED = {
    "orders": [
        ("type", "order_id", "int", _TYPE),
        ("type", "user_id", "int", _TYPE),
        ("type", "eval_set", "string", _TYPE),
        ("type", "order_number", "int", _TYPE),
        ("type", "order_dow", "int", _TYPE),
        ("type", "order_hour_of_day", "int", _TYPE),
        ("type", "days_since_prior_order", "double", _TYPE),
        ("not_null", "order_id", "order_id IS NULL", _NULLS),
        ("not_null", "user_id", "user_id IS NULL", _NULLS),
        ("not_null", "eval_set", "eval_set IS NULL", _NULLS),
        ("not_null", "order_number", "order_number IS NULL", _NULLS),
        ("not_null", "order_dow", "order_dow IS NULL", _NULLS),
        ("not_null", "order_hour_of_day", "order_hour_of_day IS NULL", _NULLS),
        ("unique", "order_id", "order_id", _TWICE),
        ("range", "order_dow", "order_dow < 0 OR order_dow > 6", _INVALID),
        ("range", "order_hour_of_day", "order_hour_of_day < 0 OR order_hour_of_day > 23", _INVALID),
        ("positive", "order_number", "order_number <= 0", _INVALID),
        ("positive", "user_id", "user_id <= 0", _INVALID),
        ("equals", "eval_set", "eval_set <> 'prior'", "Found {n} rows where eval_set is not 'prior'"),
    ],
    "order_products_prior": [
        ("type", "order_id", "int", _TYPE),
        ("type", "product_id", "int", _TYPE),
        ("type", "add_to_cart_order", "int", _TYPE),
        ("type", "reordered", "int", _TYPE),
        ("not_null", "order_id", "order_id IS NULL", _NULLS),
        ("not_null", "product_id", "product_id IS NULL", _NULLS),
        ("not_null", "add_to_cart_order", "add_to_cart_order IS NULL", _NULLS),
        ("not_null", "reordered", "reordered IS NULL", _NULLS),
        ("unique", "order_id,product_id", "order_id, product_id",
         "Found {n} duplicate order_id + product_id combinations"),
        ("in_set", "reordered", "reordered <> 0 AND reordered <> 1", _INVALID),
        ("positive", "add_to_cart_order", "add_to_cart_order <= 0", _INVALID),
        ("positive", "order_id", "order_id <= 0", _INVALID),
        ("positive", "product_id", "product_id <= 0", _INVALID),
    ],
    "products": [
        ("type", "product_id", "int", _TYPE),
        ("type", "product_name", "string", _TYPE),
        ("type", "aisle_id", "int", _TYPE),
        ("type", "department_id", "int", _TYPE),
        ("not_null", "product_id", "product_id IS NULL", _NULLS),
        ("not_null", "product_name", "product_name IS NULL", _NULLS),
        ("not_null", "aisle_id", "aisle_id IS NULL", _NULLS),
        ("not_null", "department_id", "department_id IS NULL", _NULLS),
        ("unique", "product_id", "product_id", _TWICE),
        ("positive", "product_id", "product_id <= 0", _INVALID),
        ("positive", "aisle_id", "aisle_id <= 0", _INVALID),
        ("positive", "department_id", "department_id <= 0", _INVALID),
        ("not_blank", "product_name", "product_name = '' OR product_name = ' '", _EMPTY),
    ],
    "aisles": [
        ("type", "aisle_id", "int", _TYPE),
        ("type", "aisle", "string", _TYPE),
        ("not_null", "aisle_id", "aisle_id IS NULL", _NULLS),
        ("not_null", "aisle", "aisle IS NULL", _NULLS),
        ("unique", "aisle_id", "aisle_id", _TWICE),
        ("positive", "aisle_id", "aisle_id <= 0", _INVALID),
        ("not_blank", "aisle", "aisle = '' OR aisle = ' '", _EMPTY),
    ],
    "departments": [
        ("type", "department_id", "int", _TYPE),
        ("type", "department", "string", _TYPE),
        ("not_null", "department_id", "department_id IS NULL", _NULLS),
        ("not_null", "department", "department IS NULL", _NULLS),
        ("unique", "department_id", "department_id", _TWICE),
        ("positive", "department_id", "department_id <= 0", _INVALID),
        ("not_blank", "department", "department = '' OR department = ' '", _EMPTY),
    ],
}


def _message(text: str, column: str, n: str) -> str:
    head, _, tail = text.replace("{c}", column).partition("{n}")
    return f"CASE WHEN {n} > 0 THEN {_lit(head)} || CAST({n} AS VARCHAR) || {_lit(tail)} END"


def dq_sql(source_sql: str, rules: str | list[Rule], found: dict[str, str | None] | None = None) -> str:
    """The rules of a table (its name, or its rule set) over ``source_sql``. ``found`` names the
    types of columns that are not of the declared one; None: missing."""
    table = rules if isinstance(rules, str) else next(t for t, make in rulesets.RULESETS.items() if make() == rules)
    found = found or {}
    counted, ctes, selects = [], [], []
    for no, (kind, column, what, text) in enumerate(SPELLED[table], start=1):
        head = f"SELECT CAST({no} AS INTEGER) AS rule_no, {_lit(kind)} AS rule_kind, " \
               f"{_lit(column)} AS column_name, "
        if kind == "type" and column in found:
            text = text.replace("{c}", column).replace("{e}", what).replace("{a}", str(found[column]))
            selects.append(head + f"CAST(1 AS BIGINT) AS violations, {_lit(text)} AS message")
        elif any(found.get(c, "") is None for c in column.split(",")):
            selects.append(head + "CAST(NULL AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS message")
        elif kind == "type":
            selects.append(head + "CAST(0 AS BIGINT) AS violations, "
                                  "CAST(NULL AS VARCHAR) AS message")
        elif kind == "unique":
            ctes.append(f"u{no} AS (SELECT count(*) AS n FROM "
                        f"(SELECT {what} FROM t GROUP BY {what} HAVING count(*) > 1) k)")
            selects.append(head + f"n AS violations, {_message(text, column, 'n')} AS message FROM u{no}")
        else:
            counted.append(f"count(*) FILTER (WHERE {what}) AS r{no}")
            selects.append(head + f"r{no} AS violations, {_message(text, column, f'r{no}')} AS message "
                                  f"FROM c")
    with_parts = [f"t AS ({source_sql})", f"c AS (SELECT {', '.join(counted)} FROM t)", *ctes]
    return "WITH " + ",\n".join(with_parts) + "\n" + "\nUNION ALL ".join(selects)


_TYPES = {"int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def _dq(table: str, variant: str = "dirty", scope: str = "all") -> str:
    src = TABLE_SQL[table]("dirty" if variant == "broken" else variant)
    if variant == "broken":
        schema = next(s.schema for s in registry.REGISTRY.values() if s.table == table)
        src = broken_sql(src, table, [(f.name, _TYPES[f.dataType.simpleString()]) for f in schema.fields])
    if table == "orders" and scope == "prior":
        src = f"SELECT * FROM ({src}) s WHERE eval_set = 'prior'"
    if table == "orders" and scope == "new":
        src = f"SELECT * FROM ({src}) s WHERE order_id > {MARK}"
    return dq_sql(src, table)


def _dq_types_orders() -> str:
    src = f"""SELECT CASE WHEN order_id % 53 = 0 THEN NULL ELSE order_id END AS order_id,
        CASE WHEN order_id % 59 = 0 THEN NULL ELSE user_id END AS user_id, eval_set, order_number,
        order_hour_of_day,
        CASE WHEN order_id % 61 = 0 THEN NULL ELSE days_since_prior_order END AS days_since_prior_order
      FROM ({orders_sql()}) o"""
    return dq_sql(src, "orders", {"order_id": "string", "user_id": "bigint",
                                  "days_since_prior_order": "string", "order_dow": None})


def _dq_inferred(table: str, columns: str, found: dict[str, str]) -> str:
    """``columns``: what the value rules see of the rewritten columns (a value that does not cast
    violates no value rule, so any harmless one stands for it)."""
    return dq_sql(f"SELECT {columns} FROM ({TABLE_SQL[table]()}) s", table, found)


def _late_lines() -> str:
    return f"""SELECT order_id, CAST(order_id + 1000000 AS INTEGER) AS product_id,
        CAST(1 AS INTEGER) AS add_to_cart_order, CAST(0 AS INTEGER) AS reordered
      FROM ({orders_sql('clean')}) o WHERE order_id % 13 = 0 AND order_id <= {_final_mark()}"""


# -- pipeline expectations ----------------------------------------------------------------
def _first_mark() -> str:
    return (f"(SELECT CAST(max(order_id) AS BIGINT) FROM ({orders_sql('clean')}) o "
            f"WHERE eval_set = 'prior' AND order_id <= {SPLIT})")


def _final_mark() -> str:
    return (f"(SELECT CAST(max(order_id) AS BIGINT) FROM ({orders_sql('clean')}) o "
            f"WHERE eval_set = 'prior')")


def _marks(value_sql: str) -> str:
    return (f"SELECT file_name, {value_sql} AS last_watermark FROM "
            f"(VALUES ('orders.csv'), ('order_products__prior.csv')) v(file_name)")


def _guard(status: str, mode: str, before: str, after: str, top: str) -> str:
    return (f"SELECT {_lit(status)} AS status, {_lit(mode)} AS load_mode, CAST({before} AS BIGINT) AS mark_before, "
            f"CAST({after} AS BIGINT) AS mark_after, (SELECT count(*) FROM ({orders_sql('clean')}) o "
            f"WHERE eval_set = 'prior' AND order_id > {before} AND order_id <= {top}) AS new_orders")


def _layer_counts() -> str:
    prior = f"(SELECT count(*) FROM ({orders_sql('clean')}) o WHERE eval_set = 'prior')"
    lines = f"(SELECT count(*) FROM ({lines_sql('clean')}) l WHERE order_id <= {_final_mark()})"
    fact = f"(SELECT count(*) FROM ({fact_sql('clean')}) f)"
    prods = f"(SELECT count(*) FROM ({products_sql('clean')}) p)"
    aisles = f"(SELECT count(*) FROM ({aisles_sql('clean')}) a)"
    deps = f"(SELECT count(*) FROM ({departments_sql('clean')}) d)"
    rows = [("bronze", "orders", prior), ("bronze", "order_products_prior", lines),
            ("silver", "orders", prior), ("silver", "order_products_prior", lines),
            ("gold", "fact_order_products", fact),
            ("bronze", "products", prods), ("bronze", "aisles", aisles),
            ("bronze", "departments", deps),
            ("silver", "products", prods), ("silver", "aisles", aisles),
            ("silver", "departments", deps),
            ("gold", "dim_product", prods), ("gold", "dim_aisle", aisles),
            ("gold", "dim_department", deps)]
    return "\nUNION ALL ".join(f"SELECT {_lit(a)} AS layer, {_lit(b)} AS table_name, "
                               f"CAST({c} AS BIGINT) AS row_count" for a, b, c in rows)


def _stored_sizes() -> str:
    orders = f"SELECT order_id FROM ({orders_sql('clean')}) o WHERE eval_set = 'prior'"
    lines = f"SELECT order_id FROM ({lines_sql('clean')}) l WHERE order_id <= {_final_mark()}"
    fact = f"SELECT order_id FROM ({fact_sql('clean')}) f"
    rows = [("bronze", "orders", orders), ("bronze", "order_products_prior", lines), ("silver", "orders", orders),
            ("silver", "order_products_prior", lines), ("gold", "fact_order_products", fact)]
    return "\nUNION ALL ".join(f"SELECT {_lit(a)} AS layer, {_lit(b)} AS table_name, count(*) AS row_count, "
                               f"max(order_id) AS high_water FROM ({sql}) s" for a, b, sql in rows)


def _load_decision() -> str:
    return f"""SELECT row_count,
        CASE WHEN row_count = 0 THEN 'initial' ELSE 'incremental' END AS load_mode,
        CAST({MARK} AS BIGINT) AS last_watermark, current_max, new_rows, batch_hi,
        CASE WHEN new_rows = 0 THEN 'NO_NEW_DATA' ELSE 'NEW_DATA' END AS guard_status
      FROM (SELECT count(*) FILTER (WHERE eval_set = 'prior') AS row_count,
                   count(*) FILTER (WHERE order_id > {MARK}) AS new_rows,
                   max(order_id) AS current_max,
                   max(order_id) FILTER (WHERE eval_set = 'prior') AS batch_hi
            FROM ({orders_sql()}) o) g"""


def _quoted_products() -> str:
    return f"""SELECT p.product_id, p.product_name || ', "' || x.p_brand || '"' AS product_name,
        p.aisle_id, p.department_id
      FROM ({products_sql()}) p JOIN part x ON p.product_id = CAST(x.p_partkey AS INTEGER)"""


def _orphans() -> str:
    lines, prior = lines_sql(), f"SELECT * FROM ({orders_sql()}) o WHERE eval_set = 'prior'"
    return f"""SELECT 'unknown_order' AS reason, count(*) AS lines FROM ({lines}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({prior}) o WHERE o.order_id = l.order_id)
      UNION ALL
      SELECT 'unknown_product' AS reason, count(*) AS lines FROM ({lines}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({products_sql()}) p WHERE p.product_id = l.product_id)"""


def oracle_sql() -> dict[str, str]:
    o, l = orders_sql(), lines_sql()
    return {
        "fact_full": fact_sql(),
        "fact_incremental": f"SELECT * FROM ({fact_sql()}) f WHERE order_id > {MARK}",
        "fact_incremental_equals_full": fact_sql(),
        "bronze_orders": f"SELECT * FROM ({o}) o WHERE eval_set = 'prior'",
        "new_orders": f"SELECT * FROM ({o}) o WHERE order_id > {MARK}",
        "new_order_products": f"SELECT * FROM ({l}) l WHERE order_id > {MARK}",
        "high_water_raw": f"SELECT max(order_id) AS high_water FROM ({o}) o",
        "high_water_prior": f"SELECT max(order_id) AS high_water FROM ({o}) o "
                            f"WHERE eval_set = 'prior'",
        "bronze_row_count": f"SELECT count(*) AS row_count FROM ({o}) o WHERE eval_set = 'prior'",
        "load_decision": _load_decision(),
        "dup_keys_order_products": f"SELECT order_id, product_id, count(*) AS n FROM ({l}) l "
                                   f"GROUP BY order_id, product_id HAVING count(*) > 1",
        "orphan_lines": _orphans(),
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
        "dq_types_orders": _dq_types_orders(),
        "dq_types_orders_inferred": _dq_inferred(
            "orders", "order_id, 1 AS user_id, '1' AS eval_set, order_number, 1 AS order_dow, "
            "1 AS order_hour_of_day, days_since_prior_order",
            {"user_id": "date", "eval_set": "int", "order_number": "double", "order_dow": "boolean",
             "order_hour_of_day": "timestamp"}),
        "dq_types_order_products": _dq_inferred(
            "order_products_prior", "1 AS order_id, product_id, 1 AS add_to_cart_order, reordered",
            {"order_id": "date", "product_id": "double", "add_to_cart_order": "bigint", "reordered": "boolean"}),
        "dq_types_products": _dq_inferred(
            "products", "product_id + 1 AS product_id, 'name' AS product_name, aisle_id, 1 AS department_id",
            {"product_id": "string", "product_name": "int", "aisle_id": "double", "department_id": "timestamp"}),
        "dq_types_aisles": _dq_inferred("aisles", "1 AS aisle_id, 'name' AS aisle",
                                        {"aisle_id": "boolean", "aisle": "int"}),
        "dq_types_departments": _dq_inferred("departments", "department_id, 'name' AS department",
                                             {"department_id": "double", "department": "date"}),
        "late_lines": _late_lines(),
        "dq_clean_orders": _dq("orders", "clean", scope="prior"),
        "dq_clean_order_products": _dq("order_products_prior", "clean"),
        "dim_product": products_sql(),
        "dim_aisle": aisles_sql(),
        "dim_department": departments_sql(),
        "star_join": star_sql(),
        "preview_fact": f"SELECT least(10, count(*)) AS preview_rows, least(10, count(*)) AS in_fact "
                        f"FROM ({fact_sql()}) f",
        "csv_orders": o,
        "csv_products_quoted": _quoted_products(),
        "pipeline_fact": fact_sql("clean"),
        "pipeline_gate_failure": dq_sql(
            f"SELECT * FROM ({orders_sql('clean')}) o WHERE order_id > {_first_mark()}", "orders"),
        "pipeline_fact_increment": f"SELECT * FROM ({fact_sql('clean')}) f "
                                   f"WHERE order_id > {_first_mark()}",
        "pipeline_star": star_sql("clean"),
        "pipeline_layer_counts": _layer_counts(),
        "stored_sizes": _stored_sizes(),
        "guard_initial": _guard("SUCCESS", "initial", "0", _first_mark(), SPLIT),
        "guard_incremental": _guard("SUCCESS", "incremental", _first_mark(), _final_mark(), _final_mark()),
        "guard_no_new_data": _guard("NO_NEW_DATA", "incremental", _final_mark(), _final_mark(), _final_mark()),
        "watermark_updated_at": "SELECT file_name, true AS all_past, true AS in_order FROM "
                                "(VALUES ('orders.csv'), ('order_products__prior.csv')) v(file_name)",
        "watermark_after_initial": _marks(_first_mark()),
        "watermark_after_incremental": _marks(_final_mark()),
    }
