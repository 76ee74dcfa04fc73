"""The pipeline's gate on corrupted test data: the full error text must list
exactly the violations an independent DuckDB count finds, in rule order."""

import duckdb
import pytest

from tidemark.checks import oracle
from tidemark.operators.quality import QualityGateError
from tidemark.plans import rulesets
from tidemark.plans.pipeline import Pipeline
from tidemark.sinks import Lakehouse
from tidemark.sources import driver_tables as dt
from tidemark.sources import registry
from tidemark.sources.csv import write_csv

from conftest import SF_SMALL


def _expected(sql: str, title: str) -> str:
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rows = con.execute(f"SELECT message FROM ({sql}) r WHERE violations > 0 ORDER BY rule_no") \
        .fetchall()
    return "\n".join([f"{title} DATA QUALITY CHECK FAILED:"] + [f"- {m}" for m, in rows])


def _raw_zone(spark, root, orders_variant, lines_variant):
    write_csv(dt.orders(spark, SF_SMALL, orders_variant), registry.ORDERS.path(root))
    write_csv(dt.order_lines(spark, SF_SMALL, lines_variant), registry.ORDER_PRODUCTS.path(root))
    for spec in registry.reference_sources():
        write_csv(dt.TABLES[spec.table](spark, SF_SMALL, "clean"), spec.path(root),
                  quoted=spec.quoted)
    return root


def test_corrupted_orders_fail_with_the_exact_report(spark, workdir):
    raw = _raw_zone(spark, f"{workdir}/raw", "corrupt", "dirty")
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    p.reference_load()
    with pytest.raises(QualityGateError) as err:
        p.initial_load()
    prior = f"SELECT * FROM ({oracle.orders_sql('corrupt')}) o WHERE eval_set = 'prior'"
    assert str(err.value) == _expected(oracle.dq_sql(prior, rulesets.orders_rules()), "ORDERS")
    assert p.marks.get("orders.csv") == 0


def test_corrupted_lines_fail_with_the_exact_report(spark, workdir):
    raw = _raw_zone(spark, f"{workdir}/raw", "clean", "corrupt")
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    p.reference_load()
    with pytest.raises(QualityGateError) as err:
        p.initial_load()
    hi = (f"(SELECT max(order_id) FROM ({oracle.orders_sql('clean')}) o "
          f"WHERE eval_set = 'prior')")
    lines = f"SELECT * FROM ({oracle.lines_sql('corrupt')}) l WHERE order_id <= {hi}"
    text = _expected(oracle.dq_sql(lines, rulesets.order_products_rules()), "ORDER_PRODUCTS")
    assert str(err.value) == text
    assert "duplicate order_id + product_id combinations" in text
    assert p.marks.get("orders.csv") == 0
