"""The driver contract: entry() runs, every oracle is registered and runs in
DuckDB, and Spark and oracle agree on column names and types."""

import re

import duckdb

import __spark_entry__ as contract

from conftest import SF_SMALL

DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
              "boolean": "BOOLEAN"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _duck():
    import os
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_entry_returns_the_fact(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["order_id", "product_id"] and len(df.columns) == 11
    assert df.count() == 1995                      # FIXTURES.md, sf0.001


def test_every_oracle_is_registered_and_runs():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries)
    # the corpus operators and their pipeline are optional and have no SQL form
    assert all(q == "pipeline" or re.match(r"op\d+_", q) for q in set(queries) - set(oracles))
    con = _duck()
    for name, sql in oracles.items():
        con.execute(f"DESCRIBE ({sql})").fetchall()   # parses and binds


def test_spark_and_oracle_schemas_agree(spark):
    con = _duck()
    oracles = contract.oracle_sql()
    for name, fn in contract.queries().items():
        if name not in oracles or name.startswith(("pipeline", "watermark_", "guard_", "csv_", "dq_types")):
            continue                                   # those run whole loads; see compare_oracle
        spark_types = {c: DUCK_TYPES.get(t, t) for c, t in fn(spark, SF_SMALL).dtypes}
        duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE ({oracles[name]})").fetchall()}
        assert spark_types == duck_types, name
