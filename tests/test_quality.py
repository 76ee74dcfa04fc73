"""Rule semantics and the single-pass gate (micro fixtures)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import rules as R
from tidemark.operators import quality
from tidemark.plans import rulesets
from tidemark.sources import schemas


def _orders(spark, rows):
    return spark.createDataFrame(rows, schemas.ORDERS)


def _results(spark, df, rules):
    return {r.rule_no: r for r in quality.collect_results(df, rules)}


def test_null_keys_form_one_duplicate_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 4)], "k int, v int")
    res = _results(spark, df, [R.not_null("k"), R.unique("k")])
    assert res[1].violations == 2
    assert res[2].violations == 1


def test_triple_key_counts_once(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    res = _results(spark, df, [R.unique("k")])
    assert res[1].violations == 1
    assert res[1].message == "Found 1 duplicate k values"


def test_composite_key_message(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "order_id int, product_id int")
    res = _results(spark, df, [R.unique("order_id", "product_id")])
    assert res[1].message == "Found 1 duplicate order_id + product_id combinations"
    assert res[1].column_name == "order_id,product_id"


def test_blank_is_empty_or_one_space_only(spark):
    df = spark.createDataFrame([("",), (" ",), ("  ",), ("x",), (None,)], "name string")
    res = _results(spark, df, [R.not_blank("name"), R.not_null("name")])
    assert res[1].violations == 2
    assert res[1].message == "Found 2 empty name values"
    assert res[2].violations == 1


def test_value_rules_skip_nulls(spark):
    df = spark.createDataFrame([(None,), (7,), (-1,), (3,)], "d int")
    res = _results(spark, df, [R.in_range("d", 0, 6), R.positive("d"), R.in_set("d", 0, 1),
                               R.equals("d", 3)])
    assert [res[i].violations for i in (1, 2, 3, 4)] == [2, 1, 3, 2]


def test_missing_column_reports_type_and_skips_rules(spark):
    df = spark.createDataFrame([(1, "prior", 1, 1, 1, 1.0)],
                               "order_id int, eval_set string, order_number int, "
                               "order_dow int, order_hour_of_day int, "
                               "days_since_prior_order double")
    with pytest.raises(quality.QualityGateError) as err:
        quality.gate(df, rulesets.orders_rules(), "ORDERS")
    text = str(err.value)
    assert text == ("ORDERS DATA QUALITY CHECK FAILED:\n"
                    "- Wrong data type for user_id: expected int, found None")
    skipped = [r for r in err.value.results if r.column_name == "user_id" and r.rule_kind != "type"]
    assert skipped and all(r.violations is None for r in skipped)


def test_malformed_id_is_type_error_without_ansi_crash(spark):
    df = spark.createDataFrame([("x", 1, "prior", 1, 1, 1, 2.0), ("5", 1, "prior", 1, 1, 1, None)],
                               "order_id string, user_id int, eval_set string, order_number int, "
                               "order_dow int, order_hour_of_day int, "
                               "days_since_prior_order double")
    results = quality.collect_results(df, rulesets.orders_rules())
    msgs = quality.failures(results)
    assert msgs == ["Wrong data type for order_id: expected int, found string"]


def test_gate_lists_every_failure_in_rule_order(spark):
    df = _orders(spark, [
        (1, None, "prior", 1, 7, 10, None),
        (1, 2, "train", 0, 1, 24, 3.0),
        (2, -1, "prior", 2, -1, 5, 1.0),
    ])
    with pytest.raises(quality.QualityGateError) as err:
        quality.gate(df, rulesets.orders_rules(), "ORDERS", incremental=True)
    assert str(err.value) == "\n".join([
        "ORDERS INCREMENTAL DATA QUALITY CHECK FAILED:",
        "- user_id contains 1 NULL values",
        "- Found 1 duplicate order_id values",
        "- Found 2 invalid order_dow values",
        "- Found 1 invalid order_hour_of_day values",
        "- Found 1 invalid order_number values",
        "- Found 1 invalid user_id values",
        "- Found 1 rows where eval_set is not 'prior'",
    ])


def test_passing_gate_returns_results(spark):
    df = _orders(spark, [(1, 1, "prior", 1, 0, 0, None), (2, 1, "prior", 2, 6, 23, 4.0)])
    res = quality.gate(df, rulesets.orders_rules(), "ORDERS")
    assert len(res) == 19 and quality.failures(res) == []


def test_rule_counts_per_table():
    sizes = {t: len(f()) for t, f in rulesets.RULESETS.items()}
    assert sizes == {"orders": 19, "order_products_prior": 13, "products": 13,
                     "aisles": 7, "departments": 7}


def test_evaluate_is_one_aggregate_plus_one_group_by(spark):
    df = spark.range(100).select(F.col("id").cast("int").alias("order_id"),
                                 (F.col("id") % 3).cast("int").alias("product_id"),
                                 F.lit(1).alias("add_to_cart_order"),
                                 F.lit(0).alias("reordered"))
    plan = quality.evaluate(df, rulesets.order_products_rules())._jdf.queryExecution() \
        .executedPlan().toString()
    # two scans of the input: the global aggregate and the key group-by
    assert plan.count("Range (0, 100") == 2


cells = st.one_of(st.none(), st.integers(min_value=-2, max_value=3))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(cells, cells, cells, cells), min_size=0, max_size=25))
def test_single_pass_equals_one_count_per_rule(spark, rows):
    df = spark.createDataFrame(rows, schemas.ORDER_PRODUCTS)
    rules = rulesets.order_products_rules()
    got = {r.rule_no: r.violations for r in quality.collect_results(df, rules)}
    # the per-rule way: one count action per rule
    expect = {}
    for no, rule in enumerate(rules, start=1):
        if rule.kind == "type":
            expect[no] = 0
        elif rule.kind == "unique":
            expect[no] = (df.groupBy(*rule.columns).count()
                          .filter(F.col("count") > 1).count())
        else:
            expect[no] = df.filter(rule.violation()).count()
    assert got == expect
