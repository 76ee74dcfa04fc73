"""Late rows: equal to a plain anti-join, with only doubtful groups joined by row."""

import random

from tidemark.operators.late import doubtful_groups, missing_rows

SCHEMA = "order_id int, product_id int, cart int"


def frames(spark, seed):
    rng = random.Random(seed)
    history = [(o, p, 1) for o in range(60) for p in range(rng.randint(0, 6))]
    history += [(7, p, 1) for p in range(100, 400)]                # a hot order
    rows = [r for r in history if rng.random() > 0.03]             # fewer rows than loaded
    rows += [(rng.randint(0, 70), rng.randint(0, 9), 2) for _ in range(25)]
    rows += rows[:5] + [(None, 3, 1), (4, None, 1), (None, None, 1), (None, 3, 1)]
    history += [(None, 3, 1), (5, None, 1)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(history, SCHEMA)


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_missing_rows_equal_an_anti_join(spark):
    for seed in range(4):
        rows, history = frames(spark, seed)
        want = rows.join(history.select("order_id", "product_id"), ["order_id", "product_id"], "left_anti")
        got = missing_rows(rows, history, "order_id", "product_id")
        assert got.columns == rows.columns
        assert order(got.collect()) == order(want.select(*rows.columns).collect())


def test_groups_that_arrived_whole_are_not_joined(spark):
    history = spark.createDataFrame([(o, p, 1) for o in range(50) for p in range(5)], SCHEMA)
    late = spark.createDataFrame([(3, 77, 1)], SCHEMA)
    assert [r.order_id for r in doubtful_groups(history.union(late), history, "order_id", "product_id").collect()] == [3]
    assert doubtful_groups(history, history, "order_id", "product_id").count() == 0
    assert order(missing_rows(history.union(late), history, "order_id", "product_id").collect()) == [(3, 77, 1)]


def test_empty_frames(spark):
    rows, history = frames(spark, 1)
    assert missing_rows(rows.limit(0), history, "order_id", "product_id").count() == 0
    assert missing_rows(rows, history.limit(0), "order_id", "product_id").count() == rows.count()
