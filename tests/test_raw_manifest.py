"""Append-style raw zones: unchanged files without keys above the mark are
skipped, and the loaded tables equal a full re-read."""

import time

from tidemark.plans.pipeline import NO_NEW_DATA, SUCCESS, Pipeline
from tidemark.sinks import Lakehouse

from conftest import LINES_HEADER, ORDERS_HEADER, line_row, order_row, write_text


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def drop(raw, name, order_ids, lines):
    root = _local(raw)
    write_text(f"{root}/orders.csv/{name}.csv", ORDERS_HEADER, [order_row(i) for i in order_ids])
    write_text(f"{root}/order_products__prior.csv/{name}.csv", LINES_HEADER,
               [line_row(o, p) for o, p in lines])


def keys(p):
    return sorted((r["order_id"], r["product_id"]) for r in p.fact().collect())


def test_unchanged_files_are_skipped_and_results_stay_whole(spark, workdir):
    raw = f"{workdir}/raw"
    root = _local(raw)
    write_text(f"{root}/products.csv", "product_id,product_name,aisle_id,department_id",
               ["1,Salt,1,1", "2,Bananas,2,1", "3,Milk,2,2"])
    write_text(f"{root}/aisles.csv", "aisle_id,aisle", ["1,spices", "2,fresh"])
    write_text(f"{root}/departments.csv", "department_id,department", ["1,pantry", "2,dairy"])
    drop(raw, "d1", range(1, 13), [(o, 1) for o in range(1, 13)])
    store = Lakehouse(spark, f"{workdir}/lake")
    p = Pipeline(spark, store, raw, skip_unchanged_raw=True)
    p.reference_load()
    assert p.run().hi == 12

    drop(raw, "d2", range(13, 16), [(o, 2) for o in range(13, 16)] + [(16, 1)])   # early line
    r = p.run()
    assert (r.status, r.hi) == (SUCCESS, 15)
    # the initial load recorded the orders files, not the lines files
    assert r.raw_files == {"orders.csv": (1, 1), "order_products__prior.csv": (2, 0)}

    drop(raw, "d3", range(16, 19), [(o, 3) for o in range(16, 19)])
    r = p.run()
    assert (r.status, r.hi) == (SUCCESS, 18)
    # d1 (no key above 12) and d2 (largest order 15) skipped; d2's lines still hold order 16
    assert r.raw_files == {"orders.csv": (1, 2), "order_products__prior.csv": (2, 1)}
    expect = sorted([(o, 1) for o in range(1, 13)] + [(o, 2) for o in range(13, 16)]
                    + [(16, 1)] + [(o, 3) for o in range(16, 19)])
    assert keys(p) == expect                                  # early line loaded exactly once

    r = p.run()
    assert r.status == NO_NEW_DATA and r.raw_files["orders.csv"] == (0, 3)

    time.sleep(1.1)                                           # a rewritten file is read again
    drop(raw, "d1", list(range(1, 13)) + [19], [(o, 1) for o in range(1, 13)] + [(19, 2)])
    r = p.run()
    assert (r.status, r.hi, r.raw_files["orders.csv"]) == (SUCCESS, 19, (1, 2))
    assert (19, 2) in keys(p)

    p.marks.reset(["orders.csv", "order_products__prior.csv"], 15)   # mark moved back
    r = p.incremental_load()
    # d1 (recorded at mark 18) and d3 (holds 16..18) are read; d2 (nothing above 15) is not
    assert r.raw_files["orders.csv"] == (2, 1)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(3, 8), st.integers(2, 6), st.sets(st.integers(0, 40), max_size=8))
def test_drops_with_early_lines_equal_one_full_load(spark, a, gap, early_picks):
    from tidemark.session import fresh_dir
    n, b = 18, min(a + gap, 16)
    work = fresh_dir(spark, "drops")
    raw = f"{work}/raw"
    root = _local(raw)
    write_text(f"{root}/products.csv", "product_id,product_name,aisle_id,department_id",
               ["1,Salt,1,1", "2,Bananas,2,1", "3,Milk,2,2"])
    write_text(f"{root}/aisles.csv", "aisle_id,aisle", ["1,spices", "2,fresh"])
    write_text(f"{root}/departments.csv", "department_id,department", ["1,pantry", "2,dairy"])
    lines = [(o, p) for o in range(1, n + 1) for p in (1, 2, 3) if (o + p) % 4]

    def drop_of(order_id):
        return 0 if order_id <= a else (1 if order_id <= b else 2)

    # some lines of later orders arrive with an earlier drop
    placed = {}
    for i, line in enumerate(lines):
        d = drop_of(line[0])
        placed[line] = (i % d) if (i in early_picks and d > 0) else d
    bounds = [(1, a), (a + 1, b), (b + 1, n)]
    p = Pipeline(spark, Lakehouse(spark, f"{work}/lake"), raw, skip_unchanged_raw=True)
    for d, (first, last) in enumerate(bounds):
        drop(raw, f"d{d}", range(first, last + 1), [ln for ln in lines if placed[ln] == d])
        if d == 0:
            p.reference_load()
        r = p.run()
        assert r.status == SUCCESS and r.hi == last
    assert keys(p) == sorted(lines)                       # every line, exactly once


def test_file_names_needing_escapes_are_matched(spark, workdir):
    raw = f"{workdir}/raw"
    root = _local(raw)
    write_text(f"{root}/products.csv", "product_id,product_name,aisle_id,department_id",
               ["1,Salt,1,1", "2,Bananas,2,1", "3,Milk,2,2"])
    write_text(f"{root}/aisles.csv", "aisle_id,aisle", ["1,spices", "2,fresh"])
    write_text(f"{root}/departments.csv", "department_id,department", ["1,pantry", "2,dairy"])
    drop(raw, "first drop", range(1, 6), [(o, 1) for o in range(1, 6)])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw, skip_unchanged_raw=True)
    p.reference_load()
    p.run()
    drop(raw, "second 100%", range(6, 9), [(o, 2) for o in range(6, 9)] + [(9, 1)])   # early line
    assert p.run().hi == 8
    drop(raw, "third", range(9, 11), [(o, 3) for o in range(9, 11)])
    r = p.run()
    assert r.raw_files == {"orders.csv": (1, 2), "order_products__prior.csv": (2, 1)}
    assert (9, 1) in keys(p) and len(keys(p)) == 5 + 3 + 1 + 2
    # a glob character in a file name: that source is read whole, nothing is lost
    drop(raw, "fourth[x]", range(11, 13), [(o, 1) for o in range(11, 13)])
    r = p.run()
    assert (r.status, r.hi) == (SUCCESS, 12) and r.raw_files["orders.csv"] == (0, 0)
    assert {(11, 1), (12, 1)} <= set(keys(p))
