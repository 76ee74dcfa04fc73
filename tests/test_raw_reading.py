"""Raw drops that must not be lost or misread: malformed cells, column order,
unfinished writers, rewritten files, a second initial load."""

import os

import pytest

from tidemark.operators.quality import QualityGateError
from tidemark.plans.pipeline import NO_NEW_DATA, SUCCESS, Pipeline
from tidemark.sinks import Lakehouse

from conftest import LINES_HEADER, ORDERS_HEADER, line_row, order_row, write_raw, write_text


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


@pytest.fixture()
def lake(spark, workdir):
    """A loaded lake (ids 1..5), its raw folder and its pipeline."""
    raw = write_raw(f"{workdir}/raw", [order_row(i) for i in range(1, 6)], [line_row(i, 1) for i in range(1, 6)])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    p.reference_load()
    assert p.run().hi == 5
    return p, raw


def ids(p):
    return sorted(r.order_id for r in p.fact().collect())


def mark(p):
    return p.marks.get("orders.csv")


def drop(raw, orders, lines, orders_header=ORDERS_HEADER, lines_header=LINES_HEADER):
    write_text(f"{_local(raw)}/orders.csv", orders_header, orders)
    write_text(f"{_local(raw)}/order_products__prior.csv", lines_header, lines)


GOOD = [order_row(i) for i in range(1, 9)]
GOOD_LINES = [line_row(i, 1) for i in range(1, 9)]


@pytest.mark.parametrize("infer", [False, True])
def test_malformed_cells_fail_the_gate(spark, lake, infer):
    p, raw = lake
    drop(raw, GOOD + ["abc,1,prior,1,1,8,1.0", "3000000000,1,prior,1,1,8,1.0", "9,1,prior,1,1,8,x"],
         GOOD_LINES + ["bad,1,1,0", "8x,1,1,0"])
    q = Pipeline(spark, p.store, raw, infer_schema=infer)
    with pytest.raises(QualityGateError) as e:
        q.run()
    assert "Wrong data type for order_id: expected int, found string" in str(e.value)
    assert "Wrong data type for days_since_prior_order: expected double, found string" in str(e.value)
    assert mark(p) == 5 and ids(p) == [1, 2, 3, 4, 5]
    drop(raw, GOOD, GOOD_LINES)
    assert p.run().hi == 8 and ids(p) == list(range(1, 9))


def test_malformed_lines_fail_the_gate(lake):
    p, raw = lake
    drop(raw, GOOD, GOOD_LINES + ["bad,1,1,0"])
    with pytest.raises(QualityGateError, match="Wrong data type for order_id: expected int, found string"):
        p.run()
    assert mark(p) == 5 and ids(p) == [1, 2, 3, 4, 5]
    drop(raw, GOOD, GOOD_LINES)
    assert p.run().hi == 8 and ids(p) == list(range(1, 9))


def test_a_wide_id_is_named_as_its_type(lake):
    p, raw = lake
    drop(raw, GOOD + ["3000000000,1,prior,1,1,8,1.0"], GOOD_LINES)
    with pytest.raises(QualityGateError, match="Wrong data type for order_id: expected int, found bigint"):
        p.run()
    assert mark(p) == 5


def test_only_malformed_new_rows_are_no_empty_batch(lake):
    p, raw = lake
    drop(raw, GOOD[:5] + ["6z,1,prior,1,1,8,1.0"], GOOD_LINES[:5])
    with pytest.raises(QualityGateError):
        p.run()


def test_columns_are_bound_by_name(lake):
    p, raw = lake
    drop(raw, [f"7.0,3,6,1,prior,1,{i}" for i in range(1, 9)],
         [f"1,{i},0,1" for i in range(1, 9)],
         "days_since_prior_order,order_hour_of_day,order_dow,order_number,eval_set,user_id,order_id",
         "product_id,order_id,reordered,add_to_cart_order")
    assert p.run().hi == 8
    new = [r for r in p.fact().collect() if r.order_id > 5]
    assert sorted((r.order_id, r.product_id, r.order_dow, r.order_hour_of_day) for r in new) == [
        (i, 1, 6, 3) for i in (6, 7, 8)]


@pytest.mark.parametrize("infer", [False, True])
def test_a_missing_column_is_reported(spark, lake, infer):
    p, raw = lake
    drop(raw, ["6,1,1,1,8,1.0"], GOOD_LINES,
         "order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order")
    with pytest.raises(QualityGateError, match="Wrong data type for eval_set: expected string, found None"):
        Pipeline(spark, p.store, raw, infer_schema=infer).run()
    drop(raw, GOOD, ["1,1,0"], lines_header="product_id,add_to_cart_order,reordered")
    with pytest.raises(QualityGateError, match="Wrong data type for order_id: expected int, found None"):
        Pipeline(spark, p.store, raw, infer_schema=infer).run()
    assert mark(p) == 5


def test_files_of_one_source_with_different_headers_are_refused(spark, workdir):
    raw = write_raw(f"{workdir}/raw", [], [])
    for name in ("orders.csv", "order_products__prior.csv"):
        os.remove(f"{_local(raw)}/{name}")
    write_text(f"{_local(raw)}/orders.csv/a.csv", ORDERS_HEADER, GOOD[:2])
    write_text(f"{_local(raw)}/order_products__prior.csv/a.csv", LINES_HEADER, GOOD_LINES[:2])
    write_text(f"{_local(raw)}/order_products__prior.csv/b.csv", "product_id,order_id,add_to_cart_order,reordered",
               ["1,2,1,0"])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    p.reference_load()
    with pytest.raises(Exception, match="header"):
        p.run()
    assert mark(p) == 0


@pytest.mark.parametrize("skip", [False, True])
def test_files_of_unfinished_writers_are_ignored(spark, workdir, skip):
    raw = f"{workdir}/raw"
    write_raw(raw, [], [])
    for name in ("orders.csv", "order_products__prior.csv"):
        os.remove(f"{_local(raw)}/{name}")

    def part(folder, i):
        write_text(f"{_local(raw)}/orders.csv/{folder}p{i}.csv", ORDERS_HEADER, [order_row(i)])
        write_text(f"{_local(raw)}/order_products__prior.csv/{folder}p{i}.csv", LINES_HEADER, [line_row(i, 1)])
    part("", 1)
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw, skip_unchanged_raw=skip)
    p.reference_load()
    assert p.run().hi == 1
    part("", 2)
    part("_temporary/0/", 7)
    assert p.run().hi == 2 and ids(p) == [1, 2]


def test_a_rewrite_with_equal_size_and_time_is_read(lake):
    p, raw = lake
    drop(raw, [order_row(i) for i in range(1, 7)], [line_row(i, 1) for i in range(1, 7)])
    assert p.run().hi == 6
    files = [f"{_local(raw)}/{n}" for n in ("orders.csv", "order_products__prior.csv")]
    times = [os.stat(f) for f in files]
    drop(raw, [order_row(i) for i in (1, 2, 3, 4, 5, 7)], [line_row(i, 1) for i in (1, 2, 3, 4, 5, 7)])
    for f, t in zip(files, times):
        os.utime(f, ns=(t.st_atime_ns, t.st_mtime_ns))
        assert os.stat(f).st_size == t.st_size
    assert p.run().status == SUCCESS and mark(p) == 7 and ids(p) == [1, 2, 3, 4, 5, 6, 7]
    assert p.run().status == NO_NEW_DATA


@pytest.mark.parametrize("copy", [True, False])
def test_a_second_initial_load_keeps_history(spark, workdir, copy):
    raw = write_raw(f"{workdir}/raw", GOOD[:5], GOOD_LINES[:5])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw, silver_copy=copy)
    p.reference_load()
    p.run()
    drop(raw, GOOD[:7], GOOD_LINES[:7] + [line_row(7, 1, reordered=5)])
    with pytest.raises(RuntimeError, match="are loaded"):
        p.initial_load()
    assert ids(p) == [1, 2, 3, 4, 5]
    with pytest.raises(QualityGateError):
        p.run()
    assert ids(p) == [1, 2, 3, 4, 5]
    drop(raw, GOOD[:7], GOOD_LINES[:7])
    assert p.run().status == SUCCESS
    for layer in ("bronze", "silver"):
        from tidemark.sources import schemas
        assert sorted(r.order_id for r in p.committed(layer, "orders", schemas.ORDERS).collect()) == list(range(1, 8))
    assert ids(p) == list(range(1, 8))
    r = p.initial_load(force=True)
    assert (r.status, r.lo, r.hi) == (SUCCESS, 0, 7) and ids(p) == list(range(1, 8))


def test_malformed_reference_cells_fail_the_gate(spark, workdir):
    raw = write_raw(f"{workdir}/raw", GOOD, GOOD_LINES, aisles=["1,spices", "two,fresh"])
    p = Pipeline(spark, Lakehouse(spark, f"{workdir}/lake"), raw)
    with pytest.raises(QualityGateError, match="Wrong data type for aisle_id: expected int, found string"):
        p.reference_load()


def test_other_analysis_errors_are_not_read_as_empty(spark, workdir):
    from pyspark.sql import types as T
    from pyspark.sql.utils import AnalysisException
    store = Lakehouse(spark, f"{workdir}/lake", fmt="no_such_format")
    with pytest.raises((AnalysisException, Exception), match="(?i)no_such_format|DATA_SOURCE"):
        store.read("control", "watermark", schema=T.StructType([T.StructField("x", T.LongType())]))


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    from tidemark import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
