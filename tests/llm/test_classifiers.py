import zlib

import pytest

from tidemark.llm import quality_model, toxicity
from tidemark.llm.frames import in_held_out

from rows import awkward_docs, awkward_texts

DATA = "/root/testdata/sf0.1"


@pytest.mark.parametrize("query,target,low", [
    (quality_model.op4_quality_classifier, "quality", 0.95), (toxicity.op7_toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, query, target, low):
    out = query(spark, DATA)
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = out.collect()
    assert len(rows) == 10000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    for value in (0, 1):                                   # either class by itself
        mine = [p == t for p, t in held if t == value]
        assert sum(mine) >= (low - 0.1) * len(mine), (target, value, sum(mine), len(mine))
    assert sum(p == t for p, t in held) >= low * len(held)


def _train(spark, target):
    rows = [(100 + k, ("awful " if k % 2 else "fine ") + "word here " * 10) for k in range(60)]
    docs = awkward_docs(spark, awkward_texts() + rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(6, None), (None, 1), (999, 0)],
                                   f"doc_id long, {target} int")
    return docs, labels


def test_awkward_rows_quality(spark):
    docs, labels = _train(spark, "quality")
    weights = quality_model.fit(docs, labels)
    out = quality_model.score_documents(docs, weights, "q").collect()
    assert len(out) == docs.count() and all(0 <= r.q <= 1 for r in out)
    assert {r.q for r in out if r.text in (None, "")} == {1 / (1 + 2.718281828459045 ** -weights[0].astype("float32"))} \
        or len({r.q for r in out if r.text in (None, "")}) == 1
    by_id = {r.doc_id: r.q for r in out if r.doc_id is not None and r.doc_id >= 100}
    assert all((q > 0.5) == (i % 2 == 1) for i, q in by_id.items())
    assert quality_model.score_documents(docs.limit(0), weights, "q").count() == 0
    assert not quality_model.fit(docs, labels.limit(0)).any()


def test_awkward_rows_toxicity(spark):
    docs, labels = _train(spark, "toxic")
    net, _ = toxicity.fit(docs, labels)
    out = toxicity.score_documents(docs, net, "t").collect()
    assert len(out) == docs.count() and len({r.t for r in out if r.text in (None, "")}) == 1
    by_id = {r.doc_id: r.t for r in out if r.doc_id is not None and r.doc_id >= 100}
    assert all((t > 0.5) == (i % 2 == 1) for i, t in by_id.items())
    assert toxicity.score_documents(docs.limit(0), net, "t").count() == 0
    none, _ = toxicity.fit(docs, labels.limit(0))
    assert none is None and toxicity.score_documents(docs, none, "t").filter("t <> 0").isEmpty()


def test_held_out_is_the_remainder_of_the_checksum(spark):
    from pyspark.sql import functions as F
    got = spark.range(50).select("id", in_held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_toxicity_learns_from_every_row_not_a_sample(spark):
    n = 5400                       # more than the 2500 a class that were once the most
    rows = [(k, ("vile" if k % 2 else "kind") + f"{k // 2} " * 3) for k in range(n)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    free = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5}
    found = toxicity.dealt(toxicity.training_rows(docs, labels, "toxic"))
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(free)
    words = {i: t.split()[0] for i, t in rows}
    pos, neg = toxicity.row_counts(found)
    assert pos[2 * len(pos) // 3:].sum() == 2 * sum(words[i].startswith("vile") for i in free)   # stems: word, number
    assert neg[2 * len(neg) // 3:].sum() == 2 * sum(words[i].startswith("kind") for i in free)


def test_toxicity_mean_over_tasks_is_the_net_of_one(spark):
    def dealt(tasks):              # equal rows, so that their order is no matter
        rows = spark.sparkContext.parallelize([("awful words here", 1)] * 80 * tasks, tasks)
        return spark.createDataFrame(rows, "text string, label int")
    net = toxicity.Net()
    (one, _), (two, _) = (toxicity.learn(dealt(tasks), net, {}, 3) for tasks in (1, 2))
    assert abs(one.e - two.e).max() < 1e-6 and abs(one.e - net.e).max() > 1e-3 and abs(one.c - two.c) < 1e-6


def test_thresholds_of_counted_outputs():
    import numpy as np
    assert toxicity.best_threshold(np.array([3., 1., 2.]), np.array([5., 0., 0.]), np.array([0., 2., 9.])) == 2.5
