"""A worker holds little beside the batch that it works on: it counts with the executor's memory."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontam as dc
from tidemark.llm import near_dedup as nd
from tidemark.llm import packing as pk
from tidemark.llm import suffix_dedup as sd
from tidemark.llm.text import Hasher

from rows import sentence

MB = 1 << 20


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return [sentence(rng, 500) for _ in range(1000)]


def peak(run, batches):
    """MB that ``run`` holds at most, of what numpy and Python allocate."""
    tracemalloc.start()
    try:
        for _ in run(batches):
            pass
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def batch(texts, **more):
    n = len(texts)
    ids = {c: pa.array(range(n), pa.int64()) for c in ("doc_id", "node", "crc", "h1", "h2")}
    return pa.RecordBatch.from_pydict({**ids, "text": pa.array(texts), **more})


def searcher(items):
    """The function that ``_searched`` gives to mapInArrow."""
    given = []
    sc = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    docs = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=sc), schema=SimpleNamespace(fields=[]),
                           mapInArrow=lambda run, schema: given.append(run))
    dc._searched(docs, dc.Index(items, {}, len(items), 30.0), dc.THRESHOLD)
    return given[0]


def test_decontamination(texts):
    rng = random.Random(6)
    n = len(texts)
    b = batch(texts, _d_items=pa.array([[]] * n, pa.list_(pa.int64())), _d_score=pa.array([0.0] * n),
              _d_overlap=pa.array([0.0] * n))
    assert sum(map(len, texts)) > 2 * MB
    assert peak(searcher([(i, sentence(rng, 30)) for i in range(50)]), [b]) < 40


def test_near_dedup(texts):
    assert peak(nd._signer(nd.BANDS, nd.ROWS), [batch(texts)]) < 30
    assert peak(nd._sets, [batch(texts)]) < 30


def test_suffix_dedup(texts):
    assert peak(sd._anchor_blobs(48), [batch(texts)]) < 40
    rows, hasher = [], Hasher()
    bodies = [x for b in sd._bodies([batch(texts)]) for x in b.to_pylist()]
    for r, text in zip(bodies, texts):
        at = sd.anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]), hasher)[0]
        rows += [(r["doc_id"], r["crc"], 0, at.astype(np.uint32).tobytes()), (r["doc_id"], r["crc"], 1, r["body"])]
    b = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["doc_id", "crc", "kind", "body"])
    assert peak(sd._context_blobs(48, SimpleNamespace(value=np.zeros(0, np.uint64))), [b]) < 100


def test_contexts_end_with_their_text():
    buf = np.frombuffer(bytes(range(1, 121)), np.uint8)
    start, ahead, after = np.array([0, 40, 100]), np.array([0, 30, 10]), np.array([50, 50, 20])
    want = np.zeros((3, 80), np.uint8)
    want[0, 30:], want[1], want[2, 20:50] = buf[:50], buf[10:90], buf[90:120]
    assert (sd.context_rows(buf, start, ahead, after) == want).all()


def test_packing_starts_no_other_kind_of_workers(spark):
    docs = spark.createDataFrame([(1, "one two three"), (2, None)], "doc_id long, text string")
    packed = pk.pack(docs)
    assert "ExistingRDD" not in packed._jdf.queryExecution().toString()
    assert packed.count() == 2
    assert pk.pack(docs.limit(0)).count() == 0
