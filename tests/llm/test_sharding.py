import zlib

from tidemark.llm import sharding

from rows import SMALL, awkward_docs, awkward_texts


def check(rows, texts, n_shards=40):
    assert len(rows) == len(texts)
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < n_shards
    for slots in shards.values():
        assert sorted(slots) == list(range(len(slots)))
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want


def test_small_table(spark):
    rows = sharding.op2_sharding(spark, SMALL).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(rows, texts)
    where = {}
    text_of = dict(texts)
    for r in rows:                                         # equal texts stay together
        assert where.setdefault(text_of[r.doc_id], r.shard) == r.shard
    sizes = {}
    for i, t in texts:
        sizes[t] = sizes.get(t, 0) + len(t.encode()) + 16
    loads = [0] * 40                                       # brute force: the loads of exact scheduling
    for s in sorted(sizes.values(), reverse=True):
        loads[loads.index(min(loads))] += s
    got = [0] * 40
    for r in rows:
        got[r.shard] += r.size
    assert max(got) <= 1.02 * max(loads)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = sharding.shard_documents(docs, 3).collect()
    check(rows, awkward_texts(), 3)
    assert sharding.shard_documents(docs.limit(0), 3).count() == 0


def test_bundles_balance_many_small_groups(spark):
    docs = spark.range(30000).selectExpr("id as doc_id", "repeat(cast(id as string), cast(id % 50 as int)) as text")
    loads = [r.b for r in sharding.shard_documents(docs, 40, exact=64).groupBy("shard").agg({"size": "sum"})
             .withColumnRenamed("sum(size)", "b").collect()]
    assert len(loads) == 40 and max(loads) <= 1.02 * min(loads)


def test_lpt():
    assert sorted(sharding.lpt([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2).items()) == [
        ("a", 0), ("b", 1), ("c", 1), ("d", 0), ("e", 1)]
