import numpy as np
import pytest

from tidemark.llm import near_dedup as nd
from tidemark.llm.components import components
from tidemark.llm.frames import table

from rows import SMALL, awkward_docs, awkward_texts


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_classes(rows):
    """Smallest doc_id of each component of J >= 0.8, equal texts and equal ids linked."""
    ids = sorted({i for i, _ in rows})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = [(i, t or "", shingles(t)) for i, t in rows]
    for a, (i, t, s) in enumerate(sets):
        for j, u, r in sets[:a]:
            alike = t == u or (s and r and len(s & r) >= 0.8 * len(s | r))
            if alike and find(i) != find(j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def classes_of(df):
    return {r.doc_id: r.class_id for r in df.select("doc_id", "class_id").distinct().collect()}


def test_classes_equal_brute_force_on_the_small_table(spark):
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = nd.op1_near_dedup(spark, SMALL)
    assert got.count() == len(rows)
    assert classes_of(got) == brute_classes(rows)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(i, t) for i, t in awkward_texts() if i is not None]
    assert classes_of(nd.near_duplicates(docs)) == brute_classes(rows)
    kept = nd.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(brute_classes(rows).values()))
    assert ids.count(None) == 2
    assert nd.near_duplicates(docs.limit(0)).count() == 0


def test_the_query_has_every_row(spark, workdir):
    docs = awkward_docs(spark)
    docs.write.parquet(f"{workdir}/documents.parquet")
    rows = nd.op1_near_dedup(spark, workdir).collect()
    assert len(rows) == len(awkward_texts())
    assert [(r.class_id, r.copies) for r in rows if r.doc_id is None] == [(None, 1)] * 2


def test_a_family_whose_members_differ_from_the_centre(spark):
    """A chain: neighbours are alike, the ends are not; all is one class."""
    words = [f"w{k}" for k in range(400)]
    rows = [(d, " ".join(words[4 * d:4 * d + 200])) for d in range(30)]
    got = classes_of(nd.near_duplicates(awkward_docs(spark, rows)))
    assert got == brute_classes(rows) and set(got.values()) == {0}


def test_repeated_passages_do_not_hide_pairs(spark):
    """Pairs of 200 shared shingles, one text with 49 more, most of them seen 10 or 100 times."""
    rows = []
    for d in range(30):
        base = [f"b{d}w{k}" for k in range(204)]
        passage = [f"p{d}w{k}" for k in range(45)]
        rows += [(2 * d, " ".join(base)), (2 * d + 1, " ".join(base + passage * (10 if d % 2 else 100)))]
    got = classes_of(nd.near_duplicates(awkward_docs(spark, rows)))
    assert got == brute_classes(rows) == {i: i - i % 2 for i, _ in rows}


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 300, dtype=np.uint64)
    weight = rng.integers(1, 5, 300).astype(float)
    x, y = slice(0, 250), slice(50, 300)
    m = 4096
    wx, wy = np.zeros(300), np.zeros(300)
    wx[x], wy[y] = weight[x], 2 * weight[y]               # a common factor does not matter
    both = [d for d in range(300) if wx[d] and wy[d]]
    exact = sum(1 / np.maximum(wx / wx[d], wy / wy[d]).sum() for d in both)
    sig = [nd.prob_minhash(h[s], np.zeros(250, np.int64), w[s], 1, m)[0] for s, w in ((x, wx), (y, wy))]
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (4, 5), (9, 1)], [(k, k + 1) for k in range(1, 40)]])
def test_components(spark, edges):
    nodes = list(range(1, 42))
    labels = spark.createDataFrame([(n, n) for n in nodes], "node long, comp long")
    got = {r.node: r.comp for r in components(labels, spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for n in nodes}
    for _ in nodes:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want
