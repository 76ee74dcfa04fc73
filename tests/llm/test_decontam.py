import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam as dc
from tidemark.llm.frames import table
from tidemark.llm.text import lowered

from rows import SMALL, awkward_docs, awkward_texts, sentence


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def brute_scores(items, passage):
    """BM25 of every item as a share of its own score, by the formula."""
    bodies = {i: words(t) for i, t in items}
    n, mean = len(items), sum(map(len, bodies.values())) / len(items)
    df = {}
    for b in bodies.values():
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    out = {}
    for i, b in bodies.items():
        gain = {w: math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b.count(w) * 2.2
                / (b.count(w) + 1.2 * (0.25 + 0.75 * len(b) / mean)) for w in set(b)}
        out[i] = sum(g for w, g in gain.items() if w in passage) / sum(gain.values())
    return out


def test_search_retrieves_all_above_the_threshold(spark):
    benchmark = table(spark, SMALL, "benchmark")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    [index] = dc.build_indexes(benchmark)
    w = dc.Words()
    rng = random.Random(3)
    texts = [r.text for r in table(spark, SMALL, "documents").limit(40).collect()]
    texts += [" ".join(rng.sample(words(t), len(words(t)) // 2)) + " " + sentence(rng, 90) for _, t in items[:20]]
    for text in texts:
        buf = np.frombuffer(lowered([text])[0], np.uint8)
        h, first = w(buf, np.array([0, len(buf)]))
        got, own = {}, words(text)
        assert len(own) == len(h)
        for _, item, score, a, b in index.search(h, first, 0.2):
            got[(a, int(index.ids[item]))] = score
        want = {}
        for a in index.passages(first)[0]:
            scores = brute_scores(items, set(own[a:a + 2 * index.stride]))
            want |= {(int(a), i): s for i, s in scores.items() if s >= 0.2}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_planted_items_are_found_and_others_left(spark):
    benchmark = table(spark, SMALL, "benchmark")
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = [(i, sentence(rng, rng.randint(0, 200)) + " " + t + " " + sentence(rng, 100)) for i, t in items]
    rows += [(1000 + k, sentence(rng, 300)) for k in range(20)]
    accents = next(t for _, t in items if not t.isascii())
    rows += [(2001, "X!! " + accents.upper() + "!! Y")]
    rows += [(2000, items[0][1].upper() + "\n" + sentence(rng, 70) + items[1][1])]
    got = {r.doc_id: r._d_items for r in dc.with_leaks(awkward_docs(spark, rows), benchmark).collect()}
    assert all(i in got[i] for i, _ in items)
    assert not any(got[1000 + k] for k in range(20))
    assert dict(items)[got[2001][0]] == accents
    assert {items[0][0], items[1][0]} <= set(got[2000])


def test_awkward_rows_and_empty_tables(spark):
    benchmark = spark.createDataFrame([(1, "What is it? It is so."), (2, None), (None, "x y"), (3, ""), (1, "again")],
                                      "item_id long, text string")
    docs = awkward_docs(spark)
    kept = dc.clean(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(awkward_texts())
    assert dc.clean(docs, benchmark.limit(0)).count() == len(awkward_texts())
    assert dc.clean(docs.limit(0), benchmark).count() == 0


def test_several_passes_find_the_same(spark):
    benchmark = table(spark, SMALL, "benchmark")
    one, many = dc.build_indexes(benchmark), dc.build_indexes(benchmark, 7)
    assert len(many) > 1 and sum(len(x.ids) for x in many) == len(one[0].ids)
    where = {i: s for x in many for i, s in zip(x.ids, [x.impact[x.item == k].sum() for k in range(len(x.ids))])}
    assert all(abs(v - 1) < 1e-9 for v in where.values())


def leaks(docs, benchmark, **kw):
    return {r.doc_id: (r._d_items, round(r._d_score, 9), r._d_overlap)
            for r in dc.with_leaks(docs, benchmark, **kw).collect()}


def test_searching_in_passes_equals_one_pass(spark):
    benchmark, docs = table(spark, SMALL, "benchmark"), table(spark, SMALL, "documents")
    whole = leaks(docs, benchmark)
    assert any(items for items, _, _ in whole.values())
    # blocks and the stride, so passages and scores, depend on a pass' items: the items found must not
    for kw in ({"per_pass": 9}, {"pass_bytes": 2000}):
        assert {d: i for d, (i, _, _) in leaks(docs, benchmark, **kw).items()} == {
            d: i for d, (i, _, _) in whole.items()}


def test_items_that_share_an_id_are_all_found(spark):
    rng = random.Random(4)
    a, b = (f"{sentence(rng, 20)}? {sentence(rng, 12)}." for _ in range(2))
    benchmark = spark.createDataFrame([(1, a), (1, b), (1, b), (2, sentence(rng, 30))], "item_id long, text string")
    rows = [(1, a), (2, sentence(rng, 40) + " " + b + " " + sentence(rng, 40)), (3, sentence(rng, 90))]
    got = {d: items for d, (items, _, _) in leaks(awkward_docs(spark, rows), benchmark).items()}
    assert got == {1: [1], 2: [1], 3: []}


def test_columns_named_like_the_results(spark):
    benchmark = table(spark, SMALL, "benchmark")
    docs = table(spark, SMALL, "documents").select("doc_id", "text", F.lit("own").alias("_d_items"),
                                                   F.lit(1).alias("_d_score"))
    kept = dc.clean(docs, benchmark)
    assert kept.columns == docs.columns and {r._d_items for r in kept.collect()} == {"own"}
    clean = dc.clean(docs.select("doc_id", "text"), benchmark)
    assert kept.count() == clean.count() < docs.count()


def test_the_index_travels_as_plain_arrays(spark):
    """Executors need no copy of the package: what is broadcast names no class of it."""
    import pickle
    import pickletools
    [index] = dc.build_indexes(table(spark, SMALL, "benchmark"))
    named = {op[1] for op in pickletools.genops(pickle.dumps(vars(index))) if isinstance(op[1], str)}
    assert not any("tidemark" in n for n in named)
    again = dc.Index.from_parts(vars(index))
    assert again.stride == index.stride and (again.cells == index.cells).all()


def test_query_equals_brute_force(spark):
    """Every item and every passage by plain loops, over the whole small table."""
    benchmark = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    bodies = {i: words(t) for i, t in benchmark}
    stride = max(32, *(len(b) for b in bodies.values()))
    n, mean = len(bodies), sum(map(len, bodies.values())) / len(bodies)
    df = {}
    for b in bodies.values():
        for w in set(b):
            df[w] = df.get(w, 0) + 1
    gain = {i: {w: math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * b.count(w) * 2.2
                / (b.count(w) + 1.2 * (0.25 + 0.75 * len(b) / mean)) for w in set(b)} for i, b in bodies.items()}
    own = {i: sum(g.values()) for i, g in gain.items()}

    def parts(text):
        sentences = re.split(r"(?<=[.!?])\s+", text.strip())
        return [words(" ".join(sentences[:-1])), words(sentences[-1])] if len(sentences) > 1 else [words(text), []]

    def grams(w, size):
        return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if size else set()
    halves = {i: [(min(3, len(h)), grams(h, min(3, len(h)))) for h in parts(t)] for i, t in benchmark}
    got = {r.doc_id: r.items for r in dc.op8_decontamination(spark, SMALL).collect()}
    docs = table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        w, want = words(d.text), set()
        for a in range(0, max(1, -(-len(w) // stride) - 1) * stride if w else 0, stride):
            passage = w[a:a + 2 * stride]
            held = set(passage)
            for i, g in gain.items():
                if sum(v for k, v in g.items() if k in held) / own[i] < dc.THRESHOLD:
                    continue
                hits = [len(own_grams & grams(passage, size)) for size, own_grams in halves[i]]
                share = [h / len(o) if o else 1.0 for h, (_, o) in zip(hits, halves[i])]
                if share[0] >= 0.5 and (share[1] >= 0.5 or sum(hits) / sum(len(o) for _, o in halves[i]) >= 0.7):
                    want.add(i)
        assert got[d.doc_id] == sorted(want), d.doc_id


def test_a_pass_too_large_is_refused(spark, monkeypatch):
    rng = random.Random(6)
    benchmark = spark.createDataFrame([(i, sentence(rng, 5)) for i in range(50)], "item_id long, text string")
    monkeypatch.setattr(dc.F, "pmod", lambda a, b: F.lit(0).cast("long"))     # all items dealt to one pass
    with pytest.raises(ValueError, match="benchmark items"):
        list(dc.index_passes(benchmark, pass_bytes=100))
