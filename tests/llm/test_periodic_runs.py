"""Runs of words against plain loops over every lag and place."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import SMALL, awkward_docs

from tidemark.llm import periodic_runs as pr


def brute_runs(w):
    """Every maximal stretch of every lag whose smallest period is that lag."""
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(w[k] == w[k + d] for k in range(i, i + length - d)) for d in range(1, q))
            if length >= max(24, 3 * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(w):
    return pr.runs(np.array(w, np.int32))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 60)), max_size=6))
def test_runs_equal_brute_force(parts):
    w = [base[i % len(base)] for base, length in parts for i in range(length)]
    assert found(w) == brute_runs(w)


@pytest.mark.parametrize("alphabet", [1, 2, 3, 8])
def test_random_words_equal_brute_force(alphabet):
    rng = random.Random(alphabet)
    for _ in range(60):
        w = [rng.randrange(alphabet) for _ in range(rng.randint(0, 150))]
        assert found(w) == brute_runs(w)


def test_overlapping_runs_and_thresholds():
    w = [0, 1] * 12 + [0, 2, 2] * 9
    assert found(w) == brute_runs(w)
    assert found([5] * 23) == [] and found([5] * 24) == [(0, 24, 1)]
    nine = list(range(9))
    assert found(nine * 3) == [(0, 27, 9)] and found((nine * 3)[:-1]) == []
    # the same stretch of words, again and again but never adjacent
    rng = random.Random(2)
    w = [x for _ in range(40) for x in [*range(10), rng.randrange(11, 400)]]
    assert found(w) == brute_runs(w)


def test_long_texts_finish():
    assert found([1] * 300_000) == [(0, 300_000, 1)]
    assert found(list(range(1000)) * 100) == [(0, 100_000, 1000)]
    assert found(np.random.default_rng(0).integers(0, 50, 100_000)) == []


def test_probes_in_small_blocks(monkeypatch):
    rng = random.Random(7)
    w = [rng.randrange(2) for _ in range(40)] + [0, 1, 1] * 20 + [rng.randrange(2) for _ in range(40)]
    monkeypatch.setattr(pr, "PROBES", 1)
    assert found(w) == brute_runs(w)


def test_splitting_drops_rare_words():
    w = list(range(50)) + [1, 2] * 30 + list(range(100, 150))
    assert list(pr.segments(np.array(w, np.int32))) == [(50, 110)]


def test_words_in_pieces(monkeypatch):
    text = "  añb \t c d\n\r\x0b\x0c e añb".encode() * 50
    whole, names = pr.numbered_words(text)
    monkeypatch.setattr(pr, "PIECE", 7)
    again, names_again = pr.numbered_words(text)
    assert names == names_again and (whole == again).all()
    assert [names[i] for i in whole] == text.split()


def brute_row(doc_id, text, rewrite):
    """The contract's columns by plain loops."""
    w = (text or "").encode().split()
    n = len(w)
    if rewrite and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    all_runs = brute_runs(w)
    drop = {i for s, length, p in all_runs for i in range(s + p, s + length)}
    best = min(all_runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if all_runs else (None,) * 3
    return (doc_id, len(all_runs), *best, 1000 * best[1] // best[2] if all_runs else None,
            hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in all_runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest())


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in pr.op11_periodic_runs(spark, SMALL).collect())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    # brute force is quadratic: the longest texts are left to the tests above
    short = [d for d in docs if len((d.text or "").split()) < 260]
    assert len(got) == len(docs) and len(short) > 90
    want = {d.doc_id: brute_row(d.doc_id, d.text, True) for d in short}
    assert sum(w[1] > 0 for w in want.values()) > 5
    for row in got:
        assert want.get(row[0], row) == row


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = docs.collect()
    got = pr.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    by_key = sorted((r.doc_id is None, r.doc_id or 0, r.collapsed, [tuple(x) for x in r.runs]) for r in got)
    want = []
    for r in rows:
        w = (r.text or "").split()
        if len(w) > 1000:
            number = {x: i for i, x in enumerate(set(w))}
            w_runs = found([number[x] for x in w])
        else:
            w_runs = brute_runs(w)
        drop = {i for s, length, p in w_runs for i in range(s + p, s + length)}
        want.append((r.doc_id is None, r.doc_id or 0, " ".join(x for i, x in enumerate(w) if i not in drop), w_runs))
    assert by_key == sorted(want)
    assert any(r.runs for r in got)                  # the repeated line
    empty = pr.periodic_runs(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "runs", "collapsed"]


def test_best_run_ties():
    assert pr.best_run([(0, 24, 2), (5, 36, 3), (7, 48, 4)]) == (0, 24, 2)
    assert pr.best_run([(0, 24, 2), (5, 37, 3)]) == (5, 37, 3)
    assert pr.best_run([]) is None
