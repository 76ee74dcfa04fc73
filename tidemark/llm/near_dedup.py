"""Near-duplicate classes by ProbMinHash, banding and verification.

The shingles of a text are its runs of five words (lower-cased, split at white
space; shorter texts are one shingle). A shingle seen c times weighs
1 + ln(c). ProbMinHash: every shingle is a Poisson process whose rate is its
weight; its arrivals, drawn from the shingle's hash, fall into random
registers, and each register keeps the shingle that arrives first. Two texts
agree in a register with the probability Jaccard similarity of their weighted
shingles. With every shingle weighing 1 that is the Jaccard similarity of their
sets; texts that repeat shingles get registers of both kinds, in texts that
don't they are the same. A shingle's arrivals end as soon as the next one is later than all
registers' minima, so a text takes about m ln m arrivals however long it is.

Banding: 24 bands of 4 registers of unit weights, and 24 of the weighted ones
where they differ. Verification: pairs are linked if the Jaccard similarity of
their shingle sets is 0.8 or more. The unit bands measure the same similarity:
at 0.8 a pair shares none of them with a probability of 3e-6, however often its
shingles repeat. Pairs within a band are not expanded:
every member is first compared with one centre of the band, members that are
then in the same component need no comparison, and later rounds use other
centres. What is still apart after the rounds is compared pair by pair, so no
link between components is lost. Pairs that cannot reach the similarity are never
formed, by two bounds that hold for certain: a shingle that no other text holds is
in no intersection, and each bit that one text's bitmap of shingle hashes has and
the other's lacks is a shingle outside it. That rules out copies edited or cut too
much before they meet. Exact copies are one node throughout.

Null texts count as empty. Empty texts are copies of each other. Rows that
share a doc_id are one document; rows without doc_id are not linked: the query
gives each as its own row, with a null class_id and copies 1. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import dropped, table, written
from .text import Hasher, byte_classes, mix, owners, slices, small_batches, text_buffers, tidy, tokens

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
ROUNDS = 2
BITMAP = 2048                  # bits
STEP = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 18                # bytes of text worked on at once


def shingle_hashes(buf, off, hasher, classes, size: int = WORDS):
    """(hash, document) of every run of ``size`` words; short texts give one run."""
    start, end, _, first = tokens(buf, off, classes)
    h = hasher.spans(hasher.prefix(buf), start, end)
    count = np.diff(first)
    doc = owners(first)
    within = np.arange(len(h)) - first[doc]                # place of the word in its text
    total = np.zeros(len(h), np.uint64)
    for k in range(size):
        at = np.arange(len(h)) + k
        inside = within + k < count[doc]
        at[~inside] = 0
        total = total * np.uint64(0x100000001B3) + np.where(inside, h[at] if len(h) else h, np.uint64(k + 1))
    full = (within == 0) | (within + size <= count[doc])
    return mix(total[full]), doc[full]


def weighted_shingles(h, doc):
    """Distinct shingles of each document and how often they occur."""
    _, at, times = np.unique(mix(h ^ mix(doc.astype(np.uint64) + STEP)), return_index=True, return_counts=True)
    return h[at], doc[at], times


def prob_minhash(h, doc, weight, n_docs: int, m: int):
    """The register values (n_docs, m): the shingle that arrives first in each."""
    best = np.full(n_docs * m, np.inf)
    value = np.zeros(n_docs * m, np.uint64)
    time, step = np.zeros(len(h)), 0
    scale = 2.0**-53
    while len(h):
        step = (step + int(STEP)) % 2**64
        draw = mix(h + np.uint64(step))
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * scale) / weight
        slot = doc * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, slot, time)
        first = best[slot] == time
        value[slot[first]] = h[first]
        on = time < best.reshape(n_docs, m).max(axis=1)[doc]
        h, doc, weight, time = h[on], doc[on], weight[on], time[on]
    return value.reshape(n_docs, m)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band of the registers (n_docs, bands * rows)."""
    total = np.zeros((len(sig), bands), np.uint64)
    for r in range(rows):
        total = mix(total + sig[:, r * bands:(r + 1) * bands] + STEP)
    return total + np.arange(bands, dtype=np.uint64)


def document_bands(h, doc, times, n_docs: int, bands: int, rows: int):
    """(key, document), by document: the bands of unit weights and, in texts that repeat
    shingles, also the bands of weighted ones."""
    held = np.flatnonzero(np.bincount(doc, minlength=n_docs))
    unit = band_keys(prob_minhash(h, doc, np.ones(len(h)), n_docs, bands * rows), bands, rows)[held]
    again = np.flatnonzero(np.bincount(doc[times > 1], minlength=n_docs))
    place = np.full(n_docs, -1)
    place[again] = np.arange(len(again))
    some = place[doc] >= 0
    weighted = band_keys(prob_minhash(h[some], place[doc[some]], 1 + np.log(times[some]), len(again),
                                      bands * rows), bands, rows)
    # a band in which both kinds agree is one band
    new = weighted != unit[np.searchsorted(held, again)]
    keys = np.concatenate([unit.ravel(), weighted[new]])
    of = np.concatenate([np.repeat(held, bands), np.repeat(again, new.sum(axis=1))])
    order = np.argsort(of, kind="stable")
    return keys[order], of[order]


def _signer(bands: int, rows: int):
    def run(batches):
        hasher, classes = Hasher(), byte_classes(symbols=False)
        for batch in small_batches(batches, limit=SLICE):
            buf, off = text_buffers(batch.column("text"), lower=True)
            out, count = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, j in slices(off):
                o = off[i:j + 1] - off[i]
                h, doc = shingle_hashes(buf[off[i]:off[j]], o, hasher, classes)
                h, doc, times = weighted_shingles(h, doc)
                keys, of = document_bands(h, doc, times, j - i, bands, rows)
                out.append(keys)
                count.append(np.bincount(of, minlength=j - i))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(count))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h1"), batch.column("h2"),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out).view(np.int64)))],
                names=["doc_id", "h1", "h2", "bands"])
    return run


def _sets(batches):
    hasher, classes = Hasher(), byte_classes(symbols=False)
    for batch in small_batches(batches, limit=SLICE):
        buf, off = text_buffers(batch.column("text"), lower=True)
        n, all_h, maps = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros((0, BITMAP // 64), np.int64)]
        for i, j in slices(off):
            h, doc = shingle_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i], hasher, classes)
            h, doc, _ = weighted_shingles(h, doc)
            all_h.append(h[np.argsort(doc, kind="stable")])
            n.append(np.bincount(doc, minlength=j - i))
            bit = (h % np.uint64(BITMAP)).astype(np.int64)
            own = np.zeros((j - i, BITMAP // 8), np.uint8)
            np.bitwise_or.at(own.reshape(-1), doc * (BITMAP // 8) + (bit >> 3), np.uint8(128) >> (bit & 7).astype(np.uint8))
            maps.append(own.view(np.int64))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(n))]).astype(np.int32)
        maps = np.concatenate(maps)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(all_h).view(np.int64))),
             pa.ListArray.from_arrays(pa.array(np.arange(len(maps) + 1, dtype=np.int32) * maps.shape[1]),
                                      pa.array(maps.ravel()))], names=["node", "shingles", "bitmap"])


def text_key(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and h1, h2: equal for equal texts."""
    t = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", t.alias("text"), F.xxhash64(t).alias("h1"),
                       (F.shiftleft(F.crc32(t.cast("binary")), 31) + F.octet_length(t)).alias("h2"))


def verified(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The edges (a, b) whose shingle sets have the Jaccard similarity or more."""
    sa = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    na, nb = F.size("sa"), F.size("sb")
    both = F.size(F.array_intersect("sa", "sb"))
    return (edges.join(sa, "a").join(sb, "b")
            .filter(F.least(na, nb) >= similarity * F.greatest(na, nb))
            .filter(both >= similarity * (na + nb - both))
            .select("a", "b"))


def set_sizes(sets: DataFrame) -> DataFrame:
    """(node, size, shared, bitmap): how many shingles a node has, how many of them any
    other row holds, too, and the bitmap of their hashes (null for a node of two texts)."""
    own = (sets.select("node", F.explode("shingles").alias("s")).groupBy("s")
           .agg(F.count("*").alias("rows"), F.min("node").alias("node")).filter("rows = 1")
           .groupBy("node").agg(F.count("*").alias("alone")))
    return (sets.select("node", F.size("shingles").alias("size"), "bitmap").join(own, "node", "left")
            .groupBy("node").agg(F.min("size").alias("size"),
                                 F.when(F.count("*") == 1, F.first("bitmap")).alias("bitmap"),
                                 F.max(F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared")))


def _ordered(a, b) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _possible(similarity: float):
    """Whether sizes and shared shingles of a member and the other (o_*) allow the
    similarity: an intersection of s / (1 + s) of both sizes together."""
    least = (F.col("size") + F.col("o_size")) * (similarity / (1 + similarity)) - 1e-6
    return (F.col("shared") >= least) & (F.col("o_shared") >= least)


def _by_bitmap(similarity: float):
    """Whether the bitmaps allow it: no text has more shingles outside the other than
    its size less that intersection."""
    least = (F.col("size") + F.col("o_size")) * (similarity / (1 + similarity)) - 1e-6

    def outside(a: str, b: str):
        return F.expr(f"aggregate(zip_with({a}, {b}, (p, q) -> bit_count(p & ~q)), 0, (s, v) -> s + v)")
    return (F.coalesce(F.col("size") - outside("bitmap", "o_bitmap") >= least, F.lit(True))
            & F.coalesce(F.col("o_size") - outside("o_bitmap", "bitmap") >= least, F.lit(True)))


def _centre_edges(members: DataFrame, labels: DataFrame, turn: int, similarity: float) -> DataFrame:
    """For bands that hold several components: a centre and the members apart from it."""
    placed = members.join(labels, "node")
    centre = (placed.groupBy("band")
              .agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                   F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "comp", "size", "shared")).alias("m"))
              .filter("c0 < c1")
              .select("band", F.col("m.node").alias("other"), F.col("m.comp").alias("oc"),
                      F.col("m.size").alias("o_size"), F.col("m.shared").alias("o_shared")))
    return (placed.join(centre, "band").filter((F.col("comp") != F.col("oc")) & _possible(similarity))
            .select(*_ordered("node", "other")).distinct())


def _apart(members: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """The possible pairs of a band that are still in different components."""
    placed = members.join(labels, "node").filter(F.col("shared") >= similarity * F.col("size") - 1e-6)
    mixed = (placed.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
             .filter("c0 < c1").select("band"))
    x = placed.join(mixed, "band")
    y = x.select("band", F.col("node").alias("other"), F.col("comp").alias("oc"),
                 F.col("size").alias("o_size"), F.col("shared").alias("o_shared"), F.col("bitmap").alias("o_bitmap"))
    return (x.join(y, (x.band == y.band) & (x.comp < y.oc) & _possible(similarity) & _by_bitmap(similarity))
            .select(*_ordered("node", "other")).distinct())


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, h1, h2, class_id, copies: the class is the smallest doc_id in it."""
    keyed = text_key(docs).filter("doc_id is not null")
    signed = written(keyed.mapInArrow(tidy(_signer(bands, rows)),
                                      "doc_id long, h1 long, h2 long, bands array<long>"), "near-signed")
    groups = written(signed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("copies"),
        F.min_by("bands", "doc_id").alias("bands")), "near-groups")
    spread = groups.select(F.explode("bands").alias("band"), "node")
    shared = (spread.groupBy("band").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
              .filter("centre < last").select("band", "centre"))
    found = written(spread.join(shared, "band"), "near-members")
    nodes = written(found.select("node").distinct(), "near-nodes")
    wanted = groups.join(nodes, "node", "left_semi").select("h1", "h2", "node")
    chosen = keyed.join(wanted, (keyed.doc_id == wanted.node) & (keyed.h1 == wanted.h1)
                        & (keyed.h2 == wanted.h2)).select("node", "text")
    sets = written(chosen.mapInArrow(tidy(_sets), "node long, shingles array<long>, bitmap array<long>"), "near-sets")

    labels = nodes.select("node", F.col("node").alias("comp"))
    sizes = written(set_sizes(sets), "near-sizes")
    o_sizes = sizes.drop("bitmap").withColumnsRenamed({"node": "centre", "size": "o_size", "shared": "o_shared"})
    tested = written(found.filter("node <> centre").join(sizes, "node").join(o_sizes, "centre")
                     .filter(_possible(similarity)).select(*_ordered("node", "centre")).distinct(), "near-pairs")
    labels = components(labels, verified(tested, sets, similarity))
    members, pairs_made = found.select("band", "node").join(sizes, "node"), [tested]
    for turn in range(rounds + 1):
        pairs = (_centre_edges(members, labels, turn, similarity) if turn < rounds
                 else _apart(members, labels, similarity))
        new = written(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        if new.isEmpty():
            if turn < rounds:
                continue
            break
        labels = components(labels, verified(new, sets, similarity))
        tested = tested.unionByName(new)
        pairs_made.append(new)
    for df in (sets, found, sizes, *pairs_made):
        dropped(df)
    classes = groups.select("h1", "h2", "node", "copies").join(labels, "node", "left")
    return signed.select("doc_id", "h1", "h2").join(classes, ["h1", "h2"]).select(
        "doc_id", "h1", "h2", F.coalesce("comp", "node").alias("class_id"), "copies")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each class, of the smallest doc_id in it, with all its columns;
    rows without doc_id stay."""
    first = (near_duplicates(docs, **options).filter("doc_id = class_id")
             .groupBy(F.col("doc_id").alias("_n_doc")).agg(F.min("h1").alias("_n_h1")))
    keyed = docs.withColumn("_n_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = keyed.join(first, (F.col("doc_id") == F.col("_n_doc")) & (F.col("_n_key") == F.col("_n_h1")))
    # repeated rows: the join has dealt the rows by these columns already
    return (kept.dropDuplicates(["_n_doc", "_n_h1"]).select(*docs.columns)
            .unionByName(docs.filter("doc_id is null")))


def document_classes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, copies of every row; rows without doc_id have no class."""
    return near_duplicates(docs, **options).select("doc_id", "class_id", "copies").unionByName(
        docs.filter("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"),
                                             F.lit(1).cast("long").alias("copies")))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return document_classes(table(spark, sf_dir, "documents"))
