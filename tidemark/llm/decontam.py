"""Benchmark decontamination: BM25 index of the test items, block-max WAND.

The items are a small table, indexed in blocks of neighbouring items; for each
term the index has its postings and the largest score that it can add in each
block. Every training text is cut into overlapping passages, long enough that
a whole item lies in one of them, and every passage is a query. As in WAND,
upper bounds come first: the sum of the terms' maxima over all blocks, then
over each block; only blocks that can reach the threshold are scored. Bounds
never lie below scores, so all items above the threshold are retrieved.
Scores are shares of the score that the item gives itself (1: all its words).
Retrieved items are verified: word trigrams of the item's question (all
sentences but the last) and answer (the last) must occur in the passage.

Null and empty texts have no passages and are clean; items without id or text, and
items of less than ``GRAM`` words, which hold no gram to verify (a word or two
occur anywhere), are left out; an empty benchmark leaves all clean. Equal scores are all
retrieved. Repeated rows are judged alike. Items that share an id are indexed each,
and found under it. Very long texts are searched whole, passage by passage; a very
long item makes all passages as long. Columns of the documents named like the
results (``_d_items``, ``_d_score``, ``_d_overlap``) are replaced.

The benchmark is searched in passes of about ``ITEMS_PER_PASS`` items and at most
``PASS_BYTES`` of item text beside the longest item, with common statistics: an index is broadcast, the documents are searched
and written with what was found, and the index is released before the next is built.
So neither driver nor executors ever hold more than one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import dropped, table, written
from .text import Hasher, byte_classes, lowered, mix, slices, small_batches, text_buffers, tidy, tokens

K1, B = 1.2, 0.75
THRESHOLD = 0.4
QUESTION_OVERLAP, ANSWER_OVERLAP, TOTAL_OVERLAP = 0.5, 0.5, 0.7
GRAM = 3
BLOCK = 16
LEAST_STRIDE = 32
ITEMS_PER_PASS, PASS_BYTES = 20_000, 8 << 20
SLICE = 1 << 18                # bytes of text searched at once: a worker holds some fifty times as much
CELLS_AT_ONCE = 200_000        # passages times blocks that are bounded at once
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def grams(h: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + h[k:k + len(total)]
    return mix(total)


class Words:
    """Hashes of the words of lower-cased texts."""

    def __init__(self):
        self.hasher, self.classes = Hasher(), byte_classes(symbols=True)

    def __call__(self, buf, off):
        start, end, kind, first = tokens(buf, off, self.classes)
        word = kind == 2
        first = np.concatenate([[0], np.cumsum(word)])[first]
        return self.hasher.spans(self.hasher.prefix(buf), start, end)[word], first

    def of(self, text: str) -> np.ndarray:
        buf = np.frombuffer(lowered([text])[0], np.uint8)
        return self(buf, np.array([0, len(buf)]))[0]


class Index:
    """Blocked postings of items, with the largest score of each term and block."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[int, int], n_items: int, mean_words: float):
        words = Words()
        # items of like length share a block: its maxima are then close to its scores
        items = sorted(items, key=lambda x: (len(words.of(x[1])), x[0]))
        self.ids = np.array([i for i, _ in items], np.int64)
        bodies = [words.of(t) for _, t in items]
        self.parts = [self._parts(words, t) for _, t in items]
        self.stride = max([LEAST_STRIDE, *map(len, bodies)])
        self.terms = np.unique(np.concatenate(bodies))
        n_blocks = -(-len(items) // BLOCK)
        df = np.array([frequency.get(int(t), 1) for t in self.terms], float)
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        term, item, impact = [], [], []
        for k, h in enumerate(bodies):
            own, times = np.unique(h, return_counts=True)
            at = np.searchsorted(self.terms, own)
            gain = idf[at] * times * (K1 + 1) / (times + K1 * (1 - B + B * len(h) / mean_words))
            term.append(at)
            item.append(np.full(len(at), k))
            impact.append(gain / gain.sum())
        term, item, impact = map(np.concatenate, (term, item, impact))
        cell = term * n_blocks + item // BLOCK
        order = np.argsort(cell, kind="stable")
        self.n_blocks, self.item, self.impact = n_blocks, item[order], impact[order]
        # only the (term, block) cells that hold postings are kept
        self.cells, begin = np.unique(cell[order], return_index=True)
        self.begin = np.append(begin, len(cell))
        self.block_max = np.maximum.reduceat(self.impact, begin) * 1.000001
        self.term_begin = np.searchsorted(self.cells, np.arange(len(self.terms) + 1) * n_blocks)
        self.term_max = np.maximum.reduceat(self.block_max, self.term_begin[:-1])

    @classmethod
    def from_parts(cls, parts: dict) -> "Index":
        """The index with these attributes: plain arrays travel, the class does not."""
        index = cls.__new__(cls)
        index.__dict__.update(parts)
        return index

    @staticmethod
    def _parts(words: Words, text: str) -> list[np.ndarray]:
        """Distinct grams of question and answer."""
        sentences = re.split(r"(?<=[.!?])\s+", text.strip())
        halves = [" ".join(sentences[:-1]), sentences[-1]] if len(sentences) > 1 else [text, ""]
        out = []
        for half in halves:
            h = words.of(half)
            size = min(GRAM, len(h))
            out.append((size, np.unique(grams(h, size)) if size else h))
        return out

    def passages(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and document of each passage: two strides long, a stride apart."""
        n = np.diff(first)
        count = np.where(n > 0, np.maximum(1, -(-n // self.stride) - 1), 0)
        doc = np.repeat(np.arange(len(n)), count)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        return first[:-1][doc] + place * self.stride, doc

    def search(self, h: np.ndarray, first: np.ndarray, threshold: float):
        """Yields (document, item, score, passage start, passage end) above the threshold."""
        begin, doc = self.passages(first)
        if not len(begin) or not len(self.terms):
            return
        stop = np.minimum(begin + 2 * self.stride, first[1:][doc])
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[at] == h)
        last = np.searchsorted(begin, known, "right") - 1        # the last passage that holds the word
        pair = (last > 0) & (stop[last - 1] > known) & (doc[last - 1] == doc[last])
        key = np.concatenate([last, last[pair] - 1]) * len(self.terms) + np.concatenate([at[known], at[known][pair]])
        key = np.unique(key)
        passage, term = key // len(self.terms), key % len(self.terms)
        bound = np.bincount(passage, self.term_max[term], minlength=len(begin))
        alive = bound[passage] >= threshold
        passage, term = passage[alive], term[alive]
        if not len(passage):
            return
        own, cut = np.unique(passage, return_index=True)
        cut = np.append(cut, len(passage))
        step = max(16, CELLS_AT_ONCE // self.n_blocks)
        for a in range(0, len(own), step):
            z = min(a + step, len(own))
            mine = term[cut[a]:cut[z]]
            bounds = self._bounds(mine, cut[a:z + 1] - cut[a])
            for p, item, score in self._scores(mine, cut[a:z + 1] - cut[a], *np.nonzero(bounds >= threshold)):
                for k in np.flatnonzero(score >= threshold):
                    q = own[a + p[k]]
                    yield int(doc[q]), int(item[k]), float(score[k]), int(begin[q]), int(stop[q])

    def _bounds(self, term, cut) -> np.ndarray:
        """Passages x blocks: the sum of the terms' maxima in each block."""
        count = self.term_begin[term + 1] - self.term_begin[term]
        cell = np.repeat(self.term_begin[term] - np.cumsum(count) + count, count) + np.arange(count.sum())
        passage = np.repeat(np.repeat(np.arange(len(cut) - 1), np.diff(cut)), count)
        place = passage * self.n_blocks + self.cells[cell] % self.n_blocks
        return np.bincount(place, self.block_max[cell], minlength=(len(cut) - 1) * self.n_blocks).reshape(-1, self.n_blocks)

    def _scores(self, term, cut, passage, block):
        """Yields (passage, item, score) arrays of all items of the blocks, for the
        (passage, block) pairs; passage p has the terms cut[p] to cut[p + 1]."""
        n_blocks = self.n_blocks
        for a in range(0, len(passage), 4096):
            p, b = passage[a:a + 4096], block[a:a + 4096]
            many = cut[p + 1] - cut[p]
            pair = np.repeat(np.arange(len(p)), many)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + cut[p][pair]
            wanted = term[at] * n_blocks + b[pair]
            cell = np.minimum(np.searchsorted(self.cells, wanted), len(self.cells) - 1)
            held = self.cells[cell] == wanted
            cell, pair = cell[held], pair[held]
            count = self.begin[cell + 1] - self.begin[cell]
            row = np.repeat(self.begin[cell] - np.cumsum(count) + count, count) + np.arange(count.sum())
            place = np.repeat(pair, count) * BLOCK + self.item[row] % BLOCK
            score = np.bincount(place, self.impact[row], minlength=len(p) * BLOCK)
            hit = np.flatnonzero(score)
            yield p[hit // BLOCK], b[hit // BLOCK] * BLOCK + hit % BLOCK, score[hit]

    def overlap(self, item: int, h: np.ndarray) -> tuple[float, float, float]:
        """Shares of the question's, the answer's and all grams that occur in the passage."""
        found, total, share = 0, 0, []
        for size, own in self.parts[item]:
            n = int(np.isin(own, grams(h, size)).sum()) if size else 0
            found, total = found + n, total + len(own)
            share.append(n / len(own) if len(own) else 1.0)
        return share[0], share[1], found / max(1, total)


def index_passes(benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS, pass_bytes: int = PASS_BYTES
                 ) -> Iterator[Index]:
    """The items' indexes, one pass after the other; document frequencies and lengths
    are those of all items. The items are written once, so all passes see the same."""
    items = benchmark.select("item_id", "text").dropna().distinct()
    cut = items.withColumn("w", F.filter(F.split(F.lower("text"), NOT_WORD), lambda w: w != ""))
    cut = written(cut.filter(F.size("w") >= GRAM), "decontam-items")
    n, mean, size, longest = cut.agg(F.count("*"), F.avg(F.size("w")), F.sum(F.octet_length("text")),
                                     F.max(F.octet_length("text"))).first()
    # dealt by hash: half as large on average as allowed, beside the longest item
    parts = max(-(-n // per_pass), -(-size // max(1, pass_bytes // 2))) if n else 0
    placed = cut.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts))))
    frequency = cut.select(F.explode(F.array_distinct("w")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    words = Words()
    for p in range(parts):
        mine = placed.filter(F.col("part") == p)
        held = mine.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        if held > pass_bytes + longest:
            raise ValueError(f"a pass of {held} bytes of benchmark items: more than {pass_bytes}")
        own = mine.select(F.explode("w").alias("word")).distinct().join(frequency, "word").collect()
        df = {int(words.of(r.word)[0]): r.df for r in own}
        rows = [(r.item_id, r.text) for r in mine.select("item_id", "text").collect()]
        if rows:
            yield Index(rows, df, n, mean)
    dropped(cut)


def build_indexes(benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> list[Index]:
    """All passes' indexes at once, for a benchmark that is known to be small."""
    return list(index_passes(benchmark, per_pass))


RESULT = [T.StructField("_d_items", T.ArrayType(T.LongType())), T.StructField("_d_score", T.DoubleType()),
          T.StructField("_d_overlap", T.DoubleType())]


def _searched(docs: DataFrame, index: Index, threshold: float) -> tuple[DataFrame, Broadcast]:
    """``docs`` with the result columns raised by what one index finds."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(index))   # bounded by PASS_BYTES
    kept = [f for f in docs.schema.fields if f.name not in {r.name for r in RESULT}]

    def run(batches):
        words, index = Words(), Index.from_parts(shared.value)
        for batch in small_batches(batches):
            buf, off = text_buffers(batch.column("text"), lower=True)
            found = [dict() for _ in range(len(batch))]
            for i, j in slices(off, SLICE):
                h, first = words(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                for d, item, score, begin, stop in index.search(h, first, threshold):
                    q, a, all_ = index.overlap(item, h[begin:stop])
                    if q >= QUESTION_OVERLAP and (a >= ANSWER_OVERLAP or all_ >= TOTAL_OVERLAP):
                        was = found[i + d].get(int(index.ids[item]), (0.0, 0.0))
                        found[i + d][int(index.ids[item])] = (max(was[0], score), max(was[1], all_))
            before = [batch.column(r.name).to_pylist() for r in RESULT]
            after = [(sorted({*items, *f}), max([score, *(x[0] for x in f.values())]),
                      max([overlap, *(x[1] for x in f.values())])) for f, items, score, overlap in zip(found, *before)]
            columns = list(zip(*after)) if after else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept),
                 *(pa.array(c, k) for c, k in zip(columns, (pa.list_(pa.int64()), pa.float64(), pa.float64())))],
                names=[*(f.name for f in kept), *(r.name for r in RESULT)])
    return docs.mapInArrow(tidy(run), T.StructType([*kept, *RESULT])), shared


def with_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
               per_pass: int = ITEMS_PER_PASS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` with ``_d_items`` (ids of the items found, sorted), ``_d_score``
    and ``_d_overlap`` (the largest of any verified item; 0 without)."""
    out = docs.withColumns({"_d_items": F.array().cast("array<long>"), "_d_score": F.lit(0.0), "_d_overlap": F.lit(0.0)})
    earlier = None
    for index in index_passes(benchmark, per_pass, pass_bytes):
        if earlier is not None:       # another pass: write what the last one found, release its index
            out = written(out, "decontam-pass")
            earlier.destroy()
        out, earlier = _searched(out, index, threshold)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item was found, with their own columns."""
    aside = {r.name: f"_aside{r.name}" for r in RESULT if r.name in docs.columns}
    out = with_leaks(docs.withColumnsRenamed(aside), benchmark).filter(F.size("_d_items") == 0)
    return out.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """The benchmark items found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_leaks(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("_d_items") > 0).alias("contaminated"),
                      F.col("_d_items").alias("items"), F.col("_d_score").alias("score"),
                      F.col("_d_overlap").alias("overlap"))
