"""Runs of words: stretches that repeat with a period, found exactly.

A run has a smallest period q, at least max(24, 3 * q) words, and can't be extended
by a neighbouring word. So every word of a run occurs three times or more inside it.
*Frequency splitting*: a word that occurs less than three times in the current segment
is in no run of that segment and splits it; parts shorter than a run are dropped, and
the rest is split again by its own counts until nothing changes. *Lag scan* of the
segments that survive: words that a lag q apart are equal form stretches, and a run
is a stretch of at least max(24, 3 * q) - q of them. At each lag it is enough to
probe places half such a stretch apart with the (exact) numbers of eight-word windows
and to extend the hits. Multiples of a period already found inside its run are passed over.

A text is one row and one unit of work, whatever its source; nothing is shuffled.
Very long texts are read into word numbers in pieces, so words are held as numbers
and each different word once.

Null and empty texts, and texts of white space, have no words: n_runs 0, no run.
Repeated rows give repeated rows. Ties of length / period go to the smallest start,
then the smallest period. A row without doc_id is taken as it is (no rewriting in the
query). An empty table gives an empty result. Only doc_id and text are read, so other
columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .frames import table

LEAST_WORDS, LEAST_TURNS = 24, 3
WINDOW = 8
PIECE = 1 << 20
PROBES = 1 << 20
SPACES = re.compile(rb"[\x20\x09-\x0D]")


# -- words ------------------------------------------------------------------------------------

def numbered_words(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the words `[^\\x20\\x09-\\x0D]+` and the words by number."""
    number: dict[bytes, int] = {}
    parts, at = [np.zeros(0, np.int32)], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            edge = SPACES.search(text, end)
            end = edge.start() if edge else len(text)
        give = number.setdefault
        parts.append(np.array([give(w, len(number)) for w in text[at:end].split()], np.int32))
        at = end
    return np.concatenate(parts), list(number)


# -- frequency splitting ------------------------------------------------------------------------

def segments(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches in which every word occurs often enough, in no order."""
    work = [(0, len(words))]
    while work:
        start, end = work.pop()
        if end - start < LEAST_WORDS:
            continue
        part = words[start:end]
        _, place, counts = np.unique(part, return_inverse=True, return_counts=True)
        often = counts[place] >= LEAST_TURNS
        if often.all():
            yield start, end
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8)))
        work += [(start + a, start + b) for a, b in edge.reshape(-1, 2).tolist() if b - a >= LEAST_WORDS]


# -- lag scan --------------------------------------------------------------------------------------

def window_numbers(words: np.ndarray) -> np.ndarray:
    """Equal numbers where the ``WINDOW`` words from a place on are equal (by doubling, exactly)."""
    number, width = words.astype(np.int64), 1
    while width < WINDOW:
        pairs = number[:-width] * (int(number.max()) + 1) + number[width:]
        number, width = np.unique(pairs, return_inverse=True)[1], 2 * width
    return number


def least_stretch(lag: np.ndarray) -> np.ndarray:
    """The fewest equal places at a lag that make a run of that period."""
    return np.maximum(LEAST_WORDS, LEAST_TURNS * lag) - lag


def probes(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lags, places), by rising lag, where the windows at place and place + lag are equal.
    Every stretch long enough for a run covers one such window."""
    number, n = window_numbers(words), len(words)
    lag, last = 1, n // LEAST_TURNS
    while lag <= last:
        # a block of lags with about PROBES places
        step = int(least_stretch(np.int64(lag))) // 2
        block = np.arange(lag, min(last, lag + max(1, PROBES * step // n)) + 1)
        steps = least_stretch(block) // 2
        counts = np.maximum(0, -(-(len(number) - block) // steps))
        lags = np.repeat(block, counts)
        places = (np.arange(len(lags)) - np.repeat(np.cumsum(counts) - counts, counts)) * np.repeat(steps, counts)
        hit = number[places] == number[places + lags]
        if hit.any():
            yield lags[hit], places[hit]
        lag = int(block[-1]) + 1


def equal_from(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries agree."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at:at + step][:n - at] != b[at:at + step][:n - at]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + len(differ), 2 * step
    return n


def runs_of_segment(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs."""
    found: list[tuple[int, int, int]] = []
    by_period: dict[int, list[tuple[int, int]]] = {}
    for lags, places in probes(words):
        while len(lags):
            lag = int(lags[0])
            # what lies inside a run whose period divides the lag has no run of its own
            k = int(np.searchsorted(lags, lag, "right"))
            mine = places[:k]
            lags, places = lags[k:], places[k:]
            for period, ranges in by_period.items():
                if lag % period == 0 and len(mine):
                    mine = mine[~_inside(mine, lag, ranges)]
            end, new = -1, []
            for place in mine.tolist():
                if place < end:
                    continue
                left = equal_from(words[:place][::-1], words[:place + lag][::-1])
                right = place + equal_from(words[place:], words[place + lag:])
                start, end = place - left, right
                if end - start >= int(least_stretch(np.int64(lag))):
                    new.append((start, end + lag))
            if new:
                by_period[lag] = new
                found += [(a, b - a, lag) for a, b in new]
                # drop all later probes inside the new runs at once
                multiple = lags % lag == 0
                if multiple.any():
                    at = np.flatnonzero(multiple)
                    gone = at[_inside(places[at], lags[at], new)]
                    lags, places = np.delete(lags, gone), np.delete(places, gone)
    return found


def _inside(places: np.ndarray, lag, ranges: list[tuple[int, int]]) -> np.ndarray:
    """Whether [place, place + lag] lies in one of the ranges (ordered by start and by end)."""
    starts, ends = np.array(ranges).T
    last = np.searchsorted(starts, places, "right") - 1
    return (last >= 0) & (places + lag <= ends[last])


def runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs by start, then period."""
    out = []
    for a, b in segments(words):
        out += [(a + start, length, period) for start, length, period in runs_of_segment(words[a:b])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def best_run(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; the first of equals."""
    best = None
    for run in found:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: all but those after the first ``period`` words of a run."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def rewritten(words: np.ndarray, doc_id: int | None) -> np.ndarray:
    """The query's test texts: one document in ten has its tail replaced by turns of a
    stretch of it, as crc32 of its id decides."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i >= a, a + (i - a) % p, i)]


# -- frames ------------------------------------------------------------------------------------------

DIGEST = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _digest_of(doc_id: int | None, text: bytes) -> tuple:
    words, names = numbered_words(text)
    words = rewritten(words, doc_id)
    found = runs(words)
    best = best_run(found)
    collapsed = hashlib.sha256()
    kept = words[kept_words(len(words), found)].tolist()
    for at in range(0, len(kept), PIECE):
        collapsed.update(b" " * (at > 0) + b" ".join([names[w] for w in kept[at:at + PIECE]]))
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), collapsed.hexdigest())


def _digests(batches):
    names = [c.split()[0] for c in DIGEST.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    for batch in batches:
        docs, texts = batch.column("doc_id"), batch.column("text").cast(pa.large_binary())
        rows = [_digest_of(d.as_py(), t.as_py() or b"") for d, t in zip(docs, texts)]
        columns = list(zip(*rows)) if rows else [()] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _runs_and_text(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        lists, collapsed = [], []
        for t in batch.column("text").cast(pa.large_binary()):
            words, names = numbered_words(t.as_py() or b"")
            found = runs(words)
            lists.append([dict(zip(("start", "length", "period"), r)) for r in found])
            collapsed.append(b" ".join([names[w] for w in words[kept_words(len(words), found)].tolist()]).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lists, kind), pa.array(collapsed, pa.string())],
            names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): every text's runs and its words without the repeats."""
    return docs.select("doc_id", "text").mapInArrow(
        _runs_and_text, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and collapsed text of every document (rewritten where its id says so), as digests."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(_digests, DIGEST)
