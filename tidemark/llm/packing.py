"""Best-fit packing by length patterns and non-negative least squares.

Every text is tokenised whole, ended with one id and cut into pieces of at most
1024 ids, the shorter piece first. The histogram of piece lengths has 1024 bins
whatever the corpus; all planning is done on it. Patterns of one to three
lengths that fill a sequence are enumerated, their repeat counts fitted to the
histogram by non-negative least squares (projected gradient), rounded down and
limited to what the bins hold. What is left is packed best-fit, largest first,
many equal pieces at a time. The plan is a bounded table of (length, ranks ->
sequences, offset), broadcast and joined with the pieces' ranks within their
length, which are numbered without any task holding a whole length.

The query and the pipeline encode as the tokenizers file does by default: a literal
added token (<|endoftext|>) is its one id. ``pack`` alone takes it as plain text
unless ``added`` is set.

A text that the ranks' pattern can't split (very long runs of white space) is encoded
by the tokenizers file itself, whole.

Null and empty texts are the end id alone. Repeated rows are packed each. Ties
go to the first pattern in order. Only doc_id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import numbered, table, written
from .text import small_batches, tidy

MAX_LEN = 1024
END_ID = 2
NNLS_STEPS = 400


def default_vocabulary() -> str:
    """The ranks of ``byte_bpe_50k.json``, the same vocabulary and ids."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str, added: bool = False):
    """text -> ids. The ranks file gives the ids of the tokenizers file of that
    name (tested); it encodes four times as fast. ``added``: with that file's added tokens."""
    import base64
    import json

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {}
    if added:
        with open(path.removesuffix(".tiktoken") + ".json", encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Encoder:
    """text -> ids, as numpy array; the tokenizers file takes what the ranks' pattern can't split."""

    def __init__(self, path: str, added: bool):
        self.path, self.added, self.ranks, self.whole = path, added, encoder(path, added), None

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.ranks.encode_to_numpy(text, allowed_special="all", disallowed_special=())
        except ValueError:               # the pattern's backtracking has a limit
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path.removesuffix(".tiktoken") + ".json")
                self.whole.encode_special_tokens = not self.added
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


def _cutter(path: str, max_len: int, end_id: int, added: bool):
    def run(batches):
        enc = Encoder(path, added)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in small_batches(batches):
            docs, rows = batch.column("doc_id").to_pylist(), []
            for doc, text in zip(docs, batch.column("text")):
                ids = np.append(enc(text.as_py() or ""), end_id).astype("<u4")
                head = len(ids) % max_len
                cuts = [*([0] if head else []), *range(head, len(ids) + 1, max_len)]
                rows += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                         for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    return run


# -- the plan: lengths only ------------------------------------------------------------------

def patterns(present: np.ndarray, max_len: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, 0 for none, of lengths that exist and add up to ``max_len``."""
    has = np.zeros(max_len + 1, bool)
    has[present] = True
    out = [(max_len, 0, 0)] if has[max_len] else []
    for a in present[present < max_len]:
        rest = max_len - a
        if rest <= a and has[rest]:
            out.append((a, rest, 0))
        b = present[(present <= a) & (present < rest) & (present >= -(-rest // 2))]
        c = rest - b
        ok = has[c]
        out += [(a, x, y) for x, y in zip(b[ok], c[ok])]
    return np.array(out, np.int64).reshape(-1, 3)


def nnls(pattern: np.ndarray, counts: np.ndarray, steps: int = NNLS_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that bring sum(x * pattern) close to the histogram:
    accelerated projected gradient on the squared residual."""
    size = len(counts)
    norm = 9.0 * max(1, np.bincount(pattern[pattern > 0].ravel(), minlength=size).max())
    x = y = np.zeros(len(pattern))
    t = 1.0
    for _ in range(steps):
        fit = np.zeros(size)
        for k in range(3):
            fit += np.bincount(pattern[:, k], y, minlength=size)
        miss = fit - counts
        miss[0] = 0
        step = y - miss[pattern].sum(axis=1) / norm
        new = np.maximum(step, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(histogram: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences); uses every piece once."""
    counts = np.zeros(max_len + 1)
    for length, n in histogram.items():
        counts[length] = n
    left = counts.astype(np.int64)
    out = []
    if left[max_len]:
        out.append(((max_len,), int(left[max_len])))
        left[max_len] = 0
    found = patterns(np.flatnonzero(left), max_len)
    if len(found):
        x = nnls(found, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 0.5:
                break
            lengths = tuple(int(v) for v in found[k] if v)
            own, times = np.unique(lengths, return_counts=True)
            n = int(min(round(x[k]), (left[own] // times).min()))
            if n > 0:
                left[own] -= n * times
                out.append((lengths, n))
    return out + best_fit(left, max_len)


def best_fit(left: np.ndarray, max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: equal pieces and equal bins at a time."""
    bins: dict[int, list] = {}                             # room left -> [(lengths, bins)]
    for length in range(max_len, 0, -1):
        n = int(left[length])
        for room in range(length, max_len):
            while n and bins.get(room):
                lengths, many = bins[room].pop()
                fit = min(room // length, n)
                use = min(many, n // fit)
                if many > use:
                    bins[room].append((lengths, many - use))
                bins.setdefault(room - fit * length, []).append((lengths + (length,) * fit, use))
                n -= use * fit
            if not n:
                break
        if n:
            fit = max_len // length
            for many, each in ((n // fit, fit), (1 if n % fit else 0, n % fit)):
                if many:
                    bins.setdefault(max_len - each * length, []).append(((length,) * each, many))
    return [x for some in bins.values() for x in some]


def plan_rows(sequences: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): the piece of that
    length and rank r goes to sequence first sequence + r - first rank."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, n in sequences:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            out.append((length, rank, rank + n, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return out


def pack(docs: DataFrame, max_len: int = MAX_LEN, end_id: int = END_ID, vocabulary: str | None = None,
         added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = docs.select("doc_id", "text").mapInArrow(
        tidy(_cutter(vocabulary or default_vocabulary(), max_len, end_id, added)),
        "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = written(cut.withColumn("_pid", F.spark_partition_id()), "pack-pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan_rows(plan(histogram, max_len))             # bounded by the number of patterns
    # as Arrow: rows of Python objects would need Python workers of another kind, which stay beside the others
    names = ["length", "rank_from", "rank_end", "sequence", "offset"]
    places = spark.createDataFrame(pa.table(dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))))
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "rank")
    return (ranked.join(F.broadcast(places), "length")
            .filter((F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_end")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset"))


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return pack(table(spark, sf_dir, "documents"), added=True)
