"""Suffix-array dedup: remove byte runs that an earlier document holds, too.

Every byte of a text that lies in a 50-byte string which also starts in a
document with a smaller doc_id is removed. Strings are judged on the input.

1. Anchors. Of every 31 neighbouring 20-byte grams the one with the smallest
   hash is an anchor, so each 50-byte string holds at least one and equal
   strings hold the same. About one position in 16 is an anchor. Anchors are
   dealt by gram hash in packed blobs, and those whose gram occurs in one
   document only are dropped. A gram that a task sees in two documents is known
   to be shared: its anchors are dealt by document, and only two of them, with
   their number, by gram. So a gram that many documents hold leaves each task as two rows.
2. Contexts. The anchors left are joined with their texts; 30 bytes before and
   50 bytes from the anchor on are dealt by gram hash and go through the
   hash-compared suffix sort (see ``suffix_sort``), which finds for each of the 31
   windows around an anchor whether a smaller document holds it. Of equal
   contexts in one task only those of the smallest document are dealt; the others
   are covered. Hot grams (``HOT`` anchors or more) may still have any number of
   different contexts. Theirs are cut into their 31 windows, equal windows are
   collapsed in the same way, and what is left is dealt by the hash of the window,
   so that no task holds a gram. All bytes are verified on either way.
3. Removal. The windows found are joined with the texts by document.

Null and empty texts have no strings, an empty table gives no rows. A text of any
length is one row of a task and is read whole. Rows without doc_id are neither
earlier nor later than others and stay whole. Rows that share a doc_id don't count
against each other (a tie removes nothing); each is judged by itself, and repeated
rows get equal results. Columns other than doc_id and text are not read, so
their names can't clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .frames import dropped, shuffle_width, table, written
from .suffix_sort import earlier_windows, row_hash
from .text import Hasher, mix, slices, small_batches, text_buffers, tidy

SPAN = 50
GRAM = 20
LEFT = SPAN - GRAM             # bytes of context before an anchor
BUCKETS_PER_PARTITION = 4
CUT_BYTES = 2 << 20            # text whose contexts are cut at once
HASHED_BYTES = 1 << 18         # text whose grams are hashed at once
ROWS_AT_ONCE = 1 << 13         # contexts whose bytes are copied at once: eight bytes of index each
ANCHORS_AT_ONCE = 1 << 19      # anchors that a task holds before it deals them
HOT = 1 << 16                  # anchors of a gram from which on its contexts are dealt by window
HOT_GRAMS = 1 << 20            # at most so many grams are hot; beyond, HOT grows with the input
TEXT_LEVEL = 5                 # texts travel twice: 5 % smaller than at level 1
WITNESS = 1 << 31              # marks rows that stand for anchors dealt by document
KNOWN = 0
CONTEXT, DONE, WINDOW = 0, 1, 2
# 48 bits of a gram's hash are dealt: two grams that share them are told apart by their bytes later
GRAM_BITS = np.uint64((1 << 48) - 1)
WINDOWS_AT_ONCE = 1 << 18      # windows of hot grams that a task holds before it deals them
KEYED = "doc_id long, crc long, kind int, body binary"


# -- packed columns ------------------------------------------------------------------------

def pack_columns(*columns: np.ndarray) -> bytes:
    """Equally long 1-d columns, bytes of equal weight side by side, compressed."""
    parts = [np.array([len(columns[0]), *(c.dtype.itemsize for c in columns)], np.int64).tobytes()]
    for c in columns:
        parts.append(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack_columns(blob: bytes, dtypes: tuple) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, at, out = int(raw[:8].view(np.int64)[0]), 8 * (1 + len(dtypes)), []
    for t in dtypes:
        size = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(t).reshape(n))
        at += n * size
    return out


def blobs_by_bucket(bucket: np.ndarray, *columns: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    own, start = np.unique(bucket[order], return_index=True)
    ends = np.append(start[1:], len(order))
    return own, [pack_columns(*(c[order[a:b]] for c in columns)) for a, b in zip(start, ends)]


def blob_batch(kind: int, bucket: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    own, blobs = blobs_by_bucket(bucket.astype(np.int32), *columns)
    return pa.RecordBatch.from_arrays(
        [pa.array(own), pa.array(np.full(len(own), kind, np.int32)), pa.array(blobs, pa.binary())],
        names=["bucket", "kind", "blob"])


def bucket_batches(batches):
    """(kind, [blob, ...]) from batches sorted by bucket and kind."""
    last, held = None, []
    for batch in batches:
        for key, blob in zip(zip(batch.column("bucket").to_pylist(), batch.column("kind").to_pylist()),
                             batch.column("blob").to_pylist()):
            if key != last and held:
                yield last[1], held
                held = []
            last = key
            held.append(blob)
    if held:
        yield last[1], held


def unpacked(blobs: list[bytes], dtypes: tuple) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*(unpack_columns(b, dtypes) for b in blobs))]


def smallest_twins(key: np.ndarray, doc: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which rows equal a row of a smaller document; rows of one key are compared byte by byte."""
    _, rep, twin = np.unique(key, return_index=True, return_inverse=True)
    same = (rows == rows[rep[twin]]).all(axis=1)
    least = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(least, twin[same], doc[same])
    return same & (doc > least[twin])


def keyed_rows(doc: np.ndarray, crc: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row per document; the body holds its rows of the 4-byte columns."""
    order = np.lexsort((crc, doc))
    doc, crc = doc[order], crc[order]
    data = np.stack([c[order].astype(np.uint32) for c in columns], axis=1)
    new = np.append(True, (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1])) if len(doc) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    ends = np.append(start, len(doc)).astype(np.int64) * 4 * len(columns)
    body = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[start]), pa.array(crc[start].astype(np.int64)),
         pa.array(np.zeros(len(start), np.int32)), body.cast(pa.binary())],
        names=["doc_id", "crc", "kind", "body"])


# -- 1. anchors ----------------------------------------------------------------------------

def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[:len(x) - (width - done)], x[width - done:]) if done < width else x


def anchors(buf: np.ndarray, off: np.ndarray, hasher: Hasher, gram: int = GRAM, window: int = SPAN - GRAM + 1):
    """(position, gram hash, document): the smallest of every ``window`` neighbouring grams."""
    if len(buf) < gram + window - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = hasher.prefix(buf)
    n = len(buf) - gram + 1
    g = mix((h[gram:] - h[:-gram]) * hasher.down[:n])
    rank = (g >> np.uint64(32)).astype(np.uint32)
    least = _sliding(rank, window, np.minimum)
    edge = np.zeros(window - 1, np.uint32)
    at = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == rank)
    doc = np.searchsorted(off, at, "right") - 1
    inside = (at + gram <= off[doc + 1]) & (off[doc + 1] - off[doc] >= gram + window - 1)
    return at[inside], g[at[inside]], doc[inside]


def _anchor_blobs(buckets: int):
    def run(batches):
        hasher = Hasher()
        for batch in small_batches(batches):
            buf, off = text_buffers(batch.column("text"))
            ids, crc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "crc"))
            parts, held = [], 0
            for i, j in slices(off, HASHED_BYTES):
                at, g, doc = anchors(buf[off[i]:off[j]], off[i:j + 1] - off[i], hasher)
                parts.append((g, doc + i, (at - (off[i:j] - off[i])[doc]).astype(np.uint32)))
                held += len(g)
                if held > ANCHORS_AT_ONCE:
                    yield deal(parts, ids, crc)
                    parts, held = [], 0
            if held:
                yield deal(parts, ids, crc)

    def deal(parts, ids, crc):
        g, doc, at = (np.concatenate(x) for x in zip(*parts))
        g, crc, doc = g & GRAM_BITS, crc[doc].astype(np.uint32), ids[doc]
        order = np.argsort(g)
        first = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1]))
        size = np.diff(np.append(first, len(g)))
        least, most = (pick.reduceat(doc[order], first) for pick in (np.minimum, np.maximum))
        shared = least < most
        known = np.empty(len(g), bool)                     # rows stay in the texts' order, which compresses
        known[order] = np.repeat(shared, size)
        value, none = np.tile(g[order][first[shared]], 2), np.zeros(2 * int(shared.sum()), np.uint32)
        n = np.concatenate([np.where(known, KNOWN, 1), size[shared] | WITNESS, WITNESS | none[:len(none) // 2]])
        bucket = np.append(np.where(known, mix(doc.view(np.uint64)), g), value) % np.uint64(buckets)
        g = np.append(np.where(known, np.uint64(0), g), value)          # nobody asks for a known one's again
        doc = np.concatenate([doc, least[shared], most[shared]])
        return blob_batch(0, bucket, g.astype(np.uint32), (g >> np.uint64(32)).astype(np.uint16), doc,
                          np.append(crc, none), np.append(at, none), n.astype(np.uint32))
    return run


def _shared_anchors(batches):
    """Positions, by document, of the anchors whose gram is in two documents or more; as rows
    of kind 2 the grams with ``HOT`` anchors or more, and of kind 3 the number of anchors."""
    for _, blobs in bucket_batches(batches):
        low, high, doc, crc, at, n = unpacked(blobs, (np.uint32, np.uint16, np.int64, np.uint32, np.uint32, np.uint32))
        known = n == KNOWN
        if known.any():
            yield keyed_rows(doc[known], crc[known], at[known])
        low, high, doc, crc, at, n = (x[~known] for x in (low, high, doc, crc, at, n))
        if not len(doc):
            continue
        g = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        order = np.argsort(g)
        start = np.flatnonzero(np.append(True, g[order][1:] != g[order][:-1]))
        d = doc[order]
        several = np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start)
        held = np.add.reduceat((n[order] & np.uint32(WITNESS - 1)).astype(np.int64), start)
        keep = order[np.repeat(several, np.diff(np.append(start, len(order))))]
        keep = keep[n[keep] == 1]
        if len(keep):
            yield keyed_rows(doc[keep], crc[keep], at[keep])
        hot = np.flatnonzero(held >= HOT)
        value = np.append(g[order][start[hot]].astype(np.int64), 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(value), pa.array(np.append(held[hot], held.sum())),
             pa.array(np.append(np.full(len(hot), 2), 3).astype(np.int32)), pa.array([b""] * len(value), pa.binary())],
            names=["doc_id", "crc", "kind", "body"])


def hot_grams(shared: DataFrame) -> np.ndarray:
    """The grams whose contexts are dealt by window, sorted. With n anchors in all none of them
    has less than n / HOT_GRAMS, so there are HOT_GRAMS (8 MB) at most."""
    total = shared.filter("kind = 3").agg(F.sum("crc")).first()[0] or 0
    rows = shared.filter((F.col("kind") == 2) & (F.col("crc") >= max(HOT, -(-total // HOT_GRAMS)))).select("doc_id")
    return np.sort(np.array([r.doc_id for r in rows.collect()], np.uint64))


# -- 2. contexts ---------------------------------------------------------------------------

def _documents(batches):
    """(doc_id, crc, body of kind 0 joined, text, rest) for each text, from rows sorted
    by key and kind; rest is None where the rows have no such column."""
    key, found = None, []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "crc", "kind", "body")]
        columns.append(batch.column("rest").to_pylist() if "rest" in batch.schema.names else [None] * len(batch))
        for doc, crc, kind, body, rest in zip(*columns):
            if (doc, crc) != key:
                key, found = (doc, crc), []
            if kind == 0:
                found.append(body)
            else:
                yield doc, crc, b"".join(found), zstandard.ZstdDecompressor().decompress(body), rest


def context_rows(buf: np.ndarray, start: np.ndarray, ahead: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The bytes from ``LEFT`` before to ``SPAN`` from each start on, 0 beyond ``ahead`` and ``after``."""
    place = np.arange(-LEFT, SPAN)
    rows = np.empty((len(start), LEFT + SPAN), np.uint8)
    for a in range(0, len(start), ROWS_AT_ONCE):
        some = np.s_[a:a + ROWS_AT_ONCE]
        part = buf[np.clip(start[some, None] + place, 0, len(buf) - 1)]
        part[(place < -ahead[some, None]) | (place >= after[some, None])] = 0
        rows[some] = part
    return rows


def _context_blobs(buckets: int, hot):
    width = LEFT + SPAN

    def cut(docs, hasher):
        buf = np.frombuffer(b"".join(d[3] for d in docs), np.uint8)
        size = np.array([len(d[3]) for d in docs])
        off = np.cumsum(size) - size
        at = [np.frombuffer(d[2], np.uint32).astype(np.int64) for d in docs]
        doc = np.repeat(np.arange(len(docs)), [len(x) for x in at])
        at = np.concatenate(at)
        ahead, after = np.minimum(at, LEFT), np.minimum(size[doc] - at, SPAN)
        start = at + off[doc]
        rows = context_rows(buf, start, ahead, after)
        ids, crc = (np.array([d[k] for d in docs], np.int64) for k in (0, 1))
        ids, crc = ids[doc], crc[doc].astype(np.uint32)
        room = (ahead * 256 + after).astype(np.uint16)
        offsets = np.arange(LEFT + 1)
        fits = (offsets <= ahead[:, None]) & (SPAN - offsets <= after[:, None])
        g, key = np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)
        for i, j in slices(np.append(off, len(buf)), HASHED_BYTES):
            own, first = np.s_[np.searchsorted(doc, i):np.searchsorted(doc, j)], off[i]
            h = hasher.prefix(buf[first:off[j - 1] + size[j - 1]])
            g[own] = hasher.spans(h, start[own] - first, start[own] - first + GRAM)
            key[own] = hasher.spans(h, start[own] - first - ahead[own], start[own] - first + after[own])
        done = smallest_twins(key ^ mix(room.astype(np.uint64)), ids, rows)
        mask = np.zeros(len(rows), np.uint32)
        for o in offsets:
            mask[done & fits[:, o]] |= np.uint32(1 << o)
        apart = ~done & np.isin(g & GRAM_BITS, hot.value)
        h = hasher.prefix(buf) if apart.any() else None
        parts, held = [], 0
        for o in range(LEFT + 1) if apart.any() else ():   # the windows of hot grams
            on = np.flatnonzero(apart & fits[:, o])
            window = np.ascontiguousarray(rows[on, LEFT - o:LEFT - o + SPAN])
            key = hasher.spans(h, start[on] - o, start[on] - o + SPAN)
            later = smallest_twins(key, ids[on], window)
            mask[on[later]] |= np.uint32(1 << o)
            on, key, window = on[~later], key[~later], window[~later]
            parts.append((key % np.uint64(buckets), ids[on], crc[on], at[on].astype(np.uint32),
                          np.full(len(on), o, np.uint8), window.view(f"V{SPAN}").reshape(-1)))
            held += len(on)
            if held > WINDOWS_AT_ONCE or held and o == LEFT:
                yield blob_batch(WINDOW, *(np.concatenate(x) for x in zip(*parts)))
                parts, held = [], 0
        hit = np.flatnonzero(mask)
        if len(hit):
            yield blob_batch(DONE, mix(ids[hit].view(np.uint64)) % np.uint64(buckets), ids[hit], crc[hit],
                             at[hit].astype(np.uint32), mask[hit])
        rest = np.flatnonzero(~done & ~apart)
        if len(rest):
            yield blob_batch(CONTEXT, g[rest] % np.uint64(buckets), ids[rest], crc[rest], at[rest].astype(np.uint32),
                             room[rest], rows[rest].view(f"V{width}").reshape(-1))

    def run(batches):
        hasher, held, size = Hasher(), [], 0
        for doc in _documents(batches):
            if doc[2]:
                held.append(doc)
                size += len(doc[3])
            if size > CUT_BYTES:
                yield from cut(held, hasher)
                held, size = [], 0
        if held:
            yield from cut(held, hasher)
    return run


def _earlier(batches):
    """(position, window mask) by document of the anchors with a window in a smaller document."""
    ids = (np.int64, np.uint32, np.uint32)
    for kind, blobs in bucket_batches(batches):
        if kind == DONE:
            doc, crc, at, mask = unpacked(blobs, (*ids, np.uint32))
        elif kind == WINDOW:
            doc, crc, at, o, rows = unpacked(blobs, (*ids, np.uint8, f"V{SPAN}"))
            rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(doc), SPAN)
            # a window is its own anchor, so that different windows need no sort
            found = earlier_windows(row_hash(rows, 0), doc, rows, np.zeros(len(doc), np.int64),
                                    np.full(len(doc), SPAN), 0, SPAN)
            mask = found << o.astype(np.uint32)
        else:
            doc, crc, at, room, rows = unpacked(blobs, (*ids, np.uint16, f"V{LEFT + SPAN}"))
            rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(doc), LEFT + SPAN)
            g = row_hash(rows[:, LEFT:LEFT + GRAM], 0)         # the gram is in the context
            mask = earlier_windows(g, doc, rows, (room >> 8).astype(np.int64), (room & 255).astype(np.int64),
                                   LEFT, SPAN)
        hit = np.flatnonzero(mask)
        if len(hit):
            yield keyed_rows(doc[hit], crc[hit], at[hit], mask[hit])


# -- 3. removal ----------------------------------------------------------------------------

def covered(windows: bytes, size: int) -> np.ndarray:
    """Which of ``size`` bytes lie in a window found."""
    pairs = np.frombuffer(windows, np.uint32).reshape(-1, 2)
    bits = (pairs[:, 1:] >> np.arange(LEFT + 1, dtype=np.uint32)) & 1
    row, o = np.nonzero(bits)
    start = pairs[row, 0].astype(np.int64) - o
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + SPAN, -1)
    return np.cumsum(change[:-1]) > 0


def _removed(rest_type: pa.DataType | None):
    """One row per text; with ``rest_type`` also the text left and the rest of its row."""
    names = ["doc_id", "crc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    if rest_type is not None:
        names, kinds = [*names, "kept", "rest"], [*kinds, pa.string(), rest_type]

    def run(batches):
        rows, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for doc, crc, windows, text, rest in _documents(batches):
            kept, n_removed, n_spans = text, 0, 0
            if windows:
                gone = covered(windows, len(text))
                n_removed = int(gone.sum())
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            row = (doc, crc, len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest())
            rows.append(row if rest_type is None else (*row, kept.decode("utf-8", "ignore"), rest))
            size += 100 if rest_type is None else len(kept)
            if size > 8 << 20:
                yield out()
                rows, size = [], 0
        if rows:
            yield out()
    return run


def _bodies(batches):
    zip_ = zstandard.ZstdCompressor(level=TEXT_LEVEL)
    for batch in small_batches(batches):
        body = [zip_.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        rest = ["rest"] if "rest" in batch.schema.names else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("crc"), pa.array(np.ones(len(body), np.int32)),
             pa.array(body, pa.binary()), *[batch.column(c) for c in rest]],
            names=["doc_id", "crc", "kind", "body", *rest])


def remove_repeats(docs: DataFrame, rest: Column | None = None) -> DataFrame:
    """doc_id, crc (of the text), n_bytes, n_removed, n_spans, kept_sha256. With a struct
    column ``rest`` of the documents also kept, the text left (whole characters), and rest."""
    spark = docs.sparkSession
    parts = shuffle_width(spark)
    buckets = parts * BUCKETS_PER_PARTITION
    keyed = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"),
                        *([rest.alias("rest")] if rest is not None else []))
    rest_kind = None if rest is None else keyed.schema["rest"].dataType
    texts = keyed.drop("rest").mapInArrow(tidy(_bodies), KEYED)
    known = keyed.drop("rest").filter("doc_id is not null")

    def by_bucket(df: DataFrame) -> DataFrame:
        return df.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind")

    def with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
        return (rows.unionByName(texts, allowMissingColumns=True).repartition(parts, "doc_id", "crc")
                .sortWithinPartitions("doc_id", "crc", "kind"))
    blob = "bucket int, kind int, blob binary"
    shared = written(by_bucket(known.mapInArrow(tidy(_anchor_blobs(buckets)), blob))
                     .mapInArrow(tidy(_shared_anchors), KEYED), "suffix-anchors")
    hot = spark.sparkContext.broadcast(hot_grams(shared))
    places = shared.filter("kind = 0")
    windows = written(by_bucket(with_texts(places, texts).mapInArrow(tidy(_context_blobs(buckets, hot)), blob))
                      .mapInArrow(tidy(_earlier), KEYED), "suffix-windows")
    dropped(shared)
    result = "doc_id long, crc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if rest is None:
        return with_texts(windows, texts).mapInArrow(tidy(_removed(None)), result)
    whole = keyed.mapInArrow(tidy(_bodies), T.StructType([*T.StructType.fromDDL(KEYED).fields,
                                                    T.StructField("rest", rest_kind)]))
    return with_texts(windows, whole).mapInArrow(tidy(_removed(to_arrow_type(rest_kind))), T.StructType([
        *T.StructType.fromDDL(result).fields, T.StructField("kept", T.StringType()),
        T.StructField("rest", rest_kind)]))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated runs cut out of the texts; ``n_chars``, if there, follows."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(F.col("text").isNull().alias("_s_none"), *others)
    cut = remove_repeats(docs, rest)
    columns = {c: F.col("rest").getField(c) for c in others}
    columns |= {"doc_id": F.col("doc_id"), "text": F.when(~F.col("rest._s_none"), F.col("kept"))}
    if "n_chars" in others:
        columns["n_chars"] = F.when(F.col("n_removed") == 0, columns["n_chars"]).otherwise(
            F.length("kept").cast(docs.schema["n_chars"].dataType))
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed from every document."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
