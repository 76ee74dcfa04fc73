"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text gets a space in front, spaces become the mark U+2581, and its characters
are symbols. An agenda holds every two adjacent symbols whose joint string is a
piece; the best score is merged first, the leftmost of equals, and the merged
symbol's new pairs enter the agenda, until it is empty. A symbol that is no piece
becomes its bytes' pieces.

Where no piece has a mark after another character, merges can't cross such a place;
texts are cut into units there (and around line ends, if no longer piece has one). A
slice of texts has many equal units: each different one is encoded once, the agendas
of all short ones advancing together in numpy. None of this changes an id.

In the same Arrow batches the library encodes every whole text and decodes the ids;
the column ``agrees`` says whether ids and decoded text are the same. No row is
sampled or cut for that.

Null and empty texts have no ids and decode to the empty text. Very long texts are
encoded whole, a unit of any length in n log n. Repeated rows and repeated or null
doc_ids are kept, one row each. Ties are as above. An empty table gives an empty
result. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .frames import table
from .text import slices, text_buffers

MARK = "▁"
SLICE = 4 << 20
SHORT = 48
NEVER = 1 << 40
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """Encoder and decoder of one model file (read on the executor that uses it)."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = {p.type for p in model.pieces}
        norm, trained = model.normalizer_spec, model.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces
                or trained.treat_whitespace_as_suffix):
            raise ValueError("a merge vocabulary with byte fallback, without normalisation rules, "
                             "user-defined or unused pieces is needed")
        codecs.register_error("each_wrong_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
        self.prefix = MARK if norm.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        order = {s: k for k, s in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.rank = {p.piece: order[p.score] for p in model.pieces if p.type == NORMAL and len(p.piece) > 1}
        self.digits = [str(i) for i in range(len(model.pieces))]
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.surface.append(bytes([int(p.piece[3:5], 16)]))
            else:
                self.surface.append({NORMAL: p.piece.replace(MARK, " "), CONTROL: "",
                                     UNKNOWN: trained.unk_surface}[p.type].encode())
        self.bytes = set(self.byte_ids)
        self.joined = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.cuts_at_marks = not any(a != MARK and b == MARK for a, b in self.joined)
        self.cuts_at_line_ends = not any("\n" in p for p in self.joined)
        self._number_merges()

    def _number_merges(self) -> None:
        """The merges by number: (left, right) -> piece, sorted. Every piece has its id as
        number; characters that occur in longer pieces only come after them."""
        number = dict(self.ids)
        for c in sorted(set("".join(self.rank)) - number.keys()):
            number[c] = len(self.digits) + len(number) - len(self.ids)
        self.width = len(self.digits) + len(number) - len(self.ids)
        self.number = np.full(0x110000, -1, np.int64)
        for p, i in number.items():
            if len(p) == 1:
                self.number[ord(p)] = i
        pairs = sorted((number[p[:k]] * self.width + number[p[k:]], self.rank[p], number[p])
                       for p in self.rank for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.keys, self.key_rank, self.key_piece = (np.array(x, np.int64) for x in zip(*pairs))
        self.beyond = {i: self._ids_of_symbol(p) for p, i in number.items() if i >= len(self.digits)}

    def _ids_of_symbol(self, symbol: str) -> list[int]:
        i = self.ids.get(symbol)
        return [i] if i is not None else [self.byte_ids[b] for b in symbol.encode()]

    # -- the agenda -------------------------------------------------------------------------
    def merged(self, unit: str) -> list[str]:
        """One unit's symbols. The agenda is a heap; entries whose symbols have changed
        since are passed over."""
        get, n = self.rank.get, len(unit)
        symbols: list[str | None] = list(unit)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(r, i, unit[i:i + 2]) for i in range(n - 1) if (r := get(unit[i:i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j], after[i] = piece, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := get(symbols[a] + symbols[b])) is not None:
                    heapq.heappush(agenda, (r, a, symbols[a] + symbols[b]))
        return [s for s in symbols if s is not None]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) that two adjacent symbols would make; rank ``NEVER`` if none."""
        key = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.key_rank[at], NEVER), self.key_piece[at]

    def merged_together(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(unit, symbol) of consecutive units of ``sizes`` characters; a character of no number
        is -1 - its code. The units' agendas advance together: in each round every unit merges
        its agenda's best entry, the leftmost of equals."""
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        symbol = self.number[code]
        symbol = np.where(symbol < 0, -1 - code, symbol)
        unit = np.repeat(np.arange(len(sizes)), sizes)
        if not len(unit):
            return unit, symbol
        rank, piece = self._pairs(symbol, np.append(symbol[1:], -1))
        rank[:-1][unit[1:] != unit[:-1]] = NEVER
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            edge = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best, size = np.minimum.reduceat(rank, edge), np.diff(np.append(edge, len(unit)))
            live = np.repeat(best < NEVER, size)
            if not live.all():
                done.append((unit[~live], symbol[~live]))
                unit, symbol, rank, piece = unit[live], symbol[live], rank[live], piece[live]
                size, best = size[best < NEVER], best[best < NEVER]
            if not len(unit):
                break
            head = np.flatnonzero(rank == np.repeat(best, size))
            head = head[np.append(True, unit[head[1:]] != unit[head[:-1]])]
            symbol[head] = piece[head]
            keep = np.ones(len(unit), bool)
            keep[head + 1] = False
            unit, symbol, rank, piece = unit[keep], symbol[keep], rank[keep], piece[keep]
            # the new symbol's pairs with both neighbours of its unit
            head -= np.arange(len(head))
            last = np.append(unit[1:] != unit[:-1], True)
            rank[head[last[head]]] = NEVER
            both = np.concatenate([head, head[head > 0] - 1])
            both = both[~last[both]]
            rank[both], piece[both] = self._pairs(symbol[both], symbol[both + 1])
        unit, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(unit, kind="stable")
        return unit[order], symbol[order]

    # -- ids and texts ----------------------------------------------------------------------
    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(first unit of each text and one more, numbers of the units, the different units)."""
        marked = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), " ", MARK)
        marked = pc.if_else(pc.equal(pc.binary_length(marked), 0), marked,
                            pc.binary_join_element_wise(pa.scalar(self.prefix, pa.large_string()), marked,
                                                        pa.scalar("", pa.large_string())))
        buf, offsets = text_buffers(marked)
        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        if self.cuts_at_marks:
            a, b, c = MARK.encode()
            mark = np.zeros(len(buf) + 3, bool)
            mark[3:-2] = (buf[:-2] == a) & (buf[1:-1] == b) & (buf[2:] == c) if len(buf) > 2 else mark[3:-2]
            edge[:len(buf)] |= mark[3:] & ~mark[:-3]
        if self.cuts_at_line_ends:
            line_end = buf == 10
            edge[:len(buf)] |= line_end
            edge[1:] |= line_end
        edge[len(buf)] = True
        cuts = np.flatnonzero(edge).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1,
                                                 [None, pa.py_buffer(cuts), pa.py_buffer(buf)])
        coded = units.dictionary_encode()
        return np.searchsorted(cuts, offsets), coded.indices.to_numpy(), coded.dictionary.cast(pa.large_string())

    def ids_of_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each unit's begin and one more)."""
        sizes = pc.utf8_length(units).to_numpy()
        short = sizes <= SHORT
        some = units.filter(pa.array(short))
        unit, symbol = self.merged_together(b"".join(some.cast(pa.large_binary()).to_pylist()).decode(), sizes[short])
        owner, ids = [np.flatnonzero(short)[unit]], [symbol]
        other = np.flatnonzero((symbol < 0) | (symbol >= len(self.digits)))
        if len(other):                                # characters that become bytes
            kinds, which = np.unique(symbol[other], return_inverse=True)
            as_bytes = [self.beyond[s] if s >= 0 else self._ids_of_symbol(chr(-1 - s)) for s in kinds.tolist()]
            times = np.ones(len(symbol), np.int64)
            times[other] = np.array([len(x) for x in as_bytes])[which]
            owner, ids = [np.repeat(owner[0], times)], [np.repeat(symbol, times)]
            place = (np.cumsum(times) - times)[other]
            for k in range(4):
                has = np.array([len(x) > k for x in as_bytes])[which]
                ids[0][place[has] + k] = np.array([x[k] if len(x) > k else 0 for x in as_bytes])[which[has]]
        for i in np.flatnonzero(~short).tolist():
            long = self._ids_of_long(units[i].as_py())
            owner.append(np.full(len(long), i))
            ids.append(np.array(long, np.int64))
        owner, ids = np.concatenate(owner), np.concatenate(ids)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.append(0, np.cumsum(np.bincount(owner, minlength=len(units))))

    def _ids_of_long(self, unit: str) -> list[int]:
        """A unit of any length, cut wherever two characters stand together in no piece."""
        joined = self.joined
        out: list[int] = []
        cuts = [i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in joined]
        for a, b in zip([0, *cuts], [*cuts, len(unit)]):
            for s in self.merged(unit[a:b]):
                out += self._ids_of_symbol(s)
        return out

    def encode_all(self, texts: pa.Array) -> list[list[int]]:
        """The ids of each text; null counts as empty."""
        first, number, units = self.units(texts)
        ids, begin = self.ids_of_units(units)
        size = (begin[1:] - begin[:-1])[number]
        end = np.cumsum(size)
        flat = ids[np.arange(int(size.sum())) + np.repeat(begin[number] - end + size, size)].tolist()
        bounds = np.append(0, end)[first].tolist()
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def decode(self, ids) -> str:
        """The pieces' texts, bytes joined into characters (a wrong byte is U+FFFD), without the space in front."""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids])
        if self.prefix and raw[:1] == b" ":
            first = next(i for i in ids if surface[i])
            if first not in self.bytes:
                raw = raw[1:]
        return raw.decode("utf-8", "each_wrong_byte")


def encoded(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded, agrees) of every whole text; ``agrees``: as the library has them."""
    return docs.select("doc_id", "text").mapInArrow(
        _coder(model or default_model(), digest=False),
        "doc_id long, ids array<int>, decoded string, agrees boolean")


def _coder(path: str, digest: bool):
    def run(batches):
        import sentencepiece
        codec, library = Codec(path), sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = ([pa.int64(), pa.string(), pa.string(), pa.bool_()] if digest
                 else [pa.list_(pa.int32()), pa.string(), pa.bool_()])
        names = ["n_tokens", "ids_sha256", "decoded_sha256", "agrees"] if digest else ["ids", "decoded", "agrees"]
        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            columns: list[list] = [[] for _ in names]
            for i, j in slices(offsets, SLICE):
                texts = batch.column("text").slice(i, j - i)
                theirs = library.encode(texts.fill_null("").to_pylist(), num_threads=1)
                back = library.decode(theirs, num_threads=1)
                digits = codec.digits
                for ids, other, other_text in zip(codec.encode_all(texts), theirs, back):
                    decoded = codec.decode(ids)
                    agrees = ids == other and decoded == other_text
                    row = ((len(ids), hashlib.sha256(",".join([digits[x] for x in ids]).encode()).hexdigest(),
                            hashlib.sha256(decoded.encode()).hexdigest(), agrees) if digest
                           else (ids, decoded, agrees))
                    for column, value in zip(columns, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=["doc_id", *names])
    return run


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agrees of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(
        _coder(default_model(), digest=True),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean")
