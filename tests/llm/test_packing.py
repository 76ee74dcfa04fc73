import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import packing

from rows import SMALL, awkward_docs, awkward_texts


def pieces_of(rows):
    """Pieces by the tokenizers library."""
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        head, at, k = len(ids) % 1024 or 1024, 0, 0
        while at < len(ids):
            part = ids[at:at + (head if at == 0 else 1024)]
            out.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
            at, k = at + len(part), k + 1
    return out


def check(rows, texts):
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == \
        sorted(pieces_of(texts), key=str)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    return len(held)


def test_small_table_with_the_ids_of_the_tokenizers_library(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = packing.op6_packing(spark, SMALL).collect()
    n = check(rows, texts)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 1024)


def test_awkward_rows(spark):
    special = [(20, "<|endoftext|> as text"), (21, "x" * 5000)]
    docs = awkward_docs(spark, awkward_texts() + special)
    check(packing.pack(docs).collect(), awkward_texts() + special)
    assert packing.pack(docs.limit(0)).count() == 0


def test_query_has_the_ids_of_the_file_for_added_tokens(spark, workdir):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|><|endoftext|>\n\n x", "<|endoftext", "a\n  <|endoftext|>  b"]
    awkward_docs(spark, list(enumerate(texts))).write.parquet(f"{workdir}/documents.parquet")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.op6_packing(spark, workdir).collect()}
    for k, text in enumerate(texts):
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text


def test_plan_uses_every_piece_once_and_few_sequences():
    rng = random.Random(4)
    for kind in range(4):
        hist = defaultdict(int)
        for _ in range(20000):
            hist[[rng.randint(1, 1024), rng.choice([300, 400, 700]), min(1024, int(rng.expovariate(0.01)) + 1),
                  1024][kind]] += 1
        plan = packing.plan(hist)
        used = defaultdict(int)
        for lengths, n in plan:
            assert sum(lengths) <= 1024 and n > 0
            for x in lengths:
                used[x] += n
        assert used == hist
        low = -(-sum(k * v for k, v in hist.items()) // 1024)
        if kind in (0, 2):
            assert sum(n for _, n in plan) <= 1.01 * low + 1


def test_nnls_fits_a_mixture_of_patterns():
    pattern = packing.patterns(np.array([100, 300, 324, 400, 624, 724]), 1024)
    true = np.arange(1, len(pattern) + 1) * 10.0
    counts = sum(np.bincount(pattern[:, k], true, minlength=1025) for k in range(3))
    counts[0] = 0
    x = packing.nnls(pattern, counts, 4000)
    fit = sum(np.bincount(pattern[:, k], x, minlength=1025) for k in range(3))
    fit[0] = 0
    assert np.abs(fit - counts).max() < 0.01 * counts.max()


@pytest.mark.parametrize("text", [" " * 2_000_000, "\t" * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 500_000 + "b",
                                  "q" * 1_000_000, "x <|endoftext|>" + " " * 1_500_000 + "<|endoftext|> y"])
def test_long_runs_equal_the_tokenizers_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for added in (True, False):
        library.encode_special_tokens = not added
        ids = packing.Encoder(packing.default_vocabulary(), added)(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_white_space_is_packed_whole(spark):
    rows = [(1, "a" + " " * 1_200_000 + "b"), (2, "short"), (3, None)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), added=True).collect()
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for doc, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids) + 1
        assert sum(p.length for p in pieces if p.doc_id == doc) == n
