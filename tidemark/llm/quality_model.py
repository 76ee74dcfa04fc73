"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

A text is cut into words and runs of symbols. Its features are the hashes of
single tokens and of neighbouring pairs (a pair of equal tokens is one common
feature, so repetition shows whatever the word), with weights sqrt(count)
scaled to length 1. Follow-the-regularised-leader updates with per-coordinate
rates and L1 give a sparse weight table of 2**BITS entries, which is broadcast;
a score is the sigmoid of a sparse dot product over the whole text.

Null and empty texts have no features and score the bias. Documents without a
label are scored like others; null labels are not learned from. Without labels
of both classes every score is that of the bias alone. Ties and repeated rows
score alike. Only the text is an input of a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import in_held_out, labelled_sample, table, with_text_score
from .text import Hasher, byte_classes, mix, owners, tokens

BITS = 20
PER_CLASS = 2500               # bound on the documents of each class that are learned from
UPDATES = 12_000               # at least this many, in whole passes over the sample
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
THRESHOLD = 0.3
SAME_NEXT, SAME_SKIP = 1, 2    # feature 0 is the bias


def sparse_features(buf, off, hasher, classes, bits: int = BITS):
    """(document, feature, value), sorted by document; values have length 1 per document."""
    start, end, _, first = tokens(buf, off, classes)
    h = hasher.spans(hasher.prefix(buf), start, end)
    doc = owners(first)
    mask = np.uint64((1 << bits) - 1)
    pair = doc[1:] == doc[:-1]
    two = mix(h[:-1] * np.uint64(0x100000001B3) + h[1:]) & mask
    two[h[:-1] == h[1:]] = SAME_NEXT
    skip = (doc[2:] == doc[:-2]) & (h[2:] == h[:-2])
    d = np.concatenate([doc, doc[1:][pair], doc[2:][skip]]).astype(np.uint64)
    f = np.concatenate([h & mask, two[pair], np.full(skip.sum(), SAME_SKIP, np.uint64)])
    key, times = np.unique((d << np.uint64(bits)) | f, return_counts=True)
    doc, feature = (key >> np.uint64(bits)).astype(np.int64), (key & mask).astype(np.int64)
    length = np.sqrt(np.bincount(doc, times, minlength=len(off) - 1))
    return doc, feature, np.sqrt(times) / length[doc]


def ftrl(examples: list, labels: np.ndarray, bits: int = BITS, updates: int = UPDATES, seed: int = 3) -> np.ndarray:
    """Weights from (features, values) examples, one update for each in random order;
    both classes weigh the same."""
    share = len(labels) / (2 * np.maximum(1, np.bincount(labels.astype(int), minlength=2)))
    z, n, w = np.zeros(1 << bits), np.zeros(1 << bits), np.zeros(1 << bits)
    rng = np.random.default_rng(seed)
    for _ in range(-(-updates // len(examples))):
        for k in rng.permutation(len(examples)):
            f, x = examples[k]
            p = 1 / (1 + np.exp(-np.clip(w[f] @ x, -30, 30)))
            g = share[int(labels[k])] * (p - labels[k]) * x
            more = n[f] + g * g
            z[f] += g - (np.sqrt(more) - np.sqrt(n[f])) / ALPHA * w[f]
            n[f] = more
            zf = z[f]
            w[f] = np.where(np.abs(zf) <= L1, 0.0,
                            -(zf - np.sign(zf) * L1) / ((BETA + np.sqrt(more)) / ALPHA + L2))
    return w


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS) -> np.ndarray:
    """Weights learned from a sample of at most ``per_class`` documents of each class
    that are not held out."""
    rows = labelled_sample(docs, labels, target, per_class).orderBy("doc_id").collect()
    hasher, classes = Hasher(), byte_classes(symbols=True)
    examples = []
    for r in rows:
        body = np.frombuffer(r.text.encode(), np.uint8)
        _, f, x = sparse_features(body, np.array([0, len(body)]), hasher, classes)
        examples.append((np.append(f, 0), np.append(x, 1.0)))
    y = np.array([r.label for r in rows], float)
    if len(set(y)) < 2:
        return np.zeros(1 << BITS)
    return ftrl(examples, y)


def score_documents(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))   # 4 MB

    def make_scorer():
        hasher, classes, w = Hasher(), byte_classes(symbols=True), shared.value

        def score(buf, off):
            doc, f, x = sparse_features(buf, off, hasher, classes)
            total = np.bincount(doc, w[f] * x, minlength=len(off) - 1) + w[0]
            return 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return score
    return with_text_score(docs, make_scorer, name)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, table(spark, sf_dir, "labels"))
    out = score_documents(docs, weights)
    return out.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
