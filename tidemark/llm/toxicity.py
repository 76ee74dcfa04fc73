"""Toxicity: a convolutional text classifier, trained in numpy.

Words (lower-cased) are embedded by hashes, as the sum of three table rows: two
of the word, so that a word which shares a row with another is still told apart,
and one of its first four bytes, so that unseen forms of a stem are known.
Filters of widths 1, 2 and 3 slide over the words; the largest
activation of each filter over the whole text goes through a rectifier into a
logistic output whose weights stay positive: what a text holds can raise its
score, what it lacks can't. Training is plain gradient descent with Adagrad rates; the
embeddings start from the log-odds of the hashed rows.

Every labelled document that is not held out is used: four fifths (by a hash of
doc_id) are learned from, the others calibrate. The documents are dealt to tasks of
about ``PART_BYTES`` of text. The log-odds come from one count over all of them. In each
pass every task goes through its documents from the common net, and each parameter
becomes the mean over the tasks that moved it; the driver holds the net alone. All
calibration documents shift the output so that 0.5 is the best threshold, and those of
a language give its threshold, for the column ``flagged``; outputs are counted in steps
of 1 / ``STEPS``, so that a count has bounded size.

Null and empty texts have no activation and score the bias. Documents of
unseen or null language take the common threshold. Null labels are not learned
from; without labels of both classes every score is 0. The language is an input of
``flagged`` alone, never of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gold import bounded_broadcast
from .frames import dropped, in_held_out, table, with_text_score, written
from .text import Hasher, byte_classes, owners, small_batches, text_buffers, tidy, tokens

BITS = 17                      # rows in each third of the embedding table
STEM = 4                       # bytes
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
PASSES, UPDATES = (2, 6), 40_000   # passes: enough for this many documents, within the bounds
BATCH, RATE = 32, 0.1
PART_BYTES = 48 << 20          # text that one task learns from in a pass
CALIBRATION = 5                # every fifth document
STEPS, FARTHEST = 1024, 30     # calibration outputs: steps of one, and the largest that are told apart
CAUTION = 1e-3                 # squared slope that every rate starts with: rare words move little
MIN_IN_LANGUAGE = 50           # fewer calibration documents: common threshold


def word_rows(buf, off, hasher, classes):
    """Three table rows for each word, and the first word of each document."""
    start, end, kind, first = tokens(buf, off, classes)
    word = kind == 2
    first = np.concatenate([[0], np.cumsum(word)])[first]
    start, end, mask = start[word], end[word], np.uint64((1 << BITS) - 1)
    prefix = hasher.prefix(buf)
    h = hasher.spans(prefix, start, end)
    stem = hasher.spans(prefix, start, np.minimum(end, start + STEM))
    part = np.array([[0], [1], [2]], np.int64) << BITS
    return np.stack([h & mask, (h >> np.uint64(32)) & mask, stem & mask]).astype(np.int64) + part, first


class Net:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.01, ((3 << BITS), DIM)).astype(np.float32)
        self.w = [rng.normal(0, 0.3, (v, DIM, FILTERS)).astype(np.float32) for v in WIDTHS]
        self.u = np.abs(rng.normal(0, 0.3, FILTERS * len(WIDTHS))).astype(np.float32)
        self.c = 0.0

    def start_from_log_odds(self, pos, neg, n_pos: int, n_neg: int) -> None:
        """Embedding 0 of each row: how much likelier it occurs in toxic documents,
        shrunk where few documents tell. ``pos``, ``neg``: documents of each row."""
        least = 1 / max(1, min(n_pos, n_neg))
        odds = np.log((pos / max(1, n_pos) + least) / (neg / max(1, n_neg) + least)) * (pos + neg) / (pos + neg + 5)
        self.e[:, 0] += 0.5 * odds

    def state(self, rates: dict) -> np.ndarray:
        """All parameters in rows of ``DIM``, beside each row the totals its rates come from."""
        def total(name, param):
            return rates.get(name, np.full(param.shape, CAUTION, np.float32))
        pairs = [(self.e, total("e", self.e))]
        pairs += [(part, total(f"w{k}{o}", part)) for k, w in enumerate(self.w) for o, part in enumerate(w)]
        pairs.append((self.u, total("u", self.u)))
        pairs.append((np.full(DIM, self.c, np.float32), np.full(DIM, rates.get("steps", 0), np.float32)))
        return np.concatenate([np.hstack([p.reshape(-1, DIM), t.reshape(-1, DIM)]) for p, t in pairs])

    @classmethod
    def of_state(cls, state: np.ndarray) -> tuple[Net, dict]:
        """A net and its rates, copied from :meth:`state`."""
        net, rates, at = cls.__new__(cls), {}, 0

        def take(rows, shape):
            nonlocal at
            own = state[at:at + rows].astype(np.float32)
            at += rows
            return own[:, :DIM].reshape(shape).copy(), own[:, DIM:].reshape(shape).copy()
        net.e, rates["e"] = take(3 << BITS, (3 << BITS, DIM))
        net.w = []
        for k, v in enumerate(WIDTHS):
            parts = [take(DIM, (DIM, FILTERS)) for _ in range(v)]
            net.w.append(np.stack([p for p, _ in parts]))
            rates |= {f"w{k}{o}": t for o, (_, t) in enumerate(parts)}
        net.u, rates["u"] = take(FILTERS * len(WIDTHS) // DIM, -1)
        c, steps = take(1, -1)
        net.c, rates["steps"] = float(c[0]), float(steps[0])
        return net, rates

    def activations(self, rows) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings with zeros after the end, and all filters at each word."""
        e = np.concatenate([self.e[rows[0]] + self.e[rows[1]] + self.e[rows[2]],
                            np.zeros((max(WIDTHS), DIM), np.float32)])
        n = rows.shape[1]
        return e, np.concatenate([sum(e[o:o + n] @ w[o] for o in range(len(w))) for w in self.w], axis=1)

    def pooled(self, rows, first) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest activation of each filter per document, where it lies, and the embeddings.

        Words past the end of a document count as zeros."""
        e, z = self.activations(rows)
        n_docs = len(first) - 1
        out = np.zeros((n_docs, z.shape[1]), np.float32)
        left = np.diff(first)
        for k, v in enumerate(WIDTHS[1:], 1):
            for back in range(1, v):                       # windows over the end of a document
                at = first[1:][left >= back] - back
                z[at, k * FILTERS:(k + 1) * FILTERS] = sum(e[at + o] @ self.w[k][o] for o in range(back))
        full = np.flatnonzero(left > 0)
        if len(full):
            out[full] = np.maximum.reduceat(z, first[full], axis=0)
        return np.maximum(out, 0), z, e

    def outputs(self, rows, first) -> np.ndarray:
        p, _, _ = self.pooled(rows, first)
        return p @ self.u + self.c

    def step(self, rows, first, y, rates: dict) -> None:
        """One gradient step on a batch of documents."""
        p, z, e = self.pooled(rows, first)
        miss = (1 / (1 + np.exp(-np.clip(p @ self.u + self.c, -30, 30))) - y) / len(y)
        grad_u, grad_p = p.T @ miss, miss[:, None] * self.u * (p > 0)
        place = np.zeros(p.shape, np.int64)
        for d in range(len(y)):
            if first[d] < first[d + 1]:
                place[d] = first[d] + z[first[d]:first[d + 1]].argmax(axis=0)
        end = first[1:, None]

        def move(name, param, grad, at=slice(None)):
            total = rates.setdefault(name, np.full(param.shape, CAUTION, np.float32))
            total[at] += grad * grad
            param[at] -= RATE * grad / (np.sqrt(total[at]))
        touched, slopes = [], []
        for k, v in enumerate(WIDTHS):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            for o in range(v):
                at = place[:, cols] + o
                g = grad_p[:, cols] * (at < end)
                at = np.minimum(at, max(0, rows.shape[1] - 1))
                if rows.shape[1]:
                    touched.append(at.ravel())
                    slopes.append((g[..., None] * self.w[k][o].T[None]).reshape(-1, DIM))
                    move(f"w{k}{o}", self.w[k][o], np.einsum("bf,bfd->df", g, e[at]))
        if touched:
            at, slope = np.concatenate(touched), np.concatenate(slopes)
            for part in rows[:, at]:
                own, back = np.unique(part, return_inverse=True)
                grad = np.zeros((len(own), DIM), np.float32)
                np.add.at(grad, back, slope)
                move("e", self.e, grad, own)
        move("u", self.u, grad_u)
        np.maximum(self.u, 0, out=self.u)
        self.c -= RATE * float(miss.sum())
        rates["steps"] = rates.get("steps", 0) + 1


def best_threshold(values: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """The middle of the widest gap among the thresholds with the fewest weighted
    errors; both classes weigh the same. ``pos``, ``neg``: documents with each output."""
    order = np.argsort(values, kind="stable")
    o, pos, neg = values[order], pos[order] / max(1, pos.sum()), neg[order] / max(1, neg.sum())
    errors = np.concatenate([[0], np.cumsum(pos)]) + np.concatenate([np.cumsum(neg[::-1])[::-1], [0]])
    bounds = np.concatenate([[o[0] - 2], o, [o[-1] + 2]])
    gap = np.diff(bounds)
    gap[errors > errors.min() + 1e-9] = -1
    k = int(gap.argmax())
    return float((bounds[k] + bounds[k + 1]) / 2)


def training_rows(docs: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, text, label, lang) of every labelled document that is not held out."""
    known = (labels.select("doc_id", F.col(target).cast("int").alias("label")).dropna()
             .filter(F.col("label").isin(0, 1) & ~in_held_out(F.col("doc_id"))).dropDuplicates())
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.cast("string").alias("lang"))
    return texts.join(bounded_broadcast(known), "doc_id").select("doc_id", "text", "label", "lang")


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` written in parts of about ``PART_BYTES`` of text, in an order that the label has
    no part in; ``calibrates`` marks the documents that are not learned from."""
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    own = rows.withColumn("_deal", F.xxhash64("doc_id"))
    own = own.withColumn("calibrates", F.pmod(F.xxhash64("_deal"), F.lit(CALIBRATION)) == 0)
    return written(own.repartition(int(size // PART_BYTES) + 1, "_deal")
                   .sortWithinPartitions("_deal", "doc_id", "text", "label"), "toxicity-rows")


def _slices_of(batches):
    """(rows of the words, first word of each document, labels) of slices of the batches."""
    hasher, classes = Hasher(), byte_classes(symbols=True)
    for batch in small_batches(batches):
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float32)
        yield *word_rows(*text_buffers(batch.column("text"), lower=True), hasher, classes), label


def row_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of label 1 and of label 0 that each table row occurs in, over all ``rows``."""
    @tidy
    def run(batches):
        counts = np.zeros((2, 3 << BITS), np.int64)
        for own, first, label in _slices_of(batches):
            doc, n = owners(first), len(label)
            for part in own:
                key = np.unique(part * n + doc)
                for k in (0, 1):
                    counts[k] += np.bincount(key[label[key % n] == k] // n, minlength=3 << BITS)
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, counts[1][at], counts[0][at])],
                                         names=["slot", "pos", "neg"])
    found = (rows.select("text", "label").mapInArrow(run, "slot long, pos long, neg long")
             .groupBy("slot").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow())
    out = np.zeros((2, 3 << BITS))
    for k, name in enumerate(("pos", "neg")):
        out[k][found["slot"].to_numpy()] = found[name].to_numpy()
    return out[0], out[1]


def learn(rows: DataFrame, net: Net, rates: dict, seed: int) -> tuple[Net, dict]:
    """One pass over all ``rows``: each task goes on from ``net`` with its own documents, and
    each row of parameters becomes the mean over the tasks that moved it."""
    state = net.state(rates)
    shared, names = rows.sparkSession.sparkContext.broadcast(state), [f"v{k}" for k in range(2 * DIM)]   # 25 MB

    @tidy
    def run(batches):
        own_net, own_rates = Net.of_state(shared.value)
        rng = np.random.default_rng(seed)
        for own, first, label in _slices_of(batches):
            order = rng.permutation(len(label))
            for b in range(0, len(order), BATCH):
                pick = order[b:b + BATCH]
                words = np.concatenate([np.arange(first[d], first[d + 1]) for d in pick])
                starts = np.concatenate([[0], np.cumsum(first[pick + 1] - first[pick])])
                own_net.step(own[:, words], starts, label[pick], own_rates)
        after = own_net.state(own_rates)
        at = np.flatnonzero((after != shared.value).any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(v) for v in after[at].T.copy()]],
                                         names=["slot", *names])
    moved = (rows.select("text", "label").mapInArrow(run, "slot long, " + ", ".join(f"{n} float" for n in names))
             .groupBy("slot").agg(*[F.avg(n).cast("float").alias(n) for n in names]).toArrow())
    shared.destroy()
    state[moved["slot"].to_numpy()] = np.stack([moved[n].to_numpy() for n in names], axis=1)
    return Net.of_state(state)


def calibration(rows: DataFrame, net: Net) -> tuple[float, dict[str, float]]:
    """The common threshold of the outputs, and each language's for the shifted scores, from
    the counts of all ``rows`` by language and output."""
    out = F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), F.col("output")))
    counts = written(_with_outputs(rows.select("text", "label", "lang"), net, "output")
                     .groupBy("lang", F.round(out * STEPS).cast("long").alias("step"))
                     .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")),
                     "toxicity-outputs")
    both = counts.groupBy("step").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow()

    def best(found) -> float:
        return best_threshold(*(found[c].to_numpy().astype(float) for c in ("step", "pos", "neg"))) / STEPS
    common = best(both) if min(sum(both["pos"].to_pylist()), sum(both["neg"].to_pylist())) else 0.0

    def of_language(found: pa.Table) -> pa.Table:
        return pa.table({"lang": found["lang"][:1], "threshold": pa.array([best(found)])})
    ample = (counts.groupBy("lang").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
             .filter((F.col("lang") != "") & (F.least("p", "n") > 0) & (F.col("p") + F.col("n") >= MIN_IN_LANGUAGE)))
    chosen = (counts.join(ample, "lang").select("lang", "step", "pos", "neg")
              .groupBy("lang").applyInArrow(of_language, "lang string, threshold double").collect())
    dropped(counts)
    return common, {r.lang: float(1 / (1 + np.exp(common - r.threshold))) for r in chosen}


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", seed: int = 11
        ) -> tuple[Net | None, dict[str, float]]:
    """The net and the languages' thresholds, from all labelled documents that are not held
    out; every fifth of these (by a hash of doc_id) calibrates."""
    rows = dealt(training_rows(docs, labels, target))
    learned = rows.filter(~F.col("calibrates"))
    n = {r.label: r.n for r in learned.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not (n.get(0) and n.get(1)):
        dropped(rows)
        return None, {}
    net, rates = Net(), {}
    net.start_from_log_odds(*row_counts(learned), n[1], n[0])
    for k in range(min(PASSES[1], max(PASSES[0], -(-UPDATES // sum(n.values()))))):
        net, rates = learn(learned, net, rates, seed + k)
    common, by_language = calibration(rows.filter("calibrates"), net)
    dropped(rows)
    net.c -= common
    return net, by_language


def _with_outputs(docs: DataFrame, net: Net, name: str, finish=lambda out: out) -> DataFrame:
    """``docs`` with the net's output for every whole text, put through ``finish``."""
    shared = docs.sparkSession.sparkContext.broadcast((net.e, net.w, net.u, net.c))   # 12 MB

    def make_scorer():
        hasher, classes, own = Hasher(), byte_classes(symbols=True), Net.__new__(Net)
        own.e, own.w, own.u, own.c = shared.value

        def score(buf, off):
            return finish(own.outputs(*word_rows(buf, off, hasher, classes)).astype(float))
        return score
    return with_text_score(docs, make_scorer, name, lower=True)


def score_documents(docs: DataFrame, net: Net | None, name: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    if net is None:
        return docs.withColumn(name, F.lit(0.0))
    return _with_outputs(docs, net, name, lambda out: 1 / (1 + np.exp(-np.clip(out, -30, 30))))


def language_threshold(lang: Column, thresholds: dict[str, float]) -> Column:
    out = F.lit(0.5)
    for name, t in sorted(thresholds.items()):
        out = F.when(lang == name, t).otherwise(out)
    return out


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    net, thresholds = fit(docs, table(spark, sf_dir, "labels"))
    out = score_documents(docs, net)
    return out.select("doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      (F.col("score") >= language_threshold(F.col("lang"), thresholds)).alias("flagged"))
