"""Toxicity: a factorization machine over hashed terms.

    z = bias + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

over the distinct terms of a document: its words and the first bytes of its
words (4 to 9), all hashed (words into the lower half of the buckets).  Linear weights alone cannot say that two terms
are harmless apart and toxic together; the learned factor vectors v can.  The
double sum is computed as (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2) / 2, linear
in the number of terms.  x_i is 1 for each distinct term the document holds,
however often and however long the document, so one insult in a long text
weighs as much as in a short one.  Terms get a weight and factors if they say something, so
that the thousands of harmless words of a long text add no noise: those that
lean towards a class by more than chance by themselves (a first fit under an L1
threshold), and words of which a pair does where neither word alone explains it
(what the fit of the first ones leaves unexplained, summed over the documents
that hold both words, for all pairs in blocks; `pair_rows` of the training rows
are looked at).  So a balanced interaction is
learned though neither term has a lean of its own.  Terms in fewer than `least`
training documents or more than the share `most` count nothing.

Learned by numpy stochastic gradient descent (per-coordinate steps, log loss) on a
bounded sample of labelled rows (`Params.max_train`, smallest hash of the id);
the executors turn those rows into term lists, only these reach the driver.
Scoring covers every row and whole texts with a model of fixed size.

Defined results: NULL and empty texts score by the bias alone; without usable
labels of both classes every score is 0.5; rows with a NULL id are scored and
never trained on; repeated rows are scored one by one.  Columns other than id,
text and label are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import id_text, lean, text_slices


@dataclass(frozen=True)
class Params:
    bits: int = 18             # hash buckets: 2**bits
    factors: int = 8
    prefixes: tuple = (4, 5, 6, 7, 8, 9)  # bytes
    max_train: int = 8000      # labelled rows used for training, at most
    epochs: int = 5
    rate: float = 0.15
    l1: float = 2.0            # weights that lean less than this a pass stay zero
    noise: float = 4.0         # ... or less than this many standard deviations of chance
    pair_noise: float = 7.0    # standard deviations of chance a pair of words must lean by
    pair_rows: int = 3000      # training rows in which pairs are looked for, at most
    block: int = 1024          # words of a block of pairs
    decay: float = 1e-3        # L2 on weights and factors
    least: int = 3             # training documents a term must be in
    most: float = 0.5          # share of training documents a term may be in
    seed: int = 11


def terms(data: np.ndarray, offsets: np.ndarray, p: Params):
    """Distinct hashed terms of each text of a slice (lower-cased A-Z)."""
    data = tv.LOWER[data]
    starts, ends, first = tv.word_spans(data, offsets, tv.ALNUM)
    hashed = tv.ByteHash(data)
    shift, half = np.uint64(65 - p.bits), 1 << (p.bits - 1)
    kinds = [(hashed.of(starts, ends) >> shift).astype(np.int32)]
    for k in p.prefixes:
        cut = np.minimum(starts + k, ends)
        kinds.append((tv.mix(hashed.of(starts, cut) + np.uint64(k)) >> shift).astype(np.int32) + np.int32(half))
    stacked = np.stack(kinds)
    for i in range(len(offsets) - 1):
        yield np.unique(stacked[:, first[i]:first[i + 1]])


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # w_i of every bucket
    factors: np.ndarray  # v_i of every bucket
    used: np.ndarray     # buckets that have a weight and factors

    def logit(self, t: np.ndarray) -> float:
        t = t[self.used[t]]
        v = self.factors[t]
        s = v.sum(0)
        return self.bias + float(self.weights[t].sum()) + 0.5 * float(s @ s - (v * v).sum())


def _leaning_terms(docs, held: np.ndarray, share: float, epochs: int, p: Params) -> np.ndarray:
    """Flags of the terms whose summed gradients outweigh chance: a linear
    logistic fit under an L1 threshold (follow the regularized leader)."""
    lean, square = np.zeros(len(held)), np.zeros(len(held))
    # What a term unrelated to the label would lean by chance in one pass.
    chance = np.maximum(p.l1, p.noise * np.sqrt(held * share * (1 - share)))
    rng, bias, gb, passes = np.random.default_rng(p.seed), float(np.log(share / (1 - share))), 1.0, 1.0

    def weight(t):
        z, least = lean[t], chance[t] * passes
        return np.where(np.abs(z) <= least, 0.0, -(z - np.sign(z) * least) * p.rate / (1 + np.sqrt(square[t])))

    for turn in range(epochs):
        for k, i in enumerate(rng.permutation(len(docs))):
            passes = max(1.0, turn + k / len(docs))
            t, y = docs[i]
            w = weight(t)
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -30, 30))) - y
            more = square[t] + g * g
            lean[t] += g - (np.sqrt(more) - np.sqrt(square[t])) / p.rate * w
            square[t] = more
            gb += g * g
            bias -= p.rate * g / np.sqrt(gb)
    passes = epochs
    return weight(np.arange(len(held))) != 0


def _interacting_words(docs, model: Model, p: Params) -> np.ndarray:
    """Flags of the words of which a pair leans by more than chance in what `model` leaves unexplained.

    z of a pair is the sum of the residuals of the documents that hold both words over the root of the sum of
    their squares; it must pass the z of either word alone by `pair_noise`.  By the Cauchy-Schwarz inequality
    z^2 is at most the number of these documents, so rarer words than pair_noise^2 need no look."""
    found, held = np.zeros(1 << p.bits, bool), np.zeros(1 << p.bits, np.int32)
    docs = [docs[i] for i in np.random.default_rng(p.seed).permutation(len(docs))[:p.pair_rows]]
    for t, _ in docs:
        held[t] += 1
    held[1 << (p.bits - 1):] = 0  # beginnings of words
    seen = np.flatnonzero(held >= max(p.least, p.pair_noise ** 2))
    if not len(seen):
        return found
    place = np.full(len(held), -1, np.int64)
    place[seen] = np.arange(len(seen))
    left = np.array([y - 1 / (1 + np.exp(-np.clip(model.logit(t), -30, 30))) for t, y in docs], np.float32)
    at = [place[t] for t, _ in docs]
    column = np.concatenate([a[a >= 0] for a in at])
    row = np.repeat(np.arange(len(docs)), [(a >= 0).sum() for a in at])
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    own = np.abs(np.bincount(column, left[row], len(seen)))
    own /= np.sqrt(np.maximum(np.bincount(column, left[row] ** 2, len(seen)), 1e-12))

    def block(i):
        a, b = np.searchsorted(column, [i, i + p.block])
        out = np.zeros((len(docs), min(p.block, len(seen) - i)), np.float32)
        out[row[a:b], column[a:b] - i] = 1
        return out

    for i in range(0, len(seen), p.block):
        left_i = block(i).T
        first, second = left_i * left, left_i * left ** 2
        for j in range(i, len(seen), p.block):
            other = block(j)
            z = np.abs(first @ other) / np.sqrt(np.maximum(second @ other, 1e-12))
            a, b = own[i:i + p.block, None], own[None, j:j + p.block]
            good = z > p.pair_noise + np.maximum(a, b)
            found[seen[i:i + p.block][good.any(1)]] = True
            found[seen[j:j + p.block][good.any(0)]] = True
    return found


def _fit(rows, used: np.ndarray, share: float, p: Params) -> Model:
    """Weights and factors of the used terms by stochastic gradient descent."""
    size = len(used)
    rng = np.random.default_rng(p.seed)
    docs = [(t[used[t]], y) for t, y in rows]
    w, gw = np.zeros(size), np.full(size, 1e-1)
    v, gv = rng.normal(0, 0.05, (size, p.factors)), np.full((size, p.factors), 1e-1)
    bias, gb = float(np.log(share / (1 - share))), 1.0
    for _ in range(max(2 * p.epochs, -(-24000 // len(docs)))):
        for i in rng.permutation(len(docs)):
            t, y = docs[i]
            own = v[t]
            s = own.sum(0)
            z = bias + w[t].sum() + 0.5 * (s @ s - (own * own).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            if abs(g) < 1e-3:
                continue
            d = g + p.decay * w[t]
            gw[t] += d * d
            w[t] -= p.rate * d / np.sqrt(gw[t])
            d = g * (s - own) + p.decay * own
            gv[t] += d * d
            v[t] = own - 0.1 * p.rate * d / np.sqrt(gv[t])
            gb += g * g
            bias -= p.rate * g / np.sqrt(gb)
    w[~used] = 0
    v[~used] = 0
    return Model(bias, w.astype(np.float32), v.astype(np.float32), used)


def train(rows: list[tuple[np.ndarray, int]], p: Params) -> Model:
    size = 1 << p.bits
    if len({y for _, y in rows}) < 2:
        return Model(0.0, np.zeros(size, np.float32), np.zeros((size, p.factors), np.float32), np.zeros(size, bool))
    held = np.zeros(size, np.int32)
    for t, _ in rows:
        held[t] += 1
    bounded = (held >= p.least) & (held <= p.most * len(rows))
    share = sum(y for _, y in rows) / len(rows)
    docs = [(t[bounded[t]], y) for t, y in rows]
    used = bounded & _leaning_terms(docs, held, share, p.epochs, p)
    model = _fit(docs, used, share, p)
    more = _interacting_words(docs, model, p) & ~used
    return _fit(docs, used | more, share, p) if more.any() else model


def score_slice(data: np.ndarray, offsets: np.ndarray, model: Model, p: Params) -> np.ndarray:
    z = np.array([model.logit(t) for t in terms(data, offsets, p)])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, p: Params,
                  id_col: str, text_col: str, label_col: str) -> list[tuple[np.ndarray, int]]:
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_train))
    # At most `max_train` rows of two integers: safe to send to every executor.
    sample = id_text(docs, id_col, text_col).join(F.broadcast(marks), "doc_id")

    def collect_terms(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            for a, b, data, offs in text_slices(batch.column("text")):
                got = [t.tobytes() for t in terms(data, offs, p)]
                yield pa.RecordBatch.from_arrays([pa.array(label[a:b], pa.int32()), pa.array(got, pa.binary())],
                                                 names=["label", "terms"])

    found = sample.select("label", "text").mapInArrow(lean(collect_terms), "label int, terms binary").toLocalIterator()
    rows = [(np.frombuffer(r["terms"], np.int32), r["label"]) for r in found]
    rows.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[1]))  # the order of arrival must not matter
    return rows


def score_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, params: Params = Params(),
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, score) for every row of `docs`; `usable` says which labels may be learned from."""
    usable = F.lit(True) if usable is None else usable
    model = train(training_rows(docs, labels, usable, params, id_col, text_col, label_col), params)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for a, b, data, offs in text_slices(batch.column("text")):
                scores[a:b] = score_slice(data, offs, model, params)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], schema=_SCORED)

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, score double")
