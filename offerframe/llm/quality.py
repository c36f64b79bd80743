"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed features -- words,
neighbouring word pairs and character n-grams -- and a softmax layer on that
average gives the class.  Both layers are learned together by stochastic
gradient descent in numpy, on labelled rows only.

Training uses a bounded sample of the labelled rows (`Params.max_train`, the
rows with the smallest hash of their id, so the sample is the same at every
run); its features are counted by the executors and only (feature, count)
lists reach the driver.  Scoring covers every row and whole texts: the softmax
layer is linear in the average, so each feature's vector is folded once into
one number per bucket and a document's score is the mean of those numbers.
That folded table has a fixed size (2**bits doubles) whatever the corpus.

Defined results: NULL and empty texts have no features and score by the bias
alone; a frame without usable labels gives the prior score 0.5 to every row;
repeated rows are scored one by one; NULL ids are scored and never trained on.
Columns other than id, text and label are not read.
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
    bits: int = 18            # hash buckets: 2**bits, half for words, half for characters
    dim: int = 12             # length of a feature's vector
    ngrams: tuple = (3, 4)    # characters
    max_train: int = 4000     # labelled rows used for training, at most
    epochs: int = 6
    rate: float = 4.0         # first learning rate, falling linearly to 0
    seed: int = 7


def features(data: np.ndarray, offsets: np.ndarray, p: Params):
    """Hashed features of each text of a slice: yields (buckets, first) per kind."""
    half = 1 << (p.bits - 1)
    shift = np.uint64(64 - (p.bits - 1))
    starts, ends, first = tv.word_spans(data, offsets)
    words = tv.ByteHash(data).of(starts, ends)
    yield (words >> shift).astype(np.int32), first
    # A pair is hashed by the difference of its words: any word next to itself
    # gives the same bucket, so plain repetition is one strong feature.
    pair = np.zeros(len(words), np.uint64)
    pair[1:] = words[1:] - words[:-1]
    alone = first[:-1][first[:-1] < first[1:]]
    pair[alone] = words[alone] ^ np.uint64(0x5555555555555555)
    yield (tv.mix(pair + np.uint64(77)) >> shift).astype(np.int32), first
    code, begin = tv.characters(data, offsets)
    space = np.isin(code, np.frombuffer(tv.SPACES, np.uint8).astype(np.uint32))
    down = np.uint32(32 - (p.bits - 1))
    for n in p.ngrams:
        size = len(code) - n + 1
        if size <= 0:
            yield np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
            continue
        h = np.zeros(size, np.uint32)
        for k in range(n):
            h += code[k:size + k] * np.uint32((0x9E3779B1 ** (k + 1) | 1) & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0x297A2D39)
        keep = np.ones(size, bool)
        for k in range(1, n - 1):  # an n-gram may touch a space at its ends only
            keep &= ~space[k:size + k]
        for k in range(1, n):      # and stays inside its text
            at = begin[1:-1] - k
            keep[at[(at >= 0) & (at < size)]] = False
        left = np.concatenate([[0], np.cumsum(keep)])
        yield (h[keep] >> down).astype(np.int32) + half, left[np.minimum(begin, size)]


def counted(data: np.ndarray, offsets: np.ndarray, p: Params):
    """(buckets, counts) of each text of a slice."""
    kinds = list(features(data, offsets, p))
    for i in range(len(offsets) - 1):
        yield np.unique(np.concatenate([b[f[i]:f[i + 1]] for b, f in kinds]), return_counts=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], p: Params) -> tuple[np.ndarray, float]:
    """Fit on (buckets, counts, label); return the folded table and bias of the logit of class 1."""
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1.0 / p.dim, 1.0 / p.dim, (1 << p.bits, p.dim))
    weights, bias = np.zeros((2, p.dim)), np.zeros(2)
    docs = [(b, (c / max(1, c.sum())).astype(np.float32), y) for b, c, y in rows]
    if not docs or len({y for _, _, y in docs}) < 2:
        return np.zeros(1 << p.bits), 0.0
    ones = sum(y for _, _, y in docs)
    bias[:] = np.log([(len(docs) - ones) / len(docs), ones / len(docs)])
    # Small sets get more passes, so that the number of steps stays useful.
    epochs = max(p.epochs, -(-12000 // len(docs)))
    steps, done = epochs * len(docs), 0
    seen = np.zeros(1 << p.bits, bool)
    for b, _, _ in docs:
        seen[b] = True
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            b, c, y = docs[i]
            rate = p.rate * (1 - done / steps)
            done += 1
            own = vectors[b]
            x = c @ own
            z = weights @ x + bias
            e = np.exp(z - z.max())
            grad = e / e.sum()
            grad[y] -= 1
            back = grad @ weights
            weights -= min(rate, 0.5) * np.outer(grad, x)
            bias -= 0.01 * rate * grad
            # Averages over many features move each vector little: scale by the root of their number.
            vectors[b] = own - (rate * np.sqrt(len(b))) * np.outer(c, back)
    vectors[~seen] = 0
    fold = vectors @ (weights[1] - weights[0])
    return fold, float(bias[1] - bias[0])


def score_slice(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray, bias: float, p: Params) -> np.ndarray:
    total = np.zeros(len(offsets) - 1)
    count = np.zeros(len(offsets) - 1)
    for buckets, first in features(data, offsets, p):
        total += tv.sums_by_text(fold[buckets], first)
        count += np.diff(first)
    z = total / np.maximum(count, 1) + bias
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_COUNTED = pa.schema([("label", pa.int32()), ("buckets", pa.binary()), ("counts", pa.binary())])


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, p: Params,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """The bounded training sample as (buckets, counts, label), features counted on the executors."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.max_train))
    # At most `max_train` rows of two integers: safe to send to every executor.
    sample = id_text(docs, id_col, text_col).join(F.broadcast(marks), "doc_id")

    def count(batches):
        for batch in batches:
            label = batch.column("label").to_numpy()
            for a, _, data, offs in text_slices(batch.column("text")):
                got = list(counted(data, offs, p))
                yield pa.RecordBatch.from_arrays([
                    pa.array(label[a:a + len(got)], pa.int32()),
                    pa.array([b.astype(np.int32).tobytes() for b, _ in got], pa.binary()),
                    pa.array([c.astype(np.uint16 if c.max(initial=0) < 65536 else np.uint32).tobytes() for _, c in got],
                             pa.binary())], schema=_COUNTED)

    rows = []
    for r in sample.select("label", "text").mapInArrow(lean(count), "label int, buckets binary, counts binary").toLocalIterator():
        b = np.frombuffer(r["buckets"], np.int32)
        wide = len(r["counts"]) == 4 * len(b)
        rows.append((b, np.frombuffer(r["counts"], np.uint32 if wide else np.uint16), r["label"]))
    rows.sort(key=lambda r: (len(r[0]), r[0].tobytes(), r[2]))  # the order of arrival must not matter
    return rows


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, params: Params = Params(),
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score) for every row of `docs`; `usable` says which labels may be learned from."""
    score = _scorer(docs, labels, usable, params, id_col, text_col, label_col)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(batch.column("text")))], schema=_SCORED)

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, score double")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float, usable: Column | None = None,
                 params: Params = Params(), id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality") -> DataFrame:
    """The rows of `docs`, all columns, that score at least `threshold`."""
    score = _scorer(docs, labels, usable, params, id_col, text_col, label_col)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column(at)) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)


def _scorer(docs, labels, usable, params, id_col, text_col, label_col):
    """Train, and return a function from a column of texts to scores, fit for the executors."""
    usable = F.lit(True) if usable is None else usable
    fold, bias = train(training_rows(docs, labels, usable, params, id_col, text_col, label_col), params)
    model = docs.sparkSession.sparkContext.broadcast((fold, bias))

    def score(column) -> np.ndarray:
        fold, bias = model.value
        out = np.zeros(len(column))
        for a, b, data, offs in text_slices(column):
            out[a:b] = score_slice(data, offs, fold, bias, params)
        return out

    return score
