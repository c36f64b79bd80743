"""Quality and toxicity: held-out accuracy, defined results, unseen interactions, plain-Python versions."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from offerframe.llm import quality, textvec, toxicity
from offerframe.llm.common import crc_fold, fold_of, ship, text_bytes, text_slices

from . import data

SMALL_Q = quality.Params(bits=14, dim=6, epochs=2)
SMALL_T = toxicity.Params(bits=14, epochs=2)


def _labelled(spark, n=300):
    rng = random.Random(3)
    words = [f"word{i}" for i in range(300)]
    docs, marks = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        bad, toxic = i % 4 == 0, i % 3 == 0
        if bad:
            text = [w.upper() + "!!" for w in text]
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["insultus", "scorned"])
        docs.append((i, " ".join(text)))
        marks.append((i, int(not bad), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    ship(spark)
    docs, labels = _labelled(spark)
    for score, column, folds, params, cut in ((quality.score_quality, "quality", 5, SMALL_Q, 0.3),
                                              (toxicity.score_toxicity, "toxic", 3, SMALL_T, 0.7)):
        got = (score(docs, labels, usable=fold_of("doc_id", folds) != 0, params=params).join(labels, "doc_id")
               .where(fold_of("doc_id", folds) == 0).collect())
        assert np.mean([(r["score"] >= cut) == bool(r[column]) for r in got]) >= 0.9


def test_fold_matches_crc32(spark):
    got = spark.range(50).select("id", fold_of("id", 5).alias("f")).collect()
    assert all(r["f"] == crc_fold(r["id"], 5) for r in got)


def test_awkward_rows_are_scored(spark):
    ship(spark)
    _, labels = _labelled(spark, 60)
    docs, train = data.documents(spark), _labelled(spark, 60)[0]
    for score, params in ((quality.score_quality, SMALL_Q), (toxicity.score_toxicity, SMALL_T)):
        both = docs.select("doc_id", "text").unionByName(train.withColumn("doc_id", F.col("doc_id") + 100))
        shifted = labels.withColumn("doc_id", F.col("doc_id") + 100)
        got = score(both, shifted, params=params).collect()
        assert len(got) == len(data.AWKWARD) + 60 and all(0 <= r["score"] <= 1 for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (4, 5)}) == 1  # empty and NULL: the bias alone
        assert {r["score"] for r in score(docs, shifted, params=params).collect()} == {0.5}  # no labelled row
        assert score(data.empty(spark), shifted, params=params).count() == 0


def test_keep_quality_keeps_all_columns(spark):
    ship(spark)
    docs, labels = _labelled(spark)
    kept = quality.keep_quality(docs.withColumn("score", F.lit("x")), labels, 0.3, params=SMALL_Q)
    assert kept.columns == ["doc_id", "text", "score"]
    ids = {r["doc_id"] for r in kept.collect()}
    assert len(ids & set(range(0, 300, 4))) < 10 and len(ids) > 200


def test_factors_learn_an_interaction():
    """Either term alone is harmless; both together are toxic."""
    rng = random.Random(1)
    rows = []
    for i in range(800):
        t = {rng.randrange(100, 400) for _ in range(12)} | ({7} if i % 2 else set()) | ({9} if i % 4 < 2 else set())
        rows.append((np.array(sorted(t), np.int32), int({7, 9} <= t)))
    model = toxicity.train(rows, toxicity.Params(bits=10, epochs=12, rate=0.3))
    z = {k: model.logit(np.array(k, np.int32)) for k in ((7,), (9,), (7, 9))}
    assert z[(7, 9)] > 0 > max(z[(7,)], z[(9,)])
    assert float(model.factors[7] @ model.factors[9]) > 0


def test_text_bytes_of_sliced_arrays():
    import pyarrow as pa

    column = pa.array(["ab", None, "", "ç"])[1:]
    raw, offs = text_bytes(column)
    assert raw.tobytes() == "ç".encode() and offs.tolist() == [0, 0, 0, 2]


def _two_terms(rng, n, share_a, share_b, toxic):
    rows = []
    for _ in range(n):
        a, b = rng.random() < share_a, rng.random() < share_b
        t = {rng.randrange(100, 400) for _ in range(12)} | ({7} if a else set()) | ({9} if b else set())
        rows.append((np.array(sorted(t), np.int32), int(toxic(a, b))))
    return rows


def _auc(model, rows):
    z = [(model.logit(t), y) for t, y in rows]
    good, bad = [a for a, y in z if y], [a for a, y in z if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_interactions_of_terms_without_a_lean():
    """Exclusive-or: neither term says anything alone.  A group mention is mostly harmless, with an insult never."""
    for share_a, share_b, toxic in ((0.5, 0.5, lambda a, b: a != b), (0.5, 0.5, lambda a, b: a == b),
                                    (0.15, 0.35, lambda a, b: a and b)):
        rows = _two_terms(random.Random(5), 2000, share_a, share_b, toxic)
        model = toxicity.train(rows[:1400], toxicity.Params(bits=10, most=0.6))
        assert _auc(model, rows[1400:]) >= 0.95
        assert model.used[[7, 9]].all() and model.used.sum() < 20
    rows = _two_terms(random.Random(6), 1400, 0.5, 0.5, lambda a, b: a != b)
    blocks = [toxicity.train(rows, toxicity.Params(bits=10, most=0.6, epochs=2, block=b)).used for b in (64, 1024)]
    assert (blocks[0] == blocks[1]).all()


def test_logit_is_the_double_sum():
    rows = _two_terms(random.Random(7), 600, 0.5, 0.5, lambda a, b: a and b)
    model = toxicity.train(rows, toxicity.Params(bits=10, most=0.6, epochs=2, noise=0.5, l1=0.2))
    assert model.used.sum() > 5
    for t, _ in rows[:50]:
        z = model.bias + sum(float(model.weights[i]) for i in t)
        z += sum(float(np.dot(model.factors[i].astype(float), model.factors[j])) for i, j in itertools.combinations(t, 2))
        assert math.isclose(z, model.logit(t), rel_tol=1e-4, abs_tol=1e-4)


TEXTS = ["", "a", "a a a", "Idiot! idiot, IDIOTS", "x1 \u00fcber-cool \u6f22\u5b57 ok\tb\nc", "\U0001f600 smile  twice",
         "under_score 3.14 Zz", None, " ", "abcdefghijkl abcdefghijkm"]
WRAP = (1 << 64) - 1


def _mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & WRAP
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & WRAP
    return h ^ (h >> 31)


def _hash(raw: bytes):
    values = textvec._byte_values()
    return _mixed(sum(int(values[c]) * pow(textvec._BASE, i, 1 << 64) for i, c in enumerate(raw)) + len(raw) & WRAP)


def test_toxicity_terms_by_plain_python():
    import pyarrow as pa

    p = toxicity.Params(bits=12)
    got = [t.tolist() for _, _, raw, offs in text_slices(pa.array(TEXTS)) for t in toxicity.terms(raw, offs, p)]
    for text, terms in zip(TEXTS, got):
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]
        want = {_hash(w) >> 53 for w in words}
        want |= {2048 + (_mixed(_hash(w[:k]) + k & WRAP) >> 53) for w in words for k in p.prefixes}
        assert terms == sorted(want)


def _plain_features(text, p):
    """Counts of the buckets of one text, with loops and a dict."""
    out, down = Counter(), 64 - (p.bits - 1)
    hashes = [_hash(w.encode()) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    for i, h in enumerate(hashes):
        out[h >> down] += 1
        pair = (h - hashes[i - 1]) & WRAP if i else h ^ 0x5555555555555555
        out[_mixed(pair + 77 & WRAP) >> down] += 1
    codes = [int.from_bytes(c.encode(), "little") for c in text]
    for n in p.ngrams:
        for i in range(len(text) - n + 1):
            if not re.search(r"[\x20\x09-\x0D]", text[i + 1:i + n - 1]):
                h = sum(codes[i + k] * (0x9E3779B1 ** (k + 1) | 1) for k in range(n)) & 0xFFFFFFFF
                h ^= h >> 15
                h = h * 0x2C1B3C6D & 0xFFFFFFFF
                h ^= h >> 13
                h = h * 0x297A2D39 & 0xFFFFFFFF
                out[(h >> (32 - (p.bits - 1))) + (1 << (p.bits - 1))] += 1
    return dict(out)


def test_quality_features_by_plain_python():
    import pyarrow as pa

    p = quality.Params(bits=12)
    got = [dict(zip(b.tolist(), c.tolist())) for _, _, raw, offs in text_slices(pa.array(TEXTS))
           for b, c in quality.counted(raw, offs, p)]
    assert got == [_plain_features(t or "", p) for t in TEXTS]


def test_quality_model_by_plain_python():
    """Training with lists, and scores as an average of vectors with a softmax over two classes."""
    import pyarrow as pa

    p = quality.Params(bits=6, dim=3, epochs=1)
    texts = ["good plain words", "BAD!! BAD!!", "plain good text words", "BAD BAD!! worse"]
    labels = [1, 0, 1, 0]
    counts = [_plain_features(t, p) for t in texts]
    rows = [(np.array(sorted(c), np.int32), np.array([c[b] for b in sorted(c)]), y) for c, y in zip(counts, labels)]
    fold, bias = quality.train(rows, p)

    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1 / p.dim, 1 / p.dim, (1 << p.bits, p.dim)).tolist()
    weights, biases = [[0.0] * p.dim for _ in range(2)], [math.log(0.5)] * 2

    def softmax(c):
        total = sum(c.values())
        x = [sum(n / total * vectors[b][k] for b, n in c.items()) for k in range(p.dim)]
        z = [sum(w * v for w, v in zip(weights[y], x)) + biases[y] for y in (0, 1)]
        e = [math.exp(v - max(z)) for v in z]
        return x, [v / sum(e) for v in e]

    steps = 3000 * len(rows)
    for step in range(steps):
        if step % len(rows) == 0:
            order = rng.permutation(len(rows))
        c, y = counts[order[step % len(rows)]], labels[order[step % len(rows)]]
        rate = p.rate * (1 - step / steps)
        x, grad = softmax(c)
        grad[y] -= 1
        back = [sum(grad[k] * weights[k][d] for k in (0, 1)) for d in range(p.dim)]
        for k in (0, 1):
            weights[k] = [w - min(rate, 0.5) * grad[k] * v for w, v in zip(weights[k], x)]
            biases[k] -= 0.01 * rate * grad[k]
        for b, n in c.items():
            vectors[b] = [v - rate * math.sqrt(len(c)) * n / sum(c.values()) * g for v, g in zip(vectors[b], back)]

    ((_, _, raw, offs),) = text_slices(pa.array(texts))
    got = quality.score_slice(raw, offs, fold, bias, p)
    assert np.allclose(got, [softmax(c)[1][1] for c in counts], atol=1e-4)


def test_scores_do_not_depend_on_partitions(spark):
    ship(spark)
    docs, labels = _labelled(spark, 120)
    for score, params in ((quality.score_quality, SMALL_Q), (toxicity.score_toxicity, SMALL_T)):
        got = [sorted(map(tuple, score(d, marks, params=params).collect()))
               for d, marks in ((docs.coalesce(1), labels.coalesce(1)), (docs.repartition(7), labels.repartition(5)))]
        assert [i for i, _ in got[0]] == [i for i, _ in got[1]] == list(range(120))
        assert np.allclose([z for _, z in got[0]], [z for _, z in got[1]], rtol=1e-9)  # sums in another order
