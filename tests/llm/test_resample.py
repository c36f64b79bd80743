"""Importance resampling against plain Python, and the selection on its own."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offerframe.llm import resample
from offerframe.llm.resample import Params

from . import data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, p):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    runs = [" ".join(words[i:i + n]) for n in range(1, p.max_n + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % p.buckets for r in runs]


def brute(docs, target, p):
    count = [[0] * p.buckets, [0] * p.buckets]
    for table, texts in zip(count, ([t for _, t in docs], target)):
        for t in texts:
            for b in features(t, p)[1]:
                table[b] += 1
    (s, t), (all_s, all_t) = count, map(sum, count)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + p.buckets) / ((s[b] + 1) * (all_t + p.buckets)))) for b in range(p.buckets)]
    out, able = [], []
    for doc_id, text in docs:
        words, own = features(text, p)
        h = int(hashlib.sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        row = [doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        out.append(row)
        if len(words) >= p.min_words:
            able.append(row)
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[:p.percent * len(able) // 100]):
        row[4] = k + 1
    return sorted(map(str, out))


def run(spark, docs, target, p):
    aim = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, score string")
    got = resample.resample(docs, aim, p).select("doc_id", "n_features", "weight", "score", "rank").collect()
    return sorted(str(list(r)) for r in got)


@pytest.mark.parametrize("p", [Params(min_words=1, percent=50), Params(max_n=3, min_words=2, percent=30, buckets=97),
                               Params(min_words=5, percent=100, finish=1), Params(percent=0)])
def test_awkward_rows_equal_plain_python(spark, p):
    target = ["alpha beta gamma", None, "", "The MIT license x1 " + "word" * 40]
    docs = [(i, t) for i, t, *_ in data.AWKWARD]
    assert run(spark, data.documents(spark).repartition(4), target, p) == brute(docs, target, p)


def test_many_documents_with_few_words_and_equal_scores(spark):
    rng = np.random.default_rng(3)
    docs = [(int(i) // 2, " ".join(f"w{k}" for k in rng.zipf(1.5, int(n)) % 50)) for i, n in enumerate(rng.integers(0, 12, 600))]
    docs += [(77, "w1 w2 w3 w4")] * 40
    p = Params(min_words=3, percent=35, finish=3)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert run(spark, frame, ["w1 w2", "w7"], p) == brute(docs, ["w1 w2", "w7"], p)


def test_empty_tables(spark):
    p = Params(min_words=1, percent=100)
    assert run(spark, data.empty(spark), ["a"], p) == []
    assert run(spark, data.documents(spark), [], p) == brute([(i, t) for i, t, *_ in data.AWKWARD], [], p)


@pytest.mark.parametrize("finish", [1, 50])
def test_cutoff_is_the_key_of_the_wanted_place(spark, finish):
    rng = np.random.default_rng(finish)
    # A third of all keys share one score, half of those one id.
    score = np.where(rng.random(5000) < 0.34, 7, rng.integers(-10**12, 10**12, 5000))
    ids = np.where(rng.random(5000) < 0.5, 3, rng.integers(0, 10**9, 5000))
    every = sorted(zip(score.tolist(), ids.tolist(), range(5000)))
    frame = resample.written(spark.createDataFrame(every, "k1 long, k2 long, k3 long").repartition(9), "keys")
    for place in (1, 2, 1700, 2500, 4999, 5000):
        assert resample.cutoff(frame, place, Params(finish=finish)) == every[place - 1]
    assert resample.cutoff(frame, 0, Params()) is None


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 2), st.integers(0, 99)), min_size=1, max_size=40, unique=True))
def test_median_key_is_the_lower_median(rows):
    assert tuple(resample.median_key(np.array(rows, np.int64))) == sorted(rows)[(len(rows) - 1) // 2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 10**6), min_size=1, max_size=30), min_size=1, max_size=12))
def test_weighted_median_of_medians_discards_a_quarter(parts):
    keys = [sorted({(v, k, i) for i, v in enumerate(part)}) for k, part in enumerate(parts)]
    pivot = resample.weighted_median([(len(k), k[(len(k) - 1) // 2]) for k in keys])
    every = [key for k in keys for key in k]
    assert 4 * sum(key <= pivot for key in every) >= len(every)
    assert 4 * sum(key >= pivot for key in every) >= len(every)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=70), max_size=20))
def test_crc_of_many_ranges_equals_zlib(parts):
    raw = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(b) for b in parts]).astype(np.int64)
    starts = ends - np.array([len(b) for b in parts], np.int64)
    got = resample.crc_on(raw, starts, ends, np.zeros(len(parts), np.uint32))
    assert got.tolist() == [zlib.crc32(b) for b in parts]


def test_draw_prefers_texts_like_the_target(spark):
    docs = [(i, " ".join(["good" if i % 4 == 0 else "other"] * 5 + ["filler"] * 20)) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    aim = spark.createDataFrame([("good good good",)], "text string")
    drawn = resample.resample(frame, aim).where(F.col("rank").isNotNull()).collect()
    assert len(drawn) == 40 and all(r["doc_id"] % 4 == 0 for r in drawn)
