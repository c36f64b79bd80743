"""Importance resampling towards a target: hashed n-gram weights and an exact draw.

1. Every run of 1 to `max_n` consecutive words is a feature; its bucket is the
   CRC-32 of its bytes modulo `buckets`.  One scan of each table adds up the
   features per bucket, in arrays of `buckets` counters.
2. A bucket's gain is the scaled logarithm of its share in the target against
   its share in the corpus.  The gains are one array of `buckets` numbers that
   every task holds; a second scan scores each document by taking from it.
3. A document's score is its weight plus Gumbel noise from a hash of its id, so
   the highest scores are a draw without replacement by importance.  The cutoff
   is found by weighted median of medians: every partition names the median of
   its remaining keys and their number, the median of those medians, weighted
   by the numbers, is the pivot, and a count of the keys up to it discards all
   keys on one side, a quarter of what remains at least.  Partitions count, and
   name the medians of both sides, in one pass.  Only medians and numbers reach
   the driver, and at the end at most `finish` keys.  Keys are (score, id,
   row), never equal, so that exactly as many rows are drawn as were asked for.
4. The winners are sorted and numbered; no other row is sorted or shuffled.

Defined results: NULL and empty texts have no features and weight 0.  A NULL
id is hashed as the empty text after the seed, and loses ties.  Rows that
repeat are rows of their own: of equal keys any are drawn, as many as fit.
Empty tables: no corpus, no rows; no target, gains from the corpus alone.
Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import rank_within
from . import textvec as tv
from .common import id_text, lean, ship, text_slices, written


@dataclass(frozen=True)
class Params:
    max_n: int = 1          # words of the longest feature
    buckets: int = 10_000
    seed: int = 2024
    min_words: int = 20     # shorter documents are not drawn
    percent: int = 10       # of the documents that are long enough
    finish: int = 4096      # keys that are left when the driver picks the cutoff itself


# --- CRC-32 of many byte ranges at once -------------------------------------------------

_CRC_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(_CRC_POLYNOMIAL), np.uint32(0))
    return crc


_TABLE = _crc_table()
_BY_LETTER = 48  # longer words are left to zlib, one by one


def crc_on(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC-32 values `crc` continued over the byte ranges, all ranges letter by letter together."""
    size = ends - starts
    out = crc.copy()
    for i in np.flatnonzero(size > _BY_LETTER).tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(crc[i]))
    # Sorted by length, the ranges that still have a letter are always the last ones.
    order = np.argsort(np.where(size > _BY_LETTER, 0, size), kind="stable")
    length = np.where(size > _BY_LETTER, 0, size)[order]
    begin = starts[order]
    state = ~crc[order]
    for at in range(int(length[-1]) if len(length) else 0):
        live = np.searchsorted(length, at, side="right")
        now = state[live:]
        state[live:] = _TABLE[(now ^ data[begin[live:] + at]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    short = length > 0
    out[order[short]] = ~state[short]
    return out


def feature_buckets(data: np.ndarray, offsets: np.ndarray, p: Params):
    """Buckets of all features of a slice, the text each belongs to, and each text's number of words."""
    data = tv.LOWER[data]
    starts, ends, first = tv.word_spans(data, offsets, tv.ALNUM)
    words = np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    crc = crc_on(data, starts, ends, np.zeros(len(starts), np.uint32))
    found, where = [crc], [text]
    space = np.array([0x20], np.uint8)
    for n in range(1, p.max_n):
        # Runs of n words that have a next word in their text go on with a space and that word.
        more = np.flatnonzero(text[:-n] == text[n:])
        full = np.zeros(max(0, len(starts) - n), np.uint32)
        if len(more):
            at = crc_on(space, np.zeros(len(more), np.int64), np.ones(len(more), np.int64), crc[more])
            full[more] = crc_on(data, starts[more + n], ends[more + n], at)
        found.append(full[more])
        where.append(text[more])
        crc = full
    return (np.concatenate(found) % np.uint32(p.buckets)).astype(np.int64), np.concatenate(where), words


# --- counts, gains, weights -------------------------------------------------------------

def bucket_counts(texts: DataFrame, p: Params) -> np.ndarray:
    """Features per bucket over all texts: `buckets` numbers, whatever the table."""
    def run(batches):
        total = np.zeros(p.buckets, np.int64)
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column("text")):
                total += np.bincount(feature_buckets(data, offs, p)[0], minlength=p.buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(lean(run), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(p.buckets, np.int64)
    for r in sums.collect():  # one row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, p: Params) -> np.ndarray:
    """floor(1000 * ln of the smoothed share in the target over that in the corpus) of every bucket."""
    all_s, all_t = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * float(all_s + p.buckets) / ((s + 1) * float(all_t + p.buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, p: Params) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of `docs` (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        own = sent.value.astype(np.float64)  # sums stay below 2**53, so they are exact
        for batch in batches:
            for a, b, data, offs in text_slices(batch.column("text")):
                bucket, text, words = feature_buckets(data, offs, p)
                weight = np.bincount(text, own[bucket], minlength=b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(words.astype(np.int64)),
                     pa.array(np.bincount(text, minlength=b - a).astype(np.int64)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    return docs.mapInArrow(lean(run), "doc_id long, n_words long, n_features long, weight long")


def noise(p: Params):
    """Gumbel noise in thousandths from the first 32 bits of the id's salted hash."""
    digest = F.sha2(F.concat(F.lit(f"{p.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    unit = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(unit)))


# --- the exact cutoff -------------------------------------------------------------------

_KEY = ["k1", "k2", "k3"]  # ascending: the best key is the smallest
_LAST = (1 << 63) - 1


def keys(scored: DataFrame) -> DataFrame:
    """Rows as keys of three numbers: the score negated, the id (none: last), the row."""
    return scored.select((-F.col("score")).alias("k1"), F.coalesce("doc_id", F.lit(_LAST)).alias("k2"), F.col("row").alias("k3"))


def _at_most(a: np.ndarray, pivot: tuple) -> np.ndarray:
    """Which keys (rows of a, three columns) are at most `pivot`."""
    return ((a[:, 0] < pivot[0]) | ((a[:, 0] == pivot[0])
            & ((a[:, 1] < pivot[1]) | ((a[:, 1] == pivot[1]) & (a[:, 2] <= pivot[2])))))


def median_key(a: np.ndarray) -> list | None:
    """Lower median of keys, by selection: first among the scores, then among the equal ones."""
    at = (len(a) - 1) // 2
    for c in range(a.shape[1]):
        if not len(a):
            return None
        value = np.partition(a[:, c], at)[at]
        at -= int((a[:, c] < value).sum())
        a = a[a[:, c] == value]
    return a[0].tolist()


_SIDE = "side int, n long, " + ", ".join(f"{k} long" for k in _KEY)


def _sides(low, high, pivot):
    """Partition of keys -> (number, median) of its keys in (low, pivot] and in (pivot, high]; ends may be None."""
    schema = pa.schema([("side", pa.int32()), ("n", pa.int64()), *((k, pa.int64()) for k in _KEY)])

    def run(batches):
        held = []
        for batch in batches:
            a = np.stack([batch.column(k).to_numpy() for k in _KEY], 1)
            inside = np.ones(len(a), bool)
            if low is not None:
                inside &= ~_at_most(a, low)
            if high is not None:
                inside &= _at_most(a, high)
            held.append(a[inside])
        a = np.concatenate(held) if held else np.zeros((0, 3), np.int64)
        left = _at_most(a, pivot) if pivot is not None else np.ones(len(a), bool)
        out = [(side, len(own), *median_key(own)) for side, own in ((0, a[left]), (1, a[~left])) if len(own)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def weighted_median(medians: list[tuple]) -> tuple:
    """The key at which half of the weight of (weight, key) is reached: at least a quarter of all keys lies on each side."""
    medians = sorted(medians, key=lambda m: m[1])
    total, seen = sum(n for n, _ in medians), 0
    for n, key in medians:
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no keys")


def cutoff(keyed: DataFrame, wanted: int, p: Params) -> tuple | None:
    """The `wanted`-th smallest key (None: no key is wanted; the greatest possible: there are not so many).

    `keyed` is a written table."""
    if wanted <= 0:
        return None
    low = high = pivot = None
    table_rows = None
    while True:
        sides = keyed.mapInArrow(lean(_sides(low, high, pivot)), _SIDE).collect()  # two rows per partition at most
        found = [[(r["n"], (r["k1"], r["k2"], r["k3"])) for r in sides if r["side"] == s] for s in (0, 1)]
        left, right = (sum(n for n, _ in f) for f in found)
        if wanted > left + right:
            return (_LAST, _LAST, _LAST)
        if wanted <= left:
            remaining, medians, high = left, found[0], (pivot or high)
        else:
            remaining, medians, low, wanted = right, found[1], pivot, wanted - left
        table_rows = table_rows or left + right
        if remaining <= p.finish or remaining * 4 <= table_rows:
            inside = F.lit(True)
            key = F.struct(*_KEY)
            if low is not None:
                inside &= key > F.struct(*[F.lit(v).cast("long").alias(k) for v, k in zip(low, _KEY)])
            if high is not None:
                inside &= key <= F.struct(*[F.lit(v).cast("long").alias(k) for v, k in zip(high, _KEY)])
            if remaining <= p.finish:
                last = keyed.where(inside).collect()
                return sorted((r["k1"], r["k2"], r["k3"]) for r in last)[wanted - 1]
            keyed, table_rows = written(keyed.where(inside), "remaining"), remaining
        pivot = weighted_median(medians)


def resample(docs: DataFrame, target: DataFrame, params: Params = Params(), id_col: str = "doc_id",
             text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row of `docs`; rank is NULL for rows not drawn."""
    p = params
    ship(docs.sparkSession)
    own = id_text(docs, id_col, text_col)
    corpus = bucket_counts(own, p)
    aim = bucket_counts(target.select(F.col(target_text_col).cast("string").alias("text")), p)
    scored = (weights(own, gains(corpus, aim, p), p)
              .withColumn("score", F.col("weight") + noise(p)).withColumn("row", F.monotonically_increasing_id()))
    scored = written(scored, "scores")
    able = scored.where(F.col("n_words") >= p.min_words)
    last = cutoff(keys(able), able.count() * p.percent // 100, p)
    if last is None:
        return scored.drop("row").withColumn("rank", F.lit(None).cast("long"))
    key = F.struct((-F.col("score")).alias("k1"), F.coalesce("doc_id", F.lit(_LAST)).alias("k2"), F.col("row").alias("k3"))
    wins = (F.col("n_words") >= p.min_words) & (key <= F.struct(*[F.lit(v).cast("long").alias(k) for v, k in zip(last, _KEY)]))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    drawn = rank_within(scored.where(wins), [], order)
    return (drawn.drop("row").unionByName(scored.where(~wins).drop("row").withColumn("rank", F.lit(None).cast("long")))
            .select("doc_id", "n_words", "n_features", "weight", "score", "rank"))


def oracle_sql(p: Params) -> str:
    """DuckDB SQL of the registered query (features of one word); CRC-32 byte by byte, once per distinct word."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (f"unnest(regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'),"
             r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))")
    return f"""
        WITH tab AS MATERIALIZED (
            SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, {_CRC_POLYNOMIAL}) ELSE c >> 1 END, b)
                        ORDER BY b) AS t FROM range(256) r(b)),
        d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
        dw AS MATERIALIZED (SELECT r, w, count(*) AS n FROM (SELECT r, {words} AS w FROM d) GROUP BY r, w),
        bw AS MATERIALIZED (SELECT w, count(*) AS n FROM (SELECT {words} AS w FROM benchmark) GROUP BY w),
        crc AS MATERIALIZED (
            SELECT w, xor(list_reduce(
                       list_transform(range(1, len(h) + 1, 2), lambda i: CAST(('0x' || h[i:i + 1]) AS BIGINT)),
                       lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) % {p.buckets} AS k
            FROM (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)), tab),
        s AS (SELECT k, sum(n) AS s FROM dw JOIN crc USING (w) GROUP BY k),
        t AS (SELECT k, sum(n) AS t FROM bw JOIN crc USING (w) GROUP BY k),
        g AS MATERIALIZED (
            SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * CAST((SELECT coalesce(sum(n), 0) FROM dw) + {p.buckets} AS DOUBLE)
                       / ((coalesce(s, 0) + 1) * CAST((SELECT coalesce(sum(n), 0) FROM bw) + {p.buckets} AS DOUBLE)))) AS BIGINT) AS gain
            FROM (SELECT * FROM range({p.buckets}) z(k)) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
        w AS (SELECT r, sum(n) AS n, sum(n * gain) AS weight FROM dw JOIN crc USING (w) JOIN g USING (k) GROUP BY r),
        x AS (SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                     CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('{p.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))
                          AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
              FROM d LEFT JOIN w USING (r)),
        y AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {p.min_words} ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x)
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= {p.min_words}
                    AND rank <= (SELECT count(*) FROM x WHERE n_features >= {p.min_words}) * {p.percent} // 100 THEN rank END AS rank
        FROM y"""
