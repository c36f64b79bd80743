"""Vector code compression against plain Lloyd rounds in Python integers."""

import math

import numpy as np
import pytest

from offerframe.llm import codebooks
from offerframe.llm.codebooks import Params


def brute(rows, p):
    """rows (vec_id, vector, label) -> ({(vec_id, code, error): count}, books) by plain loops."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    ints = [[max(-2**26, min(2**26, math.floor(p.scale * x))) for x in r[1]] for r in kept]
    width = -(-len(ints[0]) // p.parts)
    cut = [[(v + [0] * (p.parts * width - len(v)))[q * width:(q + 1) * width] for q in range(p.parts)] for v in ints]
    books = [[v[q] for v in cut[:p.entries]] for q in range(p.parts)]

    def assign():
        out = []
        for v in cut:
            own = []
            for q in range(p.parts):
                far = [sum((a - b) ** 2 for a, b in zip(v[q], e)) for e in books[q]]
                own.append((far.index(min(far)), min(far)))
            out.append(own)
        return out

    for _ in range(p.rounds):
        now = assign()
        for q in range(p.parts):
            for k in range(len(books[q])):
                mine = [v[q] for v, a in zip(cut, now) if a[q][0] == k]
                if mine:
                    books[q][k] = [sum(c) // len(mine) for c in zip(*mine)]
    final = assign()
    return sorted((str(r[0]), "".join(f"{k:02x}" for k, _ in a), sum(f for _, f in a)) for r, a in zip(kept, final)), books


def frame(spark, rows):
    df = spark.createDataFrame([(a, b, c, "x", "x") for a, b, c in rows],
                               "vec_id long, embedding array<double>, label int, code string, row string")
    return df.repartition(3)


def check(spark, rows, p):
    coded, books = codebooks.compress(frame(spark, rows), p)
    got = sorted((str(r["vec_id"]), r["code"], r["error"]) for r in coded.collect())
    want, want_books = brute(rows, p)
    assert got == want
    assert books.tolist() == want_books


@pytest.mark.parametrize("owner_rows", [7, 100_000])
def test_equals_plain_lloyd_rounds(spark, owner_rows):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 16))
    rows = [(i, (centres[min(i % 15, 8)] + 0.3 * rng.normal(size=16)).tolist(), i % 3 or None) for i in range(300)]
    rows += [(400 + i, [0.5] * 16, 7) for i in range(120)]
    check(spark, rows, Params(owner_rows=owner_rows))


def test_awkward_rows(spark):
    good = [(i, [float((i * k) % 7) / 3 - 1 for k in range(1, 11)], None) for i in range(12)]
    rows = good + [good[0], good[3], (None, [0.1] * 10, 1), (50, None, 1), (51, [], 1), (52, [1.0, None] + [0.0] * 8, 2),
                   (53, [float("nan")] * 10, 2), (54, [float("-inf")] * 10, 2), (55, [1.0] * 9, 2), (56, [1e300] * 10, 2)]
    check(spark, rows, Params(entries=5, rounds=3))


def test_empty_tables_and_empty_vectors(spark):
    empty, books = codebooks.compress(frame(spark, [(1, None, 1)]))
    assert books is None and codebooks.with_label_error(empty).collect() == []
    coded, _ = codebooks.compress(frame(spark, [(1, [], 1), (2, [], None)]))
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in coded.collect()) == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_only_members_that_change_entry_are_written_again(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=16).tolist(), 0) for i in range(500)]
    seen = {}
    real = codebooks.written

    def spy(df, name):
        out = real(df, name)
        seen[name] = out
        return out

    monkeypatch.setattr(codebooks, "written", spy)
    p = Params()
    _, books = codebooks.compress(frame(spark, rows), p)
    sizes = [seen[f"gen-{g}"].count() for g in range(p.rounds)]
    assert sizes[0] == 500 * p.parts
    # Count the changes of entry with the codebooks of every round.
    x = codebooks.to_integers(np.array([r[1] for r in rows]), p)
    now = np.ascontiguousarray(x[:p.entries].transpose(1, 0, 2))
    old, moved = None, []
    for _ in range(p.rounds):
        new = np.stack([codebooks.nearest(x[:, q], now[q])[0] for q in range(p.parts)], 1)
        moved.append(new.size if old is None else int((new != old).sum()))
        for q in range(p.parts):
            for k in np.unique(new[:, q]):
                now[q, k] = x[new[:, q] == k, q].sum(0) // (new[:, q] == k).sum()
        old = new
    assert sizes == moved and np.array_equal(now, books)


def test_label_error_sums_equal_labels_nulls_together(spark):
    rows = [(i, [math.sin(i * k) for k in range(1, 9)], [1, None, 2][i % 3]) for i in range(60)]
    coded, _ = codebooks.compress(frame(spark, rows), Params(entries=3))
    got = codebooks.with_label_error(coded).collect()
    for label in (1, None, 2):
        own = [r for r in got if r["label"] == label]
        assert len(own) == 20 and {r["label_error"] for r in own} == {sum(r["error"] for r in own)}
