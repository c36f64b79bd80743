"""Exact and near dedup, embeddings: against brute force, on awkward rows and skewed groups."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerframe.llm import components as components_module
from offerframe.llm import embed_dedup, jaccard, trie_dedup
from offerframe.llm.common import ship
from offerframe.llm.components import components, local_components

from . import data

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def reach(ids, links):
    low = {i: i for i in ids}
    for _ in range(len(low)):
        new = dict(low)
        for a, b in links:
            m = min(new[a], new[b])
            new[a] = new[b] = m
        if new == low:
            break
        low = new
    return low


# --- exact ------------------------------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=60), st.sampled_from([600, 1 << 20]))
def test_tries_group_equal_strings(keys, limit):
    owners = trie_dedup.Owners(limit)
    for i, key in enumerate(keys):
        owners.add(key, [i], (1, i, i), 1)
    got = sorted((sorted(reps), owner[1], n) for reps, owner, n in owners.groups())
    want = {}
    for i, key in enumerate(keys):
        want.setdefault(key, []).append(i)
    assert got == sorted((v, v[0], len(v)) for v in want.values())


def test_spill_by_subtree_with_long_common_prefixes():
    keys = [b"x" * 500 + bytes([i % 7, i % 5]) * 40 + str(i % 90).encode() for i in range(400)]
    owners = trie_dedup.Owners(4000)
    for i, key in enumerate(keys):
        owners.add(key, [i], (1, i, i), 1)
    assert owners.files
    assert sum(n for _, _, n in owners.groups()) == 400


def _exact(rows):
    groups = {}
    for n, (i, text, *_) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, n))
    return sorted(((rows[m[3]][0], rows[min(g)[3]][0], len(g), m == min(g)) for g in groups.values() for m in g), key=str)


def test_exact_groups(spark):
    ship(spark)
    rows = data.AWKWARD + [(100 + i, "copy of one text" + " " * (i % 3), "en", "src0") for i in range(300)]
    docs = data.documents(spark, rows).repartition(5)
    got = trie_dedup.exact_groups(docs, params=trie_dedup.Params(map_bytes=2000, trie_bytes=4000)).collect()
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got]
    # Which of two fully equal rows stays is free: compare the rest, and one kept row per group.
    assert sorted(g[:3] for g in got if g[0] is not None) == sorted(w[:3] for w in _exact(rows) if w[0] is not None)
    assert sum(g[3] for g in got) == sum(w[3] for w in _exact(rows))
    assert trie_dedup.exact_groups(data.empty(spark)).count() == 0


def test_exact_dedup_returns_whole_rows(spark):
    ship(spark)
    docs = data.documents(spark)
    out = trie_dedup.exact_dedup(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(w[3] for w in _exact(data.AWKWARD))


# --- near -------------------------------------------------------------------------------

def _sets(rows):
    out = {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def _brute(rows):
    sets = _sets([r for r in rows if r[0] is not None])
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, reach(ids, links)


def _corpus(seed=0, n=160):
    """Near copies of every degree around the threshold, a passage that many share, and short texts."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows, base = [], []
    for i in range(n):
        kind = i % 4
        if kind == 0 or not base:
            text = [rng.choice(words) for _ in range(rng.randint(3, 200))]
            base.append(text)
        elif kind == 3:
            text = passage + [rng.choice(words) for _ in range(rng.randint(2, 40))]
        else:
            text = list(rng.choice(base))
            for _ in range(max(1, int(len(text) * rng.choice([0.005, 0.01, 0.02, 0.03, 0.05])))):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text), "en", "src0"))
    return rows


def test_near_duplicates_match_brute_force(spark):
    ship(spark)
    rows = _corpus()
    sets, want = _brute(rows)
    assert len(set(want.values())) < len(rows)  # there are links to find
    for params in (jaccard.Params(), jaccard.Params(block=8, leaf=2, held_keys=50, sketch_bits=16, listed=3, groups=32, boxes=4)):
        got = jaccard.near_duplicates(data.documents(spark, rows).repartition(6), params).collect()
        assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(i, len(sets[i]), want[i]) for i in sets}


def test_near_duplicates_awkward(spark):
    ship(spark)
    sets, want = _brute(data.AWKWARD)
    got = jaccard.near_duplicates(data.documents(spark)).collect()
    assert len(got) == len(data.AWKWARD)
    known = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None}
    assert known == {i: (len(sets[i]), want[i]) for i in sets}
    assert want[10] == 9 and want[8] == 7 and want[5] == 5
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    assert jaccard.near_duplicates(data.empty(spark)).count() == 0


def test_near_dedup_keeps_one_per_component(spark):
    ship(spark)
    rows = _corpus(1, 80)
    _, want = _brute(rows)
    docs = data.documents(spark, rows)
    out = jaccard.near_dedup(docs)
    assert set(out.columns) == set(docs.columns)
    assert {r["doc_id"] for r in out.collect()} == set(want.values())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000))
def test_rtree_loses_no_pair(seed):
    rng = np.random.default_rng(seed)
    x = (rng.integers(0, 4, (40, 6)) + rng.integers(0, 2, (40, 1)) * 5).astype(np.uint8)
    x[rng.integers(0, 40, 2), 1] = 255  # at the counter's limit: unbounded
    n, comp = x.sum(1, dtype=np.int64), rng.integers(0, 10, 40)
    p = jaccard.Params(leaf=3, groups=6, boxes=2)
    every = np.arange(40)
    got = {tuple(sorted(t)) for i, j in jaccard.tree_pairs(x, n, comp, p, every, every) for t in zip(i.tolist(), j.tolist())}
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if comp[i] != comp[j]
            and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j]) and (180 * np.minimum(x[i], x[j]).sum(dtype=np.int64) >= 80 * (n[i] + n[j]) or x[i, 1] == x[j, 1] == 255)}
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_links_of_a_team_connect_what_is_linked(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    sets = []
    for _ in range(30):
        keep = base[rng.random(60) < rng.choice([0.8, 0.9, 0.95, 0.3])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, rng.integers(0, 8), dtype=np.uint64)])))
    comp = rng.integers(0, 20, 30)
    p = jaccard.Params(leaf=3, groups=16, boxes=4)
    links = list(jaccard.linked_pairs(sets, comp, p))
    for i, j in links:
        shared = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared)
    every = [(i, j) for i in range(30) for j in range(i) if (m := len(np.intersect1d(sets[i], sets[j])))
             and 100 * m >= 80 * (len(sets[i]) + len(sets[j]) - m)]
    same = [(i, j) for i in range(30) for j in range(i) if comp[i] == comp[j]]
    assert reach(range(30), links + same) == reach(range(30), every + same)
    assert len(links) < len(set(comp.tolist()))


def test_rows_of_copies_below_the_threshold_grow_in_proportion(spark, monkeypatch):
    ship(spark)
    seen = {}
    real = jaccard.written

    def spy(df, name):
        out = real(df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "written", spy)
    rng = random.Random(4)
    base = [f"t{rng.randrange(5000)}" for _ in range(300)]
    rows = {}
    for n in (250, 1000):
        texts = []
        for i in range(n):
            words = list(base)
            for k in rng.sample(range(0, 300, 6), 5):
                words[k] = f"own{i}x{k}"
            texts.append((i, " ".join(words), "en", "src0"))
        out = jaccard.near_duplicates(data.documents(spark, texts)).where("component_id <> doc_id").count()
        assert out < n / 2  # most of them are near each other, but not near enough
        rows[n] = seen["teams"], seen["pairs"]
    for of in (0, 1):
        assert rows[1000][of] <= 6 * max(rows[250][of], 250)  # four times the documents; all pairs would be 16 times as many


# --- components -------------------------------------------------------------------------

@pytest.mark.parametrize("task_links", [components_module.TASK_LINKS, 10])
def test_components_of_chains_and_stars(spark, monkeypatch, task_links):
    ship(spark)
    monkeypatch.setattr(components_module, "TASK_LINKS", task_links)
    links = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(200, 260)] + [(300, 300), (301, None)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["id"]: r["component_id"] for r in components(df).collect()}
    want = reach({x for a, b in links[:-2] for x in (a, b)}, links[:-2])
    assert got == want
    assert components(df.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60))
def test_local_components(links):
    a, b = (np.array(c) for c in zip(*links))
    nodes, low = local_components(a, b)
    assert dict(zip(nodes.tolist(), low.tolist())) == reach({x for p in links for x in p}, links)


# --- embeddings -------------------------------------------------------------------------

def test_embeddings_match_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 24))
    near = [base[i % 30] + 0.05 * rng.normal(size=24) for i in range(200)]      # pairs and small groups
    dense = [base[0] + 0.02 * rng.normal(size=24) for _ in range(150)]           # one group far over the window
    x = np.concatenate([base, near, dense, base[:5], np.repeat(base[7:8], 40, 0)]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(9001, None), (9002, []), (9003, [0.0] * 24), (9004, [None] + [1.0] * 23), (9005, [float("nan")] * 24),
           (9006, [float("inf")] + [0.0] * 23), (9007, [1.0, 2.0]), (9008, [2.0, 4.0]), (None, x[0].tolist())]
    df = spark.createDataFrame(rows + [(*o, 1) for o in odd], "vec_id long, embedding array<float>, rep int")
    got = {r["vec_id"]: r for r in embed_dedup.embedding_duplicates(df, embed_dedup.Params(window=8, block=64)).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = reach(range(len(x)), list(zip(*(k.tolist() for k in np.nonzero(near)))))
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.99 * near.sum()
    assert np.mean([got[i]["component_id"] == want[i] for i in range(len(x))]) >= 0.99
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in range(len(x)))
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(9001, 9007)] == [(0, i) for i in range(9001, 9007)]
    assert got[9008]["component_id"] == 9007 and got[9007]["n_links"] == 1
    assert got[None]["n_links"] == 0
    assert embed_dedup.embedding_duplicates(df.limit(0)).count() == 0


def test_crowded_embeddings_match_brute_force(spark):
    """Different vectors at a mutual cosine of about 0.9, some of them with a near copy."""
    ship(spark)
    rng = np.random.default_rng(6)
    axis = rng.normal(size=48)
    axis /= np.linalg.norm(axis)
    hot = 3 * axis + rng.normal(size=(1500, 48)) / np.sqrt(48)
    spread = rng.normal(size=(1500, 48))
    near = [hot[i] + 0.6 * rng.normal(size=48) / np.sqrt(48) for i in range(0, 1500, 5)]
    x = np.concatenate([hot, spread, near]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embed_dedup.embedding_duplicates(df, embed_dedup.Params(cosine=0.97, window=4, block=64)).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    pairs = u @ u.T >= 0.97
    np.fill_diagonal(pairs, False)
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert pairs.sum() > 300 and (links <= pairs.sum(1)).all() and links.sum() >= 0.99 * pairs.sum()


def test_equal_bits_of_keys():
    a = np.array([0, -1, 1 << 62, 5, (1 << 54) - 1], np.int64)
    b = np.array([0, 0, 0, 4, 0], np.int64)
    assert embed_dedup.equal_bits(a, b).tolist() == [64, 0, 1, 63, 10]


def test_near_dedup_shuffles_only_texts_that_may_go(spark, monkeypatch):
    seen, split = [], jaccard.bloom.split

    def counted(*args):
        asked, rest = split(*args)
        seen.append((asked.count(), rest.count()))
        return asked, rest

    monkeypatch.setattr(jaccard.bloom, "split", counted)
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(30)), k % 3) for k in range(200)]
    rows += [(1000 + k, rows[k][1] + " end", 0) for k in range(10)] + [(1000, "of one id with a copy", 1), (None, rows[0][1], 2), (300, None, 0)]
    for kind in ("long", "int"):
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, other int")
        out = jaccard.near_dedup(docs)
        assert out.schema == docs.schema
        gone = {1000 + k for k in range(10)}
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(str(r) for r in rows if r[0] not in gone)
        asked, rest = seen.pop()
        assert asked + rest == len(rows) and 11 <= asked <= 60  # the rows of the ids that go, few others


def test_exact_dedup_shuffles_only_texts_that_may_go(spark, monkeypatch):
    seen, split = [], trie_dedup.bloom.split

    def counted(*args):
        asked, rest = split(*args)
        seen.append((asked.count(), rest.count()))
        return asked, rest

    monkeypatch.setattr(trie_dedup.bloom, "split", counted)
    ship(spark)
    rows = [(k, f"text number {k}", k % 3) for k in range(200)] + [(None, "no id", 0), (200, None, 0)]
    copies = [(1000 + k, f"text  number {k} ", 5) for k in range(0, 200, 20)] + [(None, "no id", 0), (201, " ", 1), (7, "text number 7", 1)]
    out = trie_dedup.exact_dedup(spark.createDataFrame(rows + copies, "doc_id long, text string, other int")).collect()
    # The longer original stays, also of an equal pair without ids one, and of the equal rows of id 7 the first or second.
    assert len(out) == len(rows)
    assert {r["doc_id"] for r in out} == ({k for k in range(200) if k % 20} | {1000 + k for k in range(0, 200, 20)} | {None, 201})
    asked, rest = seen.pop()
    assert asked + rest == len(rows + copies) and len(copies) <= asked <= 60


def test_counters_take_little_more_than_a_byte_each():
    rng = np.random.default_rng(1)
    size = 2 * jaccard._SKETCH_PART
    full = rng.integers(0, 300, size)
    few = np.zeros(size, np.int64)
    few[[3, 70_000]] = 1, 1 << 30
    for table, most in ((full, 2.0 * size), (few, 12), (full[:70_000], 2.0 * size), (few[:5], 6)):
        parts = list(jaccard._used(table))
        assert sum(len(raw) for _, raw in parts) <= most
        total = np.zeros(size, np.int64)
        for k, raw in parts * 2:
            jaccard._add_used(total[k * jaccard._SKETCH_PART:(k + 1) * jaccard._SKETCH_PART], raw)
        assert (total[:len(table)] == 2 * table).all() and not total[len(table):].any()


def test_fine_points_keep_unrelated_large_sets_apart():
    p = jaccard.Params()
    rng = np.random.default_rng(2)
    made = [np.unique(rng.integers(0, 1 << 63, 12_000, dtype=np.uint64)) for _ in range(4)]
    made[1] = np.unique(np.concatenate([made[0][:11_000], rng.integers(0, 1 << 63, 800, dtype=np.uint64)]))
    coarse = np.stack([jaccard.point_of(s, p.groups) for s in made])
    n, every = np.array([len(s) for s in made]), np.arange(4)
    pairs = sum(len(i) for i, _ in jaccard.tree_pairs(coarse, n, every, p, every, every))
    assert pairs == 6  # the points alone leave them all
    fine = [jaccard.point_of(s, p.fine).tobytes() for s in made]
    columns = [[9] * 5, [*range(4), 3], [0, 1, 2, 3, 3], [*n.tolist(), int(n[3])], fine + [None]]
    names = ["team", "doc_id", "comp", "n", "fine"]
    types = [jaccard.pa.int64()] * 4 + [jaccard.pa.binary()]

    def left(rows):
        batch = jaccard.pa.RecordBatch.from_arrays([jaccard.pa.array([c[i] for i in rows], t) for c, t in zip(columns, types)], names=names)
        return [sorted(b.column("doc_id").to_pylist()) for b in jaccard._sift(p)(iter([batch]))]

    assert left([0, 1, 2, 3]) == [[0, 1]]
    assert left([2, 3]) == []
    assert left([2, 4]) == [[2, 3]]  # a set whose fine point is not known is not ruled out


def test_blocks_are_found_with_narrow_rows(spark, monkeypatch):
    ship(spark)
    seen, real = {}, jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: seen.setdefault(name, []).append(df.columns) or real(df, name))
    rows = _corpus(3, 60)
    rows += [(i, t, "fr", s) for i, t, _, s in rows[:10]]  # ids that repeat
    _, want = _brute(rows)
    got = jaccard.near_duplicates(data.documents(spark, rows), jaccard.Params(listed=3, block=8)).collect()
    assert len(got) == len(rows) and {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())
    assert not {"point", "keys"} & set(seen["rows"][0]) and seen["sifted"] == [["team", "doc_id", "comp"]]


def test_only_texts_whose_hash_repeats_go_to_the_tries_of_partitions(spark, monkeypatch):
    ship(spark)
    seen, real = {}, trie_dedup.written
    monkeypatch.setattr(trie_dedup, "written", lambda df, name, **o: seen.setdefault(name, real(df, name, **o)))
    rows = [(k, f"text number {k} " + "x" * k, "en", "s") for k in range(300)] + [(None, "no id", "en", "s"), (None, None, "en", "s")]
    copies = [(1000 + k, f"text number{k}" + "x" * k, "en", "s") for k in range(0, 300, 30)] + [(2000, " ", "en", "s"), (299, rows[299][1], "en", "s")]
    docs = data.documents(spark, rows + copies).repartition(7)
    got = trie_dedup.exact_groups(docs).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got), key=str) == _exact(rows + copies)
    keys = [r["key"] for r in seen["trie"].where("row IS NULL").select("key").collect()]
    sent = [k for k in keys if k is not None]
    assert len(set(sent)) >= len(copies) and len(sent) <= 60 < len(keys)


def test_counters_grow_with_the_text_and_cost_no_more():
    p = jaccard.Params()
    assert jaccard.sketch_size(0, p) == 1 << p.sketch_bits
    assert jaccard.sketch_size(40 << 40, p) == 1 << p.most_bits
    # As many shingles share a counter in a small and in a large corpus.
    assert jaccard.sketch_size(480 << 24, p) == 10 * jaccard.sketch_size(48 << 24, p)
    rng = np.random.default_rng(3)
    s = rng.integers(0, 1 << 63, 200_000, dtype=np.uint64) << np.uint64(1)
    for size in (1 << 20, 3_000_001, 1 << 28):
        at, counts = np.unique(jaccard._counter(s, size), return_counts=True)
        assert at[0] >= 0 and at[-1] < size
        parts = list(jaccard._packed(at, counts))
        if size < 1 << 22:  # in large tables a part has too few of them here
            assert sum(len(raw) for _, raw in parts) <= 1.7 * len(at)
        total = np.zeros(-(-size // jaccard._SKETCH_PART) * jaccard._SKETCH_PART, np.int32) if size < 1 << 22 else None
        for k, raw in parts if total is not None else ():
            jaccard._add_used(total[k * jaccard._SKETCH_PART:(k + 1) * jaccard._SKETCH_PART], raw)
        assert total is None or (total[at] == counts).all() and total.sum() == len(s)


def test_tables_follow_the_corpus(spark, monkeypatch):
    """Sketch and marks have room for the rows there are, whatever they begin with; links are the same."""
    ship(spark)
    tables, marks = [], []
    classes, marked = jaccard.frequency_classes, jaccard.marked
    monkeypatch.setattr(jaccard, "frequency_classes", lambda rows, size: tables.append(size) or classes(rows, size))
    monkeypatch.setattr(jaccard, "marked", lambda ids, p: marks.append(p.marks) or marked(ids, p))
    rows = _corpus(4, 60)
    _, want = _brute(rows)
    got = jaccard.near_duplicates(data.documents(spark, rows), jaccard.Params(sketch_bits=4, counter_bytes=2, marks=4)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())
    assert tables == [sum(len((r[1] or "").encode()) for r in rows) // 2]
    assert marks and all(1 << m >= 16 * len(rows) for m in marks)
