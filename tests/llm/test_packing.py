"""Packing: the plan, token ids, and whole packings of awkward rows."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerframe.llm import packing
from offerframe.llm.common import ship

from . import data


@settings(max_examples=150, deadline=None)
@given(st.integers(4, 50), st.data())
def test_plan_places_every_piece_once_and_gapless(capacity, draw):
    histogram = draw.draw(st.dictionaries(st.integers(1, capacity), st.integers(0, 40), max_size=15))
    rows, sequences = packing.plan(dict(histogram), capacity)
    filled, ranks = {}, {}
    for length, rank, first, count, per, offset in rows.tolist():
        assert ranks.get(length, 0) == rank
        ranks[length] = rank + count * per
        for s in range(first, first + count):
            assert filled.get(s, 0) == offset
            filled[s] = offset + per * length
    assert ranks == {k: v for k, v in histogram.items() if v}
    assert len(filled) == sequences and all(v <= capacity for v in filled.values())


def test_large_pieces_pair_at_most_twice_and_best():
    rows, sequences = packing.plan({60: 3, 55: 1, 45: 2, 40: 3, 36: 1}, 100)
    assert sequences == 5
    twice = {}
    for length, _, first, count, per, _ in rows.tolist():
        for s in range(first, first + count):
            twice[s] = twice.get(s, 0) + per
    assert max(twice.values()) == 2


def test_plan_is_near_the_lower_bound():
    rng = np.random.default_rng(0)
    lengths = np.minimum(4096, rng.lognormal(6, 1.2, 20_000).astype(int) + 1)
    histogram = dict(zip(*(a.tolist() for a in np.unique(lengths, return_counts=True))))
    _, sequences = packing.plan(histogram, 4096)
    assert sequences <= 1.01 * lengths.sum() / 4096 + 1


def test_word_coder_equals_the_tokenizer():
    coder = packing.WordCoder("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t for _, t, *_ in data.AWKWARD if t] + [
        "a<|endoftext|>b c", "é x y\tz\x1cq  \n\n k̇", "ΑΣ ΣΑΣ İstanbul", " ́a", "don't  I'LL 123 4a!?", "ÀÉß,, Ñandú.!? a--b x-"]
    for text in texts:
        assert np.frombuffer(coder.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tokenizers_are_known_by_their_contents(tmp_path):
    """Another tokenizer under the known name, and the known one under another name."""
    for source, apart in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        path = f"{tmp_path}/{'word_bpe_49k.json' if not apart else 'other.json'}"
        tokenizer = Tokenizer.from_file(public_tokenizers.path(source))
        tokenizer.save(path)
        coder = packing.WordCoder(path)
        assert coder.apart is apart
        for text in ("Two  words, and\nmore", " leading", ""):
            assert np.frombuffer(coder.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_remembered_is_bounded_and_right():
    memory = packing.Remembered(lambda k: k * 2, 5)
    assert [memory[i % 13] for i in range(200)] == [(i % 13) * 2 for i in range(200)]
    assert len(memory) <= 5 and len(memory.old) <= 5


def test_pack_awkward_rows(spark):
    ship(spark)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.pack(data.documents(spark)).collect()
    want = []
    for doc_id, text, *_ in data.AWKWARD:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(doc_id, k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))
                 for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted(tuple(r)[:5] for r in got if r["doc_id"] is not None) == sorted(w for w in want if w[0] is not None)
    assert len(got) == len(want)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(data.empty(spark)).count() == 0


def test_pack_returns_ids_on_request(spark):
    ship(spark)
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    r = packing.pack(docs, packing.Params(keep_ids=True)).first()
    assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]


def test_kept_ids_are_those_of_the_row(spark):
    """A doc_id that repeats with different texts, and NULL ids: every piece has its own ids."""
    ship(spark)
    rows = [(1, "alpha beta gamma"), (1, "other words stand here"), (1, "other words stand here"), (None, "no id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    plain = packing.pack(docs, packing.Params(capacity=3)).collect()
    got = packing.pack(docs, packing.Params(capacity=3, keep_ids=True)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["piece"], r["ids_crc32"])
    assert sorted(map(key, got)) == sorted(map(key, plain))
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
