"""BPE by distinct words against the tokenizer itself."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from offerframe.llm import catalog, wordcodes
from offerframe.llm.wordcodes import Params

from . import data

CODER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
HARD = ["a<|endoftext|>b <|startoftext|> c", "é x y\tz\x1cq  \n\n k̇", "ΑΣ ΣΑΣ İstanbul", " ́a",
        "don't  I'LL 123 4a!?", "a b c　d", "\U0001f600 漢字仮名 ไทย", "x" * 5000 + " y", "</w> a</w>b", "\x00 \x0b\x0c\r\n z"]


def want(text):
    ids = CODER.encode(text or "", add_special_tokens=False).ids
    return ids, CODER.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("block", [64, 8 << 20])
def test_awkward_texts_there_and_back(spark, block):
    rows = [(i, t, "en", "s") for i, t in enumerate(HARD)] + data.AWKWARD
    docs = data.documents(spark, rows).repartition(3)
    p = Params(block_bytes=block)
    encoded = wordcodes.encode(docs, p, keep=("doc_id", "text", "rank"))
    assert sorted(map(str, wordcodes.encode(docs, p, keep=()).collect())) == sorted(map(str, encoded.select("ids").collect()))
    decoded = wordcodes.decode(encoded.withColumnRenamed("text", "original"), p, keep=("doc_id", "original", "rank", "ids")).collect()
    assert len(decoded) == len(rows)
    assert sorted(str((r["doc_id"], r["original"])) for r in decoded) == sorted(str((i, t)) for i, t, *_ in rows)
    for r in decoded:
        ids, text = want(r["original"])
        assert r["ids"] == ids and r["text"] == text and r["rank"] == "x"


def test_empty_table_and_no_kept_columns(spark):
    encoded = wordcodes.encode(data.empty(spark))
    assert encoded.columns == ["doc_id", "ids"] and encoded.collect() == []
    assert wordcodes.decode(encoded).collect() == []


def test_any_id_lists_decode_as_the_tokenizer_does(spark):
    rng = np.random.default_rng(2)
    size = CODER.get_vocab_size()
    lists = [rng.integers(0, size, int(n)).tolist() for n in rng.integers(0, 60, 200)]
    lists += [None, [], [49407, 49406, 49407], [0] * 3000, [size + 5, 3], [-1], [-1, 320, size], [None, 320]]
    frame = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>").repartition(4)
    for r in wordcodes.decode(frame, Params()).collect():
        known = [i for i in lists[r["doc_id"]] or [] if i is not None and 0 <= i < size]
        assert r["text"] == CODER.decode(known, skip_special_tokens=False)


class Counting:
    """A tokenizer that notes the words it is asked for."""

    def __init__(self):
        self.seen = []

    def get_vocab_size(self, with_added_tokens):
        return CODER.get_vocab_size(with_added_tokens)

    def encode_batch_fast(self, words, add_special_tokens):
        self.seen += words
        return CODER.encode_batch_fast(words, add_special_tokens=add_special_tokens)


def test_a_word_is_encoded_once():
    heads = pa.RecordBatch.from_arrays([pa.array([1, 2])], names=["k0"])
    rows = [r for block in range(5) for b in wordcodes.block_rows(
        pa.array([f"the same words again {block}".encode(), b"the words"]), heads, block, 3) for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["bucket"], r["block"]))
    batches = [pa.RecordBatch.from_pylist(rows[a:a + 4], schema=wordcodes._ROW_TYPES) for a in range(0, len(rows), 4)]
    coder = Counting()
    out = [r for b in wordcodes.encode_words(iter(batches), coder) for r in b.to_pylist()]
    assert len(out) == len(rows)
    assert sorted(coder.seen) == sorted(["the", "same", "words", "again", "0", "1", "2", "3", "4"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50), st.lists(st.binary(max_size=30), max_size=6))
def test_packing_round_trip(numbers, parts):
    assert wordcodes.from_planes(wordcodes.planes(np.array(numbers, np.int64))).tolist() == numbers
    assert wordcodes.unpack(wordcodes.pack(*parts)) == parts


def test_query_equals_the_tokenizer(spark):
    sf = "/root/testdata/sf0.001"
    import hashlib
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = catalog.op13_bpe(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids, text = want(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
