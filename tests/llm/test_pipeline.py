"""Corpus pipeline: every stage against a brute-force version; contract of the entry points."""

import inspect
import re

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as E
from offerframe.llm import mixing, quality
from offerframe.llm.common import fold_of, ship, table

from .test_dedup import _brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    ship(spark)
    docs = table(spark, SF, "documents")
    before, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, before, SF).write.parquet(path)
        seen[name] = before = spark.read.parquet(path)
        if name != "pack_sequences":
            assert set(before.columns) == set(COLUMNS)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())

    good = seen["quality_filter"]
    scores = quality.score_quality(docs, table(spark, SF, "labels"), usable=fold_of("doc_id", 5) != 0)
    assert ids(good) == ids(scores.where("score >= 0.3"))
    best = {}
    for r in good.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"] or ""), r["doc_id"]))
    assert ids(seen["exact_dedup"]) == sorted(i for _, i in best.values())
    rows = [(r["doc_id"], r["text"]) for r in seen["exact_dedup"].collect()]
    assert ids(seen["near_dedup"]) == sorted(set(_brute(rows)[1].values()))
    chosen = mixing.mix(seen["near_dedup"], mixing.Params(max_epochs=1))
    assert ids(seen["mix_sources"]) == ids(chosen)
    packed = seen["pack_sequences"]
    assert {r["doc_id"] for r in packed.collect()} == set(ids(seen["mix_sources"]))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096


def test_run_equals_its_stages_and_accepts_no_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, table(spark, SF, "documents").limit(0), SF).count() == 0, name


LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))


def _awkward(spark):
    """NULL and repeated ids (also in another leaf), empty and long texts, columns whose names operators use."""
    words = [" ".join(f"{c}{k}" for k in range(12)) for c in "abcdefgh"]
    rows = [(i, words[i], "en", "src1") for i in range(6)]
    rows += [(2, words[6], "de", "src2"), (3, words[3], "en", "src1"), (None, words[7], "en", None), (None, words[7] + " more", None, "src1"),
             (None, "", "en", "src1"), (None, None, None, None), (9, " \t", "en", "src1"), (10, LONG, "en", "src1"), (11, LONG + " end", "en", "src2")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("kept", "row", "component_id", "rank", "length", "a", "block", "_chosen"):
        docs = docs.withColumn(c, F.lit("x"))
    return docs, rows


def test_stages_on_awkward_rows_and_empty_tables(spark):
    ship(spark)
    docs, rows = _awkward(spark)
    labels = table(spark, SF, "labels")
    key = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"])
    every = sorted(map(str, [r[:4] for r in rows]))
    out = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES}
    for name in ("quality_filter", "exact_dedup", "near_dedup", "mix_sources"):
        assert out[name].columns == docs.columns, name
        got = sorted(str(key(r)) for r in out[name].collect())
        assert all(got.count(g) <= every.count(g) for g in got), name
        out[name] = got
    stripped = {re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows}
    assert len(out["exact_dedup"]) == len(stripped)
    assert len([r for r in out["near_dedup"] if r.startswith("(None")]) == 4  # rows without an id link with nothing
    assert not any("x11" in r and "end" in r for r in out["near_dedup"])        # the longer near copy goes
    assert not any(re.search(r"'(\\t| )*',|None, (None|'en'), (None|'src1')\)$", r) and "'" not in r.split(",")[1] for r in out["mix_sources"])
    assert all("word" in r or re.search("[a-h]0 ", r) for r in out["mix_sources"])  # no row without tokens
    packed = out["pack_sequences"].collect()
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed) >= len(rows)
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
    assert labels.count() > 0


def test_mixture_returns_only_what_was_chosen(spark):
    docs, rows = _awkward(spark)
    for budget in (0.3, 1.0):
        p = mixing.Params(max_epochs=1, budget=budget)
        chosen = mixing.mix(docs, p).collect()
        got = mixing.mixed(docs, p).collect()
        leaf = lambda r: str((r["doc_id"], r["lang"] or "", r["source"] or ""))
        assert sorted(map(leaf, got)) == sorted(map(leaf, chosen)) and all((r["text"] or "").strip() for r in got)


def test_every_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(re.match(rf"op{n}_", q) for q in names) for n in range(1, 14))
    assert set(E.oracle_sql()) <= names


def test_guard_for_the_subpackage_is_in_the_entry_alone():
    assert "except" not in inspect.getsource(corpus_pipeline)
