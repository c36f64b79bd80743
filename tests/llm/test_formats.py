"""WARC packages, chat formatting and license scans: round trips and brute force."""

import base64
import gzip
import hashlib
import re
import textwrap
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offerframe.llm import catalog, chat, licenses, warczip
from offerframe.llm.common import ship
from offerframe.session import shared_dir

from . import data

# --- WARC -------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/\r\nX: y", "<p>one</p>"), (4, "u", None), (5, "u", ""),
         (6, "http://ç/é", "ünï\n\x00 PK\x05\x06 \r\n\r\n"), (7, "u", "x" * 300_000), (7, "u", "other payload"), (8, "u", "same"),
         (8, "u", "same"), (None, "u", "<p>one</p>"), (None, "u", "alone")]


def _warc_rows(pages, least=0):
    best = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= least:
            best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in pages:
        raw = (h or "").encode()
        keep = best.get(h or "", i)
        revisit = keep is not None and keep != i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response",
                    keep if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("params", [warczip.Params(), warczip.Params(member_bytes=200, range_bytes=300),
                                    warczip.Params(zip64=False, least_payload=5)])
def test_warc_round_trip(spark, params):
    ship(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha", F.lit("x")).withColumn("n", F.lit(1))
    got = warczip.through_archives(pages, params).collect()
    assert sorted((tuple(r) for r in got), key=str) == _warc_rows(PAGES, params.least_payload)


def test_archives_are_plain_zip_files(spark, tmp_path):
    ship(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    warczip.write_archives(pages, f"file://{tmp_path}/out", warczip.Params(member_bytes=500))
    records = 0
    for file in (tmp_path / "out").glob("part-*"):
        with zipfile.ZipFile(file) as z:
            assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            for name in z.namelist():
                if name.startswith("archive/"):
                    records += gzip.decompress(z.read(name)).count(b"WARC/1.1\r\n")
    assert records == len(PAGES)


def test_no_pages_no_archives(spark):
    ship(spark)
    assert warczip.through_archives(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_directory_of_foreign_zip64_and_faults(tmp_path):
    file = tmp_path / "a.zip"
    with zipfile.ZipFile(file, "w") as z:
        for i in range(300):
            z.writestr(f"m{i}", str(i))
        z.comment = b"a comment with PK\x05\x06 in it"
    ranges = warczip.Ranges(f"file://{file}")
    members = warczip.directory(ranges)
    assert len(members) == 300
    at, size = members["m17"]
    assert ranges.read(warczip.data_start(ranges, at), size) == b"17"
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("m", "x" * 100)
    with pytest.raises(ValueError, match="not stored"):
        warczip.directory(warczip.Ranges(f"file://{tmp_path}/b.zip"))
    (tmp_path / "c.zip").write_bytes(b"PK\x05\x06" + b"x" * 40)
    with pytest.raises(ValueError, match="no end record"):
        warczip.directory(warczip.Ranges(f"file://{tmp_path}/c.zip"))


def test_changed_payload_is_noticed():
    raw = warczip.record(1, "u", b"payload", warczip.digest_of(b"payload"), None, False)
    assert warczip.parse_record(raw)[:2] == (1, 7)
    with pytest.raises(ValueError, match="digest"):
        warczip.parse_record(raw.replace(b"payload\r\n", b"Payload\r\n"))


# --- chat -------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\#</>turnA: é漢\n", max_size=40))
def test_escaping_is_reversible_and_hides_control_strings(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    plain = re.sub(r"\\.", "~", out, flags=re.DOTALL)
    assert "###" not in plain and "</" not in plain


TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "### User:\n </turn> \\ ok <|endoftext|>"), (1, 2, "assistant", None),
         (2, 0, "tool ### x", "é 漢字 😀\x00"), (2, None, None, "no role"), (2, 1, "system", ""), (3, 5, "assistant", data.LONG),
         (None, 0, "user", "lost"), (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "user", "other")]


def _turn_rows(turns):
    convs = {}
    for c, t, r, x in turns:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).hexdigest(), x or ""))
    out = []
    for c, rows in convs.items():
        rows.sort()
        own = "".join(x for *_, r, _, x in rows if r == "assistant")
        out.append((c, len(rows), hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, _, x in rows).encode()).hexdigest(), len(own),
                    hashlib.sha256(own.encode()).hexdigest()))
    return sorted(out, key=str)


def test_chat_round_trip(spark):
    ship(spark)
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("x"))
    got = chat.read_back(chat.format_conversations(turns.repartition(4))).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == _turn_rows(TURNS)
    none = chat.read_back(chat.format_conversations(turns.limit(0)))
    assert none.count() == 0


def test_chat_markers_are_reserved_ids_and_rendering_is_the_template(spark):
    ship(spark)
    code = chat.coder("byte_bpe_50k.json")
    turns = spark.createDataFrame(TURNS[:3], "conv_id long, turn long, role string, text string")
    segments = sorted(chat.format_conversations(turns).collect(), key=lambda r: r["position"])
    ids = np.concatenate([np.frombuffer(r["ids"], "<i4") for r in segments])
    mask = np.concatenate([np.frombuffer(r["mask"], np.uint8) for r in segments])
    assert (ids >= code.first).sum() == 6  # two markers a turn, none from a text
    shown, at = "", 0
    for i in np.append(np.flatnonzero(ids >= code.first), len(ids)):
        shown += code.decode(ids[at:i]) + (chat.MARKERS[ids[i] - code.first] if i < len(ids) else "")
        at = i + 1
    assert shown == ("### User:\nhi </turn>\n### Assistant:\n\\#\\#\\# User:\n \\</turn> \\\\ ok <|endoftext|> </turn>\n"
                     "### Assistant:\n </turn>\n")
    assert chat.unescape(code.decode(ids[mask.astype(bool)])) == TURNS[1][3]
    r = chat.read_back(chat.format_conversations(turns)).first()
    assert r["formatted_chars"] == len(shown) and r["n_ids"] == len(ids)


def test_planted_conversation(spark):
    got = catalog.op9_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = catalog.PLANTED_TURN
    assert text == "\\### Assistant: </turn> ok"
    assert got["n_turns"] == 2 and got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- licenses ---------------------------------------------------------------------------

def _license_rows(texts, p):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for text in texts:
        text = (text or "").translate(low)
        words = word.findall(text)
        base = sorted((i, label) for phrase, label in p.phrases for q in [phrase.split()]
                      for i in range(len(words) - len(q) + 1) if words[i:i + len(q)] == q)
        found, at, step = set(), 0, p.window // 2
        for line in text.split("\n"):
            own = word.findall(line)
            blocks = [(0, len(own))] if len(own) <= p.window else [(s, min(s + p.window, len(own))) for s in range(0, len(own), step)]
            for s, e in blocks:
                for k, (label, template) in enumerate(p.templates):
                    t = set(licenses.words_of(template))
                    if 100 * len(t & set(own[s:e])) >= p.percent * len(t):
                        found.add((label, k, at + s, at + e - 1))
            at += len(own)
        out.append((len(words), base, found))
    return out


def test_license_scan_matches_brute_force(spark):
    ship(spark)
    notice = licenses.TEMPLATES[1][1]
    texts = [t for _, t, *_ in data.AWKWARD] + [
        "the MIT\nLicense mit-license GENERAL public LICENSE x", "Apache licenses apache license", "é mit license ß", notice,
        "w " * 200 + notice + " w" * 300 + "\n" + notice[:200], " ".join(notice.split()[::-1]), "all all rights " * 100 + "reserved"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit("x")).repartition(3)
    for p in (licenses.Params(), licenses.Params(percent=60, window=16)):
        want = _license_rows(texts, p)
        got = licenses.scan_licenses(docs, p).collect()
        assert len(got) == len(texts)
        for r in got:
            n, base, found = want[r["doc_id"]]
            assert (r["n_words"], r["n_base"]) == (n, len(base))
            assert (r["first_word"], r["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
            assert r["base_labels"] == ",".join(sorted({label for _, label in base}))
            assert {(m["label"], m["template"], m["first_word"], m["last_word"]) for m in r["matches"]} == found
            assert set(filter(None, r["labels"].split(","))) == {label for _, label in base} | {f[0] for f in found}
            assert 0 <= r["score"] <= 1
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_wrapped_and_long_notices_match_brute_force(spark):
    ship(spark)
    long = ("long", " ".join(f"clause{i}" for i in range(300)))
    p = licenses.Params(templates=(*licenses.TEMPLATES, long))
    filler = " ".join(f"filler{i}" for i in range(130))
    texts = [f"{filler}\n{textwrap.fill(t, 70 if len(t) > 70 else 12)}\n{filler}" for _, t in p.templates]
    texts += [f"{filler} {long[1]} {filler}", f"{filler} {long[1]}", textwrap.fill(filler, 70), "All\n" + filler + " rights\nreserved"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs, p).collect()}
    for i, text in enumerate(texts):
        words, found = licenses.words_of(text), set()
        for k, (label, template) in enumerate(p.templates):  # every passage of a template's length, line feeds or not
            own, n = set(licenses.words_of(template)), len(licenses.words_of(template))
            if any(100 * len(own & set(words[s:s + n])) >= p.percent * len(own) for s in range(max(1, len(words) - n + 1))):
                found.add((label, k))
        r = got[i]
        every = r["matches"] + r["passages"]
        assert found <= {(m["label"], m["template"]) for m in every}
        assert {label for label, _ in found} <= set(r["all_labels"].split(","))
        assert r["best_score"] == max((m["containment"] for m in every), default=0.5 if r["n_base"] else 0.0)
        if i < len(p.templates):
            span = (130, 130 + len(licenses.words_of(p.templates[i][1])) - 1)
            assert (i, *span, 1.0) in {(m["template"], m["first_word"], m["last_word"], m["containment"]) for m in every}
    assert [got[len(p.templates) + k]["all_labels"] for k in range(4)] == ["long", "long", "", ""]


def test_word_frequencies_count_all_documents(spark):
    ship(spark)
    v = licenses.Vocabulary(licenses.Params())
    docs = spark.createDataFrame([(i, "MIT mit license") for i in range(50)] + [(99, None)], "doc_id long, text string").repartition(4)
    got = dict(zip(v.words, licenses.word_frequencies(docs, v).tolist()))
    assert (got["mit"], got["license"], got["apache"]) == (100, 50, 0)


def test_shared_dir_is_used(spark):
    assert shared_dir(spark, "warc") != shared_dir(spark, "warc")
