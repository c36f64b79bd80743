"""License scans by an exact set-similarity join.

Templates (texts with a label) are joined to text blocks by containment: block
B matches template T when at least `percent` % of T's distinct words are in B.
A block is a line; a longer line is cut to overlapping windows of `window`
words, so any passage of half a window lies whole in one of them.

Notices are usually wrapped, and a template may be longer than half a window.
So each template is also joined to passages of the whole text's word sequence,
line feeds or not: windows of twice the template's words, one every template's
length, so any passage of the template's length lies whole in one of them,
however long the template.  A passage is cut to its first and last template
word; those inside a line's matching block of the same template are no news.

All tokens have one global order, rare first, by their frequency over all
documents (one counting scan; only template words need counting, as no other
word can be in an overlap).  Then, with need = ceil(percent |T| / 100):

* prefix filter: a match holds one of T's |T| - need + 1 rarest words, so only
  blocks with such a word are looked at at all;
* length filter: a block with fewer than `need` template words is out;
* positional filter: the first shared word, at place i of T and j of B (both
  in global order), leaves at most 1 + min(|T| - i - 1, |B| - j - 1) shared.

What is left is verified exactly.  The filters lose no match.

Beside that, places where a fixed phrase's words stand consecutively are
found exactly; they give the base labels.

Defined results: NULL text counts as empty; a document without words has no
labels and score 0; NULL ids and repeated rows are scanned like others.
Columns other than id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import id_text, lean, text_slices

# Phrases of the base and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Well-known license notices.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("reserved", "All rights reserved"),
)


@dataclass(frozen=True)
class Params:
    templates: tuple = TEMPLATES
    phrases: tuple = PHRASES
    percent: int = 90         # containment threshold, in hundredths
    window: int = 256         # words of a window of a long line


def words_of(text: str) -> list[str]:
    data = tv.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = tv.word_spans(data, np.array([0, len(data)]), tv.ALNUM)
    return [data[s:e].tobytes().decode() for s, e in zip(starts, ends)]


def hash_words(words: list[str]) -> np.ndarray:
    return np.array([tv.ByteHash(np.frombuffer(w.encode(), np.uint8)).of(np.array([0]), np.array([len(w.encode())]))[0]
                     for w in words], np.uint64)


class Vocabulary:
    """Words of templates and phrases, found among hashed words by binary search."""

    def __init__(self, p: Params):
        words = sorted({w for _, t in p.templates for w in words_of(t)} | {w for t, _ in p.phrases for w in words_of(t)})
        hashes = hash_words(words)
        order = np.argsort(hashes)
        self.words, self.hashes = [words[i] for i in order], hashes[order]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1).astype(np.int32)

    def of(self, text: str) -> np.ndarray:
        return self.ids(hash_words(words_of(text)))


def _words(data: np.ndarray, offs: np.ndarray):
    low = tv.LOWER[data]
    starts, ends, first = tv.word_spans(low, offs, tv.ALNUM)
    return starts, first, tv.ByteHash(low).of(starts, ends)


def word_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Occurrences of every template word in all documents."""
    def count(batches):
        total = np.zeros(len(vocabulary.hashes), np.int64)
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column("text")):
                ids = vocabulary.ids(_words(data, offs)[2])
                total += np.bincount(ids[ids >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["word", "n"])

    found = (docs.select("text").mapInArrow(lean(count), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")))
    out = np.zeros(len(vocabulary.hashes), np.int64)
    for r in found.toLocalIterator():  # one row per template word
        out[r["word"]] = r["n"]
    return out


class Matcher:
    """Templates prepared for the join: their words by place in the global order."""

    def __init__(self, p: Params, vocabulary: Vocabulary, frequencies: np.ndarray):
        self.p, self.vocabulary = p, vocabulary
        order = np.lexsort((np.arange(len(frequencies)), frequencies))
        self.place = np.empty(len(order), np.int64)   # rare words first
        self.place[order] = np.arange(len(order))
        self.templates, self.lengths, self.starters = [], [], {}
        for k, (label, text) in enumerate(p.templates):
            own = np.unique(self.place[vocabulary.of(text)])
            need = -(-p.percent * len(own) // 100)
            self.templates.append((label, own, need))
            self.lengths.append(len(words_of(text)))
            for place in own[:len(own) - need + 1].tolist():
                self.starters.setdefault(place, []).append(k)
        self.is_starter = np.zeros(len(order) + 1, bool)
        self.is_starter[vocabulary_numbers(self.place, self.starters)] = True
        self.phrases = [(vocabulary.of(text), label) for text, label in p.phrases]

    def blocks(self, line_first: int, line_last: int, word: int):
        """Windows of the line [line_first, line_last) that hold `word`."""
        step = self.p.window // 2
        if line_last - line_first <= self.p.window:
            return [(line_first, line_last)]
        k = (word - line_first) // step
        starts = {max(0, k - 1) * step, k * step}
        return [(line_first + s, min(line_first + s + self.p.window, line_last)) for s in sorted(starts)]

    def slice(self, data: np.ndarray, offs: np.ndarray):
        """Per text: (words, base places and labels, matches, passages); both are (label, template, first, last, containment)."""
        starts, first, hashes = _words(data, offs)
        ids = self.vocabulary.ids(hashes)
        n = len(offs) - 1
        base: list[list] = [[] for _ in range(n)]
        matches: list[dict] = [{} for _ in range(n)]
        passages: list[set] = [set() for _ in range(n)]
        text_of = lambda w: int(np.searchsorted(first, w, side="right")) - 1
        for phrase, label in self.phrases:
            hit = ids[:max(0, len(ids) - len(phrase) + 1)] == phrase[0]
            for k in range(1, len(phrase)):
                hit &= ids[k:k + len(hit)] == phrase[k]
            for w in np.flatnonzero(hit).tolist():
                t = text_of(w)
                if w + len(phrase) <= first[t + 1]:
                    base[t].append((w - int(first[t]), label))
        lines = np.flatnonzero(data == 10)
        seen = set()
        for w in np.flatnonzero(self.is_starter[ids]).tolist():
            t = text_of(w)
            at = int(np.searchsorted(lines, starts[w]))
            line_first = max(int(first[t]), int(np.searchsorted(starts, lines[at - 1])) if at else 0)
            line_last = min(int(first[t + 1]), int(np.searchsorted(starts, lines[at])) if at < len(lines) else len(starts))
            for block in self.blocks(line_first, line_last, w):
                for k in self.starters[int(self.place[ids[w]])]:
                    if (block, k) not in seen:
                        seen.add((block, k))
                        share = self.containment(ids[block[0]:block[1]], k)
                        if share:
                            label = self.templates[k][0]
                            got = (label, k, block[0] - int(first[t]), block[1] - 1 - int(first[t]), share)
                            if share > matches[t].get((k, block[0]), got[:4] + (0,))[4]:
                                matches[t][(k, block[0])] = got
            for k in self.starters[int(self.place[ids[w]])]:
                for block in self.windows(int(first[t]), int(first[t + 1]), w, self.lengths[k]):
                    if (block, k, "text") not in seen:
                        seen.add((block, k, "text"))
                        got = self.passage(ids, block, k, int(first[t]))
                        if got:
                            passages[t].add(got)
        counts = np.diff(first).tolist()
        out = []
        for t in range(n):
            found = sorted(matches[t].values())
            spans: dict[int, list] = {}
            for m in found:
                spans.setdefault(m[1], []).append((m[2], m[3]))
            news = sorted(g for g in passages[t] if not any(a <= g[2] and g[3] <= b for a, b in spans.get(g[1], ())))
            out.append((counts[t], base[t], found, news))
        return out

    @staticmethod
    def windows(first: int, last: int, word: int, length: int):
        """Windows of twice `length` words of the text [first, last), one every `length`, that hold `word`."""
        k = (word - first) // length
        return [(first + s * length, min(first + (s + 2) * length, last)) for s in ({max(0, k - 1), k})]

    def passage(self, ids: np.ndarray, block: tuple, k: int, text: int):
        """Match of template k in a window, cut to its first and last template word, or None."""
        share = self.containment(ids[block[0]:block[1]], k)
        if not share:
            return None
        label, own, _ = self.templates[k]
        some = ids[block[0]:block[1]]
        at = np.flatnonzero((some >= 0) & np.isin(self.place[some], own))
        return label, k, block[0] - text + int(at[0]), block[0] - text + int(at[-1]), share

    def containment(self, ids: np.ndarray, k: int) -> float:
        """Share of template k's words in a block, 0 below the threshold."""
        _, own, need = self.templates[k]
        block = np.unique(self.place[ids[ids >= 0]])
        if len(block) < need:                                     # length filter
            return 0.0
        _, i, j = np.intersect1d(own, block, assume_unique=True, return_indices=True)
        if 1 + min(len(own) - i[0] - 1, len(block) - j[0] - 1) < need:  # positional filter
            return 0.0
        return len(i) / len(own) if len(i) >= need else 0.0


def vocabulary_numbers(place: np.ndarray, places) -> list[int]:
    """Vocabulary numbers of places in the global order."""
    number = np.argsort(place)
    return [int(number[x]) for x in places]


_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                               ("last_word", pa.int64()), ("containment", pa.float64())]))
_TYPES = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("matches", _MATCHES), ("passages", _MATCHES), ("all_labels", pa.string()), ("best_score", pa.float64())])
_DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<label: string, template: int, first_word: long, last_word: long, containment: double>>, "
        "passages array<struct<label: string, template: int, first_word: long, last_word: long, containment: double>>, "
        "all_labels string, best_score double")


def scan_licenses(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, base places and labels, all labels, score, and every matching block with its containment.

    score is the best containment of a matching block, else 0.5 where a base phrase stands, else 0.
    `matches`, `labels` and `score` are those of single lines; `passages` are the matches that no line
    holds, and `all_labels` and `best_score` are over both.
    """
    rows = id_text(docs, id_col, text_col)
    vocabulary = Vocabulary(params)
    matcher = Matcher(params, vocabulary, word_frequencies(rows, vocabulary))  # a few KB: sized by the templates

    def run(batches):
        for batch in batches:
            out = []
            for a, _, data, offs in text_slices(batch.column("text")):
                for n, base, matches, passages in matcher.slice(data, offs):
                    places = [w for w, _ in base]
                    labels = {label for _, label in base}
                    every = labels | {m[0] for m in matches}
                    out.append((n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
                                ",".join(sorted(every)), max((m[4] for m in matches), default=0.5 if base else 0.0),
                                *([dict(zip(("label", "template", "first_word", "last_word", "containment"), m)) for m in some]
                                  for some in (matches, passages)),
                                ",".join(sorted(every | {m[0] for m in passages})),
                                max((m[4] for m in matches + passages), default=0.5 if base else 0.0)))
            columns = list(zip(*out)) if out else [[] for _ in range(len(_TYPES) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, f.type) for c, f in zip(columns, list(_TYPES)[1:])], schema=_TYPES)

    return rows.mapInArrow(lean(run), _DDL)
