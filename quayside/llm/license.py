"""License scans by an exact set-similarity join with license templates.

Words: A-Z lower-cased, runs of characters other than the ASCII characters that
are neither digit nor letter. A text block is a line, or a paragraph (the lines
between lines without words). A block meets a template if it holds
``threshold`` of the template's distinct words. In a block of more than
``longest`` times as many distinct words as the template, a run of that many
consecutive words has to hold them: a notice inside a long line, or in a text
without newlines, is found there, and words scattered over it are no notice.
Without ``inside`` (a parameter; the query sets it) such long blocks are left.

Filters, none of which loses a match: distinct template words are ordered by
their frequency in the whole table, rarest first. A block that holds
k = ceil(threshold * n) of a template's n words holds one of its first
n - k + 1 (prefix filter): texts without any prefix word of any template are
left at once, and blocks look templates up through an inverted index of prefix
words. The first prefix word found at position i leaves n - i words at most
(positional filter); blocks of fewer than k distinct words can't match (length
filter). What is left is compared, every run of a long block by one pass over
its words.

The templates are a fixed set (below) or the caller's, and broadcast in the
closure; the frequencies are those of template words only. Documents are read
twice and never shuffled.

Base: places where a phrase's words stand consecutively. Score: the greatest
containment among matched blocks; 1 with a base phrase; else 0.

Defined cases: a null text is empty: no words, no place, null first and last
word, empty labels, score 0. Repeated rows get a row each.
"""

from __future__ import annotations

import math
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, map_texts, quoted, small_batches
from .decontam import words_of

THRESHOLD, LONGEST = 0.8, 4

# The phrases of the base and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short public license notices, and their labels.
TEMPLATES = [
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
             "Lesser General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License"),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights"),
    ("proprietary", "All rights reserved."),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


class Templates:
    """Templates as ordered word sets with an inverted index of their prefixes."""

    def __init__(self, templates, threshold: float, longest: float, freq: dict[bytes, int], inside: bool = False):
        self.items, self.index, self.inside = [], {}, inside
        for label, text in templates:
            words = sorted(set(words_of(text.encode())), key=lambda w: (freq.get(w, 0), w))
            need = math.ceil(threshold * len(words) - 1e-9)
            t = len(self.items)
            self.items.append((label, words, frozenset(words), need, longest * len(words)))
            for i, w in enumerate(words[:len(words) - need + 1]):
                self.index.setdefault(w, []).append((t, i))
        self.prefixes = frozenset(self.index)

    def matches(self, body: list[bytes]) -> dict[str, float]:
        """Label -> containment of the templates that a block meets."""
        block = set(body)
        seen: dict[int, int] = {}
        for w in block & self.prefixes:
            for t, i in self.index[w]:
                seen[t] = min(i, seen.get(t, i))
        out: dict[str, float] = {}
        for t, i in seen.items():
            label, words, whole, need, most = self.items[t]
            if len(words) - i >= need and need <= len(block) and (self.inside or len(block) <= most):
                got = len(whole & block)
                if got >= need and len(block) > most:
                    got = most_in_a_run(body, whole, int(most))
                if got >= need:
                    out[label] = max(out.get(label, 0.0), got / len(words))
        return out


def most_in_a_run(body: list[bytes], words: frozenset, width: int) -> int:
    """The most distinct ``words`` that ``width`` consecutive words of ``body`` hold."""
    held: dict[bytes, int] = {}
    run: deque[tuple[int, bytes]] = deque()
    best = 0
    for i, w in enumerate(body):
        if w in words:
            run.append((i, w))
            held[w] = held.get(w, 0) + 1
            while run[0][0] <= i - width:
                _, old = run.popleft()
                held[old] -= 1
                if not held[old]:
                    del held[old]
            best = max(best, len(held))
    return best


def _blocks(lines: list[bytes]):
    """Words of the lines, and of paragraphs of several lines."""
    para: list[list[bytes]] = []
    for line in [*lines, b""]:
        words = words_of(line)
        if words:
            para.append(words)
            yield words
            continue
        if len(para) > 1:
            yield [w for ws in para for w in ws]
        para = []


def word_frequencies(docs: DataFrame, text: str, words: frozenset) -> dict[bytes, int]:
    """Occurrences of the given words in the whole table (one row per word)."""
    small_batches(docs.sparkSession)
    src = docs.select(quoted(text).cast("binary").alias("body"))

    def run(batches):
        n = dict.fromkeys(words, 0)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                for w in filter(words.__contains__, words_of(body)):
                    n[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                         names=["word", "n"])
    return {bytes(r[0]): r[1] for r in src.mapInArrow(run, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")).collect()}


def places(words: list[bytes], phrases: list[tuple[list[bytes], str]]):
    """(start, label) of every consecutive occurrence of a phrase."""
    rest = [(p[0], p, label) for p, label in phrases]
    have = set(words)
    for first, p, label in rest:
        if have.issuperset(p):
            at = -1
            for _ in range(words.count(first)):
                at = words.index(first, at + 1)
                if words[at:at + len(p)] == p:
                    yield at, label


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None, threshold: float = THRESHOLD,
         longest: float = LONGEST, phrases=None, inside: bool = False) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    chosen = TEMPLATES if templates is None else templates
    base = [(words_of(k.encode()), v) for k, v in (PHRASES if phrases is None else phrases).items()]
    vocabulary = frozenset(w for _, t in chosen for w in words_of(t.encode()))
    index = Templates(chosen, threshold, longest, word_frequencies(docs, text, vocabulary), inside)

    def make():
        def kernel(texts):
            n_words, n_base, first, last, labels, every, score = [], [], [], [], [], [], []
            for t in texts:
                words = words_of(t)
                at = sorted(places(words, base))
                own = {label for _, label in at}
                met: dict[str, float] = {}
                if not index.prefixes.isdisjoint(words):
                    for block in _blocks(t.split(b"\n")):
                        for label, x in index.matches(block).items():
                            met[label] = max(met.get(label, 0.0), x)
                n_words.append(len(words))
                n_base.append(len(at))
                first.append(at[0][0] if at else None)
                last.append(at[-1][0] if at else None)
                labels.append(",".join(sorted(own)))
                every.append(",".join(sorted(own | set(met))))
                score.append(1.0 if own else max(met.values(), default=0.0))
            return [n_words, n_base, first, last, labels, every, score]
        return kernel
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = ["long", "long", "long", "long", "string", "string", "double"]
    return map_texts(docs, text, [doc_id], [field(n, k) for n, k in zip(names, kinds, strict=True)], make).toDF(
        "doc_id", *names)
