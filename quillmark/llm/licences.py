"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds the words of all phrases and templates. A text's words stream through it
and give matching statistics: at each word the longest stretch ending there that some
template has. Words that no template has reset it at once. A phrase is found where its end
state is on the suffix path of the current state. For templates, long matches are chained in
template order into covered spans; a template that is covered enough gives its label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import small_batches

# The phrases whose places count, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Wordings of licence notices, with the labels that they give.
TEMPLATES = (
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsl", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("epl", "the accompanying materials are made available under the terms of the eclipse public license"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("odbl", "is made available under the open database license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced or transmitted in any form without permission"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
)
#: Words of the shortest match that is chained.
LONG = 4
#: Share of a template's words that its chain must cover.
COVERED = 0.8
#: Words of the text that may lie between two matches of a chain.
GAP = 8

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    """ASCII letters and digits and all other characters beyond ASCII make words; A-Z are lowered."""
    return _WORD.findall((text or "").encode("utf-8", "replace").lower())


class Automaton:
    """Generalised suffix automaton of word sequences, with their places."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._add(last, word)
                self.places[last].add((number, at))
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, p: int, word: bytes) -> int:
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, q)
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _add(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        self.link[new] = self._split(p, word) if p >= 0 else 0
        return new

    def matches(self, found: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(place, state, length) of the longest match that ends at each place that has one."""
        state = length = 0
        known, nexts = self.next[0], self.next
        for at, word in enumerate(found):
            if word not in known:
                state = length = 0
                continue
            while word not in nexts[state]:
                state = self.link[state]
                length = self.length[state]
            state = nexts[state][word]
            length += 1
            yield at, state, length


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: tuple[tuple[str, str], ...] = TEMPLATES):
        self.labels = [*phrases.values(), *(label for label, _ in templates)]
        self.sequences = [words(x) for x in (*phrases, *(t for _, t in templates))]
        self.phrases = len(phrases)
        self.automaton = Automaton(self.sequences)
        # The phrases that end in a state: those whose end state is on its suffix path.
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.automaton.link]
        for n, sequence in enumerate(self.sequences[: self.phrases]):
            state = 0
            for word in sequence:
                state = self.automaton.next[state][word]
            self.ending[state].append((n, len(sequence)))
        for state in sorted(range(1, len(self.ending)), key=lambda s: self.automaton.length[s]):
            self.ending[state] += self.ending[self.automaton.link[state]]

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, list[tuple[str, int, int, float]]]:
        """(words, places, first, last, labels of phrases, all labels, score, spans).

        A span is (label, first word, last word, share of the template that is covered). The
        score is the largest share of a template or phrase that the text covers, 0 to 1.
        """
        found = words(text)
        starts: list[int] = []
        base: set[str] = set()
        ends: list[tuple[int, int, int]] = []
        before: tuple[int, int, int] | None = None
        for at, state, length in self.automaton.matches(found):
            for n, size in self.ending[state]:
                if size <= length:
                    starts.append(at - size + 1)
                    base.add(self.labels[n])
            # A match that the next word prolongs is not the longest one.
            if before is not None and not (at == before[0] + 1 and length == before[2] + 1):
                ends.append(before)
            before = (at, state, length) if length >= LONG else None
        if before is not None:
            ends.append(before)
        spans = self._chains(ends)
        score = max([1.0 if base else 0.0, *(s[3] for s in spans)])
        own = {s[0] for s in spans if s[3] >= COVERED}
        return len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), score, spans

    def _chains(self, ends: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Matches of a template that follow each other in text and template, as covered spans."""
        open_: dict[int, list[int]] = {}
        done: list[tuple[str, int, int, float]] = []

        def close(n: int) -> None:
            first, last, _, got = open_.pop(n)
            done.append((self.labels[n], first, last, min(1.0, got / len(self.sequences[n]))))

        for at, state, length in ends:
            places: dict[int, list[int]] = {}
            for n, end in sorted(self.automaton.places[state]):
                if n >= self.phrases:
                    places.setdefault(n, []).append(end)
            for n, there in places.items():
                if n in open_:
                    _, last, upto, _ = open_[n]
                    on = [e for e in there if e > upto]
                    if on and at - length + 1 - last - 1 <= GAP:
                        new = min(length, at - last, on[0] - upto)
                        open_[n][1:] = [at, on[0], open_[n][3] + new]
                        continue
                    close(n)
                open_[n] = [at - length + 1, at, there[0], length]
        for n in list(open_):
            close(n)
        return done


ROWS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,last_word:long,covered:double>>"


def scanned(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text); other columns are not read. A row per row, see ROWS.

    A null text is an empty one: no words, no labels (empty strings), score 0. Without a
    place of a phrase first_word and last_word are null. Repeated rows come out as often.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for b in batches:
            rows = [scanner.scan(t.as_py()) for t in b.column(1)]
            cols = [[r[i] for r in rows] for i in range(8)]
            cols[7] = [[dict(zip(("label", "first_word", "last_word", "covered"), s, strict=True)) for s in r] for r in cols[7]]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROWS)
