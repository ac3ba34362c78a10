"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of every licence template.  A text's
words are streamed through it: the state after each word tells the longest run
ending there that some template contains (the matching statistics).  Runs that
cannot be extended become anchors; anchors of one template in the same order
in text and template, a few words apart, are chained.  A chain that covers
enough of a template is a span of that licence.

Words that no template contains reset the automaton, so only stretches of
known words are streamed; these are found for a whole text at once.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import field, map_text

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, text): notices and opening clauses of common licences.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "this project is licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "licensed under the gnu general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
    ("epl", "the accompanying program is provided under the terms of this eclipse public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced or transmitted in any form without permission"),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # of UTF-8 with A-Z lower-cased
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
#: Words of an anchor, words that two anchors may be apart, share of a template
#: to be covered, and bytes of a text that are split into words at once.
ANCHOR, APART, COVERED, PART = 3, 8, 0.8, 1 << 22


class Automaton:
    """Generalised suffix automaton over sequences of word ids."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]  # (sequence, end) of a state's runs
        for number, sequence in enumerate(sequences):
            last = 0
            for position, symbol in enumerate(sequence, 1):
                last = self._extend(last, symbol)
                self.ends[last].add((number, position))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, state: int, target: int, symbol: int) -> int:
        """The state for the run of ``state`` and ``symbol``, apart from longer
        runs that ``target`` holds as well."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = copy
        while state >= 0 and self.step[state].get(symbol) == target:
            self.step[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            return self._split(last, self.step[last][symbol], symbol)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, self.step[at][symbol], symbol)
        return new

    def stream(self, symbols) -> list[tuple[int, int]]:
        """Matching statistics: (state, run length) after each symbol."""
        state, length, out = 0, 0, []
        for symbol in symbols:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            target = self.step[state].get(symbol)
            state, length = (target, length + 1) if target is not None else (0, 0)
            out.append((state, length))
        return out


class _Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Scanner:
    """Templates, base phrases and their automaton."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES) -> None:
        texts = [(label, text.split(), False) for label, text in templates]
        texts += [(label, phrase.split(), True) for phrase, label in phrases.items()]
        words = sorted({w for _, t, _ in texts for w in t})
        self.ids = _Vocabulary((w.encode(), i) for i, w in enumerate(words))
        self.labels = [label for label, _, _ in texts]
        self.lengths = [len(t) for _, t, _ in texts]
        self.base = {k for k, (_, _, is_base) in enumerate(texts) if is_base}
        self.automaton = Automaton([[self.ids[w.encode()] for w in t] for _, t, _ in texts])
        self.shortest = min(ANCHOR, *(self.lengths[k] for k in self.base))

    def words(self, data: bytes) -> np.ndarray:
        """Vocabulary ids of a text's words (-1: in no template)."""
        low, parts, at = data.lower(), [], 0
        while at < len(low):
            gap = _GAP.search(low, min(len(low), at + PART))
            stop = gap.start() if gap else len(low)
            found = WORD.findall(low, at, stop)
            parts.append(np.fromiter(map(self.ids.__getitem__, found), np.int32, len(found)))
            at = stop
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def scan(self, words: np.ndarray) -> tuple[list[tuple[int, int]], list[dict]]:
        """Base places (start, template), and spans of chained templates."""
        known = np.flatnonzero(np.diff(np.concatenate([[0], words >= 0, [0]]).astype(np.int8)))
        base: list[tuple[int, int]] = []
        anchors: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for start, stop in known.reshape(-1, 2):
            if stop - start < self.shortest:
                continue
            found = self.automaton.stream(words[start:stop].tolist())
            for k, (state, length) in enumerate(found):
                if length < self.shortest:
                    continue
                end = int(start) + k + 1
                extended = k + 1 < len(found) and found[k + 1][1] == length + 1
                for template, position in self.automaton.ends[state]:
                    if template in self.base:
                        if position == self.lengths[template] and length >= position:
                            base.append((end - position, template))
                    elif not extended and length >= ANCHOR and position >= length:
                        anchors[template].append((end - length, position - length, length))
                if length > self.automaton.length[self.automaton.link[state]]:
                    base += self._shorter(self.automaton.link[state], end)
        spans = [span for template, found in sorted(anchors.items()) for span in self._chains(template, found)]
        return sorted(set(base)), sorted(spans, key=lambda s: (s["first_word"], s["label"]))

    def _shorter(self, state: int, end: int) -> list[tuple[int, int]]:
        """Base phrases that end a run as shorter suffixes of it."""
        out = []
        while state > 0:
            for template, position in self.automaton.ends[state]:
                if template in self.base and position == self.lengths[template] <= self.automaton.length[state]:
                    out.append((end - position, template))
            state = self.automaton.link[state]
        return out

    def _chains(self, template: int, anchors: list[tuple[int, int, int]]) -> list[dict]:
        """Best chains of anchors (text start, template start, length)."""
        anchors = sorted(set(anchors))
        best: list[tuple[int, int]] = []  # (covered words, first anchor)
        for i, (at, place, length) in enumerate(anchors):
            score = (length, i)
            for j in range(i - 1, -1, -1):
                before, earlier, size = anchors[j]
                if at - (before + size) > APART + max(self.lengths):
                    break
                if 0 <= at - (before + size) <= APART and place >= earlier + size:
                    score = max(score, (best[j][0] + length, best[j][1]))
            best.append(score)
        spans = []
        used: list[tuple[int, int]] = []  # disjoint, in order
        for i in sorted(range(len(anchors)), key=lambda i: (-best[i][0], i)):
            covered, first = best[i]
            start, stop = anchors[first][0], anchors[i][0] + anchors[i][2]
            if covered < COVERED * self.lengths[template]:
                break  # the chains to come cover no more
            at = bisect_left(used, (start, stop))
            if (at and used[at - 1][1] > start) or (at < len(used) and used[at][0] < stop):
                continue
            used.insert(at, (start, stop))
            spans.append({
                "label": self.labels[template], "first_word": start, "end_word": stop,
                "covered": covered / self.lengths[template],
            })
        return spans


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_words, base_places (start, label) and spans (label,
    first_word, end_word, covered) to every row.

    Null and empty texts have no words.  Equal rows get equal results; columns
    with these names are replaced.
    """

    def make():
        scanner = Scanner()

        def compute(part: pa.RecordBatch) -> list:
            sizes, places, spans = [], [], []
            for data in part.column("__data").to_pylist():
                words = scanner.words(data or b"")
                found, chained = scanner.scan(words)
                sizes.append(len(words))
                places.append([{"start": s, "label": scanner.labels[t]} for s, t in found])
                spans.append(chained)
            return [sizes, places, spans]

        return compute

    fields = [
        field("n_words", "long"),
        field("base_places", "array<struct<start:bigint,label:string>>"),
        field("spans", "array<struct<label:string,first_word:bigint,end_word:bigint,covered:double>>"),
    ]
    held = docs.withColumn("__data", F.col(text).cast("binary"))
    return map_text(held, fields, make, "__data", drop=["__data"])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score: the largest share of a template (a base phrase: all) covered."""
    found = scan(docs.select("doc_id", "text")).drop("text")
    base, method = F.col("base_places.label"), F.col("spans.label")
    one = F.when(F.size("base_places") > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places.start").alias("first_word"),
        F.array_max("base_places.start").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, method)), ",").alias("labels"),
        F.greatest(one, F.coalesce(F.array_max("spans.covered"), F.lit(0.0))).alias("score"),
    )
