"""Licence scans with a generalised suffix automaton of licence templates.

The automaton holds every run of words of every template. Streaming a text through it gives, word
by word, the longest run ending there that some template contains (matching statistics). Runs
that cannot grow and are long enough are chained, per template and in template order, into
covered spans; a template is reported if enough of it is covered.

Defined results: a null or empty text has no words, no label and score 0; repeated rows give
repeated results; other columns than the id and the text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsework.llm.text import per_slice, plain_words

# Phrases and labels of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Public licence notices and opening grants.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
}


class Automaton:
    """Suffix automaton over several word sequences, with the places in each that a state stands for."""

    def __init__(self, texts: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        for number, words in enumerate(texts):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word, ends)
                ends[last].append((number, at))
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[state] > 0:
                ends[self.link[state]].extend(ends[state])
        self.ends = [sorted(set(e)) for e in ends]

    def _new(self, size: int, link: int, steps: dict[int, int], ends: list) -> int:
        self.next.append(steps)
        self.size.append(size)
        self.link.append(link)
        ends.append([])
        return len(self.size) - 1

    def _split(self, state: int, target: int, word: int, ends: list) -> int:
        """The state for the shorter runs of ``target`` alone."""
        copy = self._new(self.size[state] + 1, self.link[target], dict(self.next[target]), ends)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int, ends: list) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            return target if self.size[target] == self.size[last] + 1 else self._split(last, target, word, ends)
        new = self._new(self.size[last] + 1, 0, {}, ends)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][word]
            fits = self.size[target] == self.size[last] + 1
            self.link[new] = target if fits else self._split(last, target, word, ends)
        return new

    def statistics(self, words: list[int]) -> list[tuple[int, int]]:
        """For each word: length of the longest run ending there that a template has, and its state."""
        state, length, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append((length, state))
        return out


class Scanner:
    def __init__(self, templates: tuple, phrases: tuple, least_words: int, least_cover: float) -> None:
        self._labels = [label for label, texts in templates for _ in texts]
        sequences = [plain_words(text) for _, texts in templates for text in texts]
        self._ids = {w: i for i, w in enumerate(sorted({w for s in sequences for w in s}), 1)}
        self._sizes = [len(s) for s in sequences]
        self._automaton = Automaton([[self._ids[w] for w in s] for s in sequences])
        self._phrases = [(b" " + b" ".join(plain_words(p)) + b" ", label) for p, label in phrases]
        self._least_words, self._least_cover = least_words, least_cover

    def base(self, words: list[bytes]) -> list[tuple[int, str]]:
        """First word and label of every place of every phrase."""
        joined, found = b" " + b" ".join(words) + b" ", []
        for phrase, label in self._phrases:
            at, counted, word = joined.find(phrase), 0, 0
            while at >= 0:
                word += joined.count(b" ", counted, at)
                counted = at
                found.append((word, label))
                at = joined.find(phrase, at + 1)
        return found

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, end and covered share of each template found; one span per chain."""
        get = self._ids.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]])))
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for start, end in zip(known[::2].tolist(), known[1::2].tolist()):
            if end - start < self._least_words:
                continue
            run = self._automaton.statistics(ids[start:end].tolist())
            for i, (length, state) in enumerate(run):
                grows = i + 1 < len(run) and run[i + 1][0] > length
                if length >= self._least_words and not grows:
                    for number, at in self._automaton.ends[state]:
                        matches.setdefault(number, []).append((start + i + 1 - length, at + 1 - length, length))
        return sorted(span for number, found in matches.items() for span in self._chains(number, found))

    def _chains(self, number: int, found: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chain matches that follow each other in text and template, with bounded gaps between.

        A match goes to the first chain that it fits; one that fits none and lies inside a chain is
        dropped, any other begins a chain. Chains that ended a template's length ago are done, so each match meets few.
        """
        size, out = self._sizes[number], []
        chains: list[list[int]] = []  # first word, end, place in the template, covered words

        def done(chain: list[int]) -> None:
            if chain[3] >= self._least_cover * size:
                out.append((self._labels[number], chain[0], chain[1], min(1.0, chain[3] / size)))

        for start, other, more in sorted(found):
            still = []
            for chain in chains:
                if start - chain[1] <= size:
                    still.append(chain)
                else:
                    done(chain)
            chains = still
            for chain in chains:
                _, end, place, covered = chain
                cut = max(0, end - start, place - other)
                if cut < more and other + cut >= place and abs((start + cut - end) - (other + cut - place)) <= size // 4:
                    chain[1:] = [start + more, other + more, covered + more - cut]
                    break
                if start + more <= end:
                    break
            else:
                chains.append([start, start + more, other + more, more])
        for chain in chains:
            done(chain)
        return out


@lru_cache(maxsize=4)
def _scanner(templates: tuple, phrases: tuple, least_words: int, least_cover: float) -> Scanner:
    return Scanner(templates, phrases, least_words, least_cover)


def scan_licences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, list[str]] | None = None,
    phrases: dict[str, str] | None = None,
    least_words: int = 4,
    least_cover: float = 0.8,
) -> DataFrame:
    """Phrases and template spans of each whole text.

    ``n_base`` counts all places of phrases; ``first_word`` and ``last_word`` are their smallest
    and largest start. ``spans`` holds label, first word, end and covered share of each template
    of which at least ``least_cover`` is covered by runs of at least ``least_words`` words. ``score``
    is the largest share, or 1 if a phrase stands in the text without a span.
    """
    spec = (
        tuple((k, tuple(v)) for k, v in (TEMPLATES if templates is None else templates).items()),
        tuple((PHRASES if phrases is None else phrases).items()),
        least_words,
        least_cover,
    )
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])
    fields = [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span)),
    ]

    def one(text: str | None) -> tuple:
        scanner, words = _scanner(*spec), plain_words(text)
        base, spans = scanner.base(words), scanner.spans(words)
        starts, own = [s for s, _ in base], {label for _, label in base}
        score = max([share for *_, share in spans], default=1.0 if base else 0.0)
        labels = own | {s[0] for s in spans}
        return (
            len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
            ",".join(sorted(labels)), score, [dict(zip(("label", "first", "end", "share"), s)) for s in spans],
        )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [one(text) for text in batch.column(1).to_pylist()]
        columns = [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(fields)]
        return pa.record_batch([batch.column(0), *columns], [id_col, *(name for name, _ in fields)])

    return rows.mapInArrow(
        per_slice(work, text_col),
        f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_words long, n_base long, first_word long, "
        "last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first: long, end: long, share: double>>",
    )
