"""Licence scanning with a generalised suffix automaton over the words of templates.

The automaton accepts every run of words of every template and knows in which templates,
and where, the run ends.  A text is streamed through it: at each word the state holds the
longest run of template words that ends there (the matching statistic).  Runs that cannot
be made longer are matches; per template the matches that go on in the template are
chained, and the share of the template they cover is its score.  Short phrases are
templates of their own, found wherever a run ends with all their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.words import words

# Phrases and the labels they give.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Characteristic passages of public licences, quoted from their texts.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


@dataclass(frozen=True)
class Params:
    """A match needs ``least_words``; a template whose words are covered by ``coverage`` or more gives its label.

    Matches of a template chain when the second starts after the first, in the text and
    in the template, with at most ``gap_words`` words of the text between.
    """

    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))
    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    least_words: int = 4
    coverage: float = 0.6
    gap_words: int = 12


class Automaton:
    """Suffix automaton of several word sequences, built one after the other from the start state."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first_end = [-1], [0], [-1]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, place) of prefixes ending in the state

    def _state(self, like: int | None, length: int) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _clone(self, state: int, via: int, length: int, symbol: int) -> int:
        copy = self._state(state, length)
        self.link[state] = copy
        while via >= 0 and self.next[via].get(symbol) == state:
            self.next[via][symbol] = copy
            via = self.link[via]
        return copy

    def add(self, sequence: int, symbols: list[int]) -> None:
        last = 0
        for place, symbol in enumerate(symbols):
            last = self._extend(last, symbol)
            self.ends[last].append((sequence, place))

    def _extend(self, last: int, symbol: int) -> int:
        known = self.next[last].get(symbol)
        if known is not None:
            # The run is there from an earlier sequence.
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(known, last, self.length[last] + 1, symbol)
        state = self._state(None, self.length[last] + 1)
        via = last
        while via >= 0 and symbol not in self.next[via]:
            self.next[via][symbol] = state
            via = self.link[via]
        if via >= 0:
            met = self.next[via][symbol]
            same = self.length[met] == self.length[via] + 1
            self.link[state] = met if same else self._clone(met, via, self.length[via] + 1, symbol)
        return state

    def finish(self) -> None:
        """Hand the ends of each state on to the shorter runs that end there too."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]].extend(self.ends[state])
        self.ends = [sorted(set(e)) for e in self.ends]

    def stream(self, symbols: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run ending at each symbol (-1 is in no template)."""
        state = length = 0
        for symbol in symbols:
            if symbol < 0:
                state = length = 0
            else:
                while state and symbol not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                to = self.next[state].get(symbol)
                if to is not None:
                    state, length = to, length + 1
            yield state, length


class Scanner:
    """The automaton of a set of templates and phrases, and how texts are read with it."""

    def __init__(self, params: Params) -> None:
        self.params = params
        self.ids: dict[bytes, int] = {}
        self.automaton = Automaton()
        self.sequences = [("template", label, words(t.encode())) for label, t in sorted(params.templates.items())]
        self.sequences += [("phrase", label, words(p.encode())) for p, label in sorted(params.phrases.items())]
        for number, (_, _, sequence) in enumerate(self.sequences):
            self.automaton.add(number, [self.ids.setdefault(w, len(self.ids)) for w in sequence])
        self.automaton.finish()
        self.sizes = [len(s) for _, _, s in self.sequences]
        # Per state the phrases that a run of at least their length ends with.
        self.phrase_ends = [
            [s for s, place in ends if self.sequences[s][0] == "phrase" and place == self.sizes[s] - 1] for ends in self.automaton.ends
        ]

    def scan(self, text: bytes | None) -> dict:
        """``n_words, phrases`` (start, label), ``spans`` (label, first word, end, coverage) and ``score``."""
        found = words(text)
        get = self.ids.get
        symbols = [get(w, -1) for w in found]
        known = np.array(symbols, np.int64) >= 0
        edges = np.flatnonzero(np.diff(np.r_[False, known, False]))
        phrases: list[tuple[int, str]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        # Words of no template end every run, so each stretch of known words is read alone.
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin > 1:
                self._read(symbols[begin:end], begin, phrases, matches)
        spans = [s for number, some in matches.items() for s in self._chains(number, some)]
        return {"n_words": len(found), "phrases": phrases, "spans": spans, "score": max((s[3] for s in spans), default=0.0)}

    def _read(self, symbols: list[int], offset: int, phrases: list, matches: dict) -> None:
        states = list(self.automaton.stream(symbols))
        for at, (state, length) in enumerate(states):
            # A state's ends reach its shorter runs; a phrase counts if the run is as long.
            while state > 0:
                for s in self.phrase_ends[state]:
                    if self.automaton.length[self.automaton.link[state]] < self.sizes[s] <= length:
                        phrases.append((offset + at - self.sizes[s] + 1, self.sequences[s][1]))
                state = self.automaton.link[state]
                length = self.automaton.length[state]
        for at, (state, length) in enumerate(states):
            goes_on = at + 1 < len(states) and states[at + 1][1] == length + 1
            if length >= self.params.least_words and not goes_on:
                for s, place in self.automaton.ends[state]:
                    if self.sequences[s][0] == "template":
                        matches.setdefault(s, []).append((offset + at + 1 - length, place + 1 - length, length))

    def _chains(self, number: int, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Spans of the text in which chained matches cover enough of a template."""
        out = []
        chains: list[list[tuple[int, int, int]]] = []
        for match in sorted(matches):
            begin, place, length = match
            for chain in reversed(chains):
                b, p, n = chain[-1]
                if begin - (b + n) > self.params.gap_words:
                    continue
                if begin >= b and place > p and begin + length > b + n:
                    chain.append(match)
                    break
            else:
                chains.append([match])
            if len(chains) > 64:  # those out of reach are closed
                chains, closed = [], chains
                for chain in closed:
                    b, _, n = chain[-1]
                    (chains if begin - (b + n) <= self.params.gap_words else out).append(chain)
        out += chains
        label = self.sequences[number][1]
        spans = []
        for chain in out:
            covered = np.zeros(self.sizes[number], bool)
            for _, place, length in chain:
                covered[place : place + length] = True
            share = float(covered.mean())
            if share >= self.params.coverage:
                spans.append((label, chain[0][0], chain[-1][0] + chain[-1][2], share))
        return spans


def _scanned(params: Params, spans: bool):
    kind = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    if spans:
        kind += ", spans array<struct<label string, begin long, end long, coverage double>>"

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(params)
        for texts in parts:
            rows = []
            for text in texts:
                r = scanner.scan(text)
                starts = [s for s, _ in r["phrases"]]
                base = {label for _, label in r["phrases"]}
                row = {
                    "n_words": r["n_words"],
                    "n_base": len(starts),
                    "first_word": min(starts, default=None),
                    "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)),
                    "labels": ",".join(sorted(base | {s[0] for s in r["spans"]})),
                    "score": r["score"],
                }
                if spans:
                    row["spans"] = [dict(zip(("label", "begin", "end", "coverage"), s, strict=True)) for s in sorted(r["spans"], key=lambda s: s[1:])]
                rows.append(row)
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")[:7]] + ["spans"] * spans)
            for c in ("first_word", "last_word"):
                frame[c] = frame[c].astype("Int64")
            yield frame

    return F.pandas_udf(run, kind)


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params = Params(), spans: bool = False) -> DataFrame:
    """Licence phrases and templates in every whole text.

    ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``: words
    as in ``words``; ``n_base`` counts all places of the phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start, null if there is none;
    ``base_labels`` come from phrases, ``labels`` from templates too, both distinct,
    sorted by code point and joined by commas, empty if there is none; ``score`` is the
    largest share of a template covered, 0 if below the least.  With ``spans`` the spans
    themselves follow, in words.

    Defined cases: a null or empty text has no words; a null doc_id is kept; repeated rows
    come out as often; an empty table gives no rows; other columns are not looked at.
    """
    scanned = _scanned(params, spans)(F.col(text).cast("string").cast("binary"))
    out = documents.select(F.col(doc_id).alias("doc_id"), scanned.alias("s"))
    return out.select("doc_id", "s.*")
