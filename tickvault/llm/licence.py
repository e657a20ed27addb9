"""Operator 7: licence scans with a generalised suffix automaton.

The automaton holds the words of all licence templates and phrases.  Texts are
streamed through it: after each word, its state and a length say what the
longest run of words ending here is that also stands in a template (matching
statistics).  Where such a run cannot be extended it is a match; long matches
in the same order as in the template, with small gaps, are chained, and a chain
that covers enough of the template's words labels its span.

Before that, words that are in no pair of neighbours of any template are found
with array operations; they reset the automaton, so only the stretches between
them are streamed word by word.

Edge cases: a null or empty text has no words and no spans; repeated rows are
scanned again; a text of any length is scanned whole, its matches being taken
in order, so memory follows the matches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickvault.llm.common import map_arrow, text_chunks
from tickvault.llm.tokens import grams, words_of

# Phrases with their labels, and licence notices as their authors word them.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
)

#: Fewest words of a match, most words between two matches of a chain, and the least part of a template that labels.
LEAST_MATCH, GAP, COVER = 4, 12, 0.6


def plain_words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@dataclass
class State:
    length: int = 0
    link: int = -1
    next: dict = field(default_factory=dict)
    ends: set = field(default_factory=set)  # (template, end) of all its occurrences
    phrases: list = field(default_factory=list)  # (phrase, words) that its longest run ends with


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, templates: list[list[str]], phrases: list[list[str]]):
        self.states = [State()]
        self.sizes = [len(t) for t in templates]
        for n, words in enumerate(templates + phrases):
            at = 0
            for i, w in enumerate(words):
                at = self._extend(at, w)
                if n < len(templates):
                    self.states[at].ends.add((n, i + 1))
        order = sorted(range(1, len(self.states)), key=lambda v: -self.states[v].length)
        for v in order:  # an occurrence of a run is one of its suffixes too
            if self.states[v].link > 0:
                self.states[self.states[v].link].ends |= self.states[v].ends
        own: dict[int, list] = {}
        for n, words in enumerate(phrases):
            at = 0
            for w in words:
                at = self.states[at].next[w]
            own.setdefault(at, []).append((n, len(words)))
        for v in reversed(order):
            self.states[v].phrases = own.get(v, []) + (self.states[self.states[v].link].phrases if self.states[v].link > 0 else [])

    def _extend(self, last: int, word: str) -> int:
        s = self.states
        if word in s[last].next:
            q = s[last].next[word]
            return q if s[q].length == s[last].length + 1 else self._clone(last, word, q)
        cur = len(s)
        s.append(State(s[last].length + 1))
        p = last
        while p >= 0 and word not in s[p].next:
            s[p].next[word] = cur
            p = s[p].link
        if p < 0:
            s[cur].link = 0
        else:
            q = s[p].next[word]
            s[cur].link = q if s[q].length == s[p].length + 1 else self._clone(p, word, q)
        return cur

    def _clone(self, p: int, word: str, q: int) -> int:
        s = self.states
        new = len(s)
        s.append(State(s[p].length + 1, s[q].link, dict(s[q].next), set()))
        s[q].link = new
        while p >= 0 and s[p].next.get(word) == q:
            s[p].next[word] = new
            p = s[p].link
        return new

    def stream(self, words, first: int, matches: list, hits: list) -> None:
        """words stand at first, first + 1, ...; adds (start, length, state) of
        matches and (phrase, start) of phrases."""
        s = self.states
        at = size = 0
        i = first
        for w in words:
            to = s[at].next.get(w)
            if to is None:
                if size >= LEAST_MATCH:
                    matches.append((i - size, size, at))
                while at > 0 and to is None:
                    at = s[at].link
                    size = s[at].length
                    to = s[at].next.get(w)
            if to is None:
                at = size = 0
            else:
                at, size = to, size + 1
                for n, length in s[at].phrases:
                    if length <= size:
                        hits.append((n, i - length + 1))
            i += 1
        if size >= LEAST_MATCH:
            matches.append((i - size, size, at))

    def chains(self, matches: list) -> list[tuple[int, int, int, float]]:
        """(template, start, stop, covered part) of chains of matches, which come by place."""
        running: dict[int, list] = {}
        out = []
        for start, size, state in matches:
            ends: dict[int, list] = {}
            for n, end in self.states[state].ends:
                ends.setdefault(n, []).append(end - size)
            for n, places in ends.items():
                c = running.get(n)  # start, stop, place reached in the template, words covered
                after = [p for p in places if c and p + size > c[2]]
                if c and start - c[1] <= GAP and after:
                    p = min(after)
                    c[3] += min(size, p + size - c[2])
                    c[1], c[2] = start + size, p + size
                else:
                    if c:
                        out.append((n, c[0], c[1], c[3] / self.sizes[n]))
                    running[n] = [start, start + size, min(places) + size, size]
        out += [(n, c[0], c[1], c[3] / self.sizes[n]) for n, c in running.items()]
        return sorted(out, key=lambda x: (x[1], x[0]))


def scan(docs: DataFrame, text: Column, keep: list[str], templates=TEMPLATES, phrases=PHRASES, cover: float = COVER) -> DataFrame:
    """The columns ``keep`` of docs, then n_words; phrases, an array of (label,
    start) of each place of a phrase; spans, an array of (label, start, stop,
    cover) of chains that cover enough; best, the largest part covered."""
    labels, names = [n for n, _ in templates], [n for _, n in phrases]
    sequences = [plain_words(t) for _, t in templates], [plain_words(p) for p, _ in phrases]
    added = ("n_words", "phrases", "spans", "best")
    rows = docs.select(*[F.col(f"`{c}`") for c in keep if c not in added], text.alias("__text"))

    def work(batches):
        automaton = Automaton(*sequences)
        pairs = set()
        for words in (*sequences[0], *sequences[1]):
            raw = np.frombuffer(" ".join(words).encode(), np.uint8)
            pairs |= set(grams(words_of(raw, np.array([0, len(raw)]), "alnum").hash, 2).tolist())
        known = np.array(sorted(pairs), np.uint64)
        place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("cover", pa.float64())]))
        for batch in batches:
            n = batch.num_rows
            count, hits, spans, best = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)], np.zeros(n)
            for lo, hi, raw, offsets in text_chunks(batch, "__text"):
                w = words_of(raw, offsets, "alnum")
                count[lo:hi] = np.diff(w.off)
                pair = grams(w.hash, 2)
                near = known[np.minimum(np.searchsorted(known, pair), len(known) - 1)] == pair
                near &= w.owner()[:-1] == w.owner()[1:] if len(pair) else near
                edge = np.flatnonzero(np.diff(np.concatenate([[0], near.astype(np.int8), [0]])))
                found: dict[int, tuple[list, list]] = {}
                for a, b in zip(edge[::2].tolist(), (edge[1::2] + 1).tolist()):
                    d = int(np.searchsorted(w.off, a, "right")) - 1
                    words = [raw[s:e].tobytes().decode("utf-8", "replace").lower() for s, e in zip(w.start[a:b], w.end[a:b])]
                    automaton.stream(words, a - int(w.off[d]), *found.setdefault(d, ([], [])))
                for d, (matches, places) in found.items():
                    hits[lo + d] = [{"label": names[k], "start": s} for k, s in sorted(places, key=lambda x: x[1])]
                    chains = automaton.chains(matches)
                    spans[lo + d] = [{"label": labels[k], "start": s, "stop": e, "cover": c} for k, s, e, c in chains if c >= cover]
                    best[lo + d] = min(1.0, max((c for *_, c in chains), default=0.0))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count), pa.array(hits, place), pa.array(spans, span), pa.array(best)], names=[*batch.schema.names[:-1], *added])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return map_arrow(rows, work, f"{schema}n_words long, phrases array<struct<label:string,start:long>>, spans array<struct<label:string,start:long,stop:long,cover:double>>, best double")
