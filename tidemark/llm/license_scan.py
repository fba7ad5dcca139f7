"""License scans: matching statistics from a suffix automaton of licence tokens.

A generalised suffix automaton holds every run of words of the template texts.
A text streams through it word by word; at each word it knows the longest run
ending there that stands in some template (the matching statistics).  Runs that
cannot be longer are chained, template by template, in the order of both text
and template with bounded gaps; the share of a template that a chain covers is
its coverage.  Every chain with a coverage of at least ``COVERED`` is a span and
gives the template's label; of chains that overlap the one that covers most, then
the first, is the span.  A run that does not extend a chain begins one beside it,
and a chain stays open for ``MOST_GAP`` words.

Words are maximal runs of ASCII digits and letters (A-Z lower-cased) and all
characters beyond ASCII.  Words of no template reset the automaton, so only
stretches of template words are walked.

Edge cases: a null or empty text has no words, no labels and score 0; rows are
scanned one by one, so repeated rows and null ids give a row each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

# The phrases and labels that every scan counts.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices as their licences word them.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    ("lgpl-3", "GNU Lesser General Public License, version 3"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

LEAST_RUN, MOST_GAP, COVERED = 3, 12, 0.75
_TABLE = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


class Automaton:
    """Generalised suffix automaton over word ids (from 1), with the places where each state's runs end."""

    def __init__(self, texts: Iterable[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for n, text in enumerate(texts):
            last = 0
            for place, word in enumerate(text):
                last = self._extend(last, word)
                self.ends[last].add((n, place))
        for state in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.ends[0] = set()

    def _new(self, size: int, link: int, onward: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(onward)
        self.ends.append(set())
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for just the runs that reach ``target`` through ``state``."""
        copy = self._new(self.size[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            return target if self.size[target] == self.size[last] + 1 else self._split(last, word, target)
        new = self._new(self.size[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.size[target] == self.size[state] + 1 else self._split(state, word, target)
        return new

    def statistics(self, ids: list[int]) -> list[tuple[int, int]]:
        """Of each word: the length of the longest run ending there, and its state."""
        out, state, size = [], 0, 0
        onward, link, longest = self.next, self.link, self.size
        for word in ids:
            while state and word not in onward[state]:
                state = link[state]
                size = longest[state]
            to = onward[state].get(word)
            if to is None:
                state = size = 0
            else:
                state, size = to, size + 1
            out.append((size, state))
        return out


class Scanner:
    def __init__(self, templates=None, phrases=None):
        templates, self.phrases = templates or TEMPLATES, phrases or PHRASES
        texts = [words(t.encode()) for _, t in templates] + [words(p.encode()) for p in self.phrases]
        self.labels = [label for label, _ in templates] + list(self.phrases.values())
        self.ids: dict[bytes, int] = {}
        coded = [[self.ids.setdefault(w, len(self.ids) + 1) for w in t] for t in texts]
        self.sizes = list(map(len, coded))
        self.sought = [(coded[len(templates) + i], label) for i, label in enumerate(self.phrases.values())]
        self.automaton = Automaton(coded)

    def scan(self, text: bytes | None) -> dict:
        found = words(text)
        get = self.ids.get
        ids = np.array([get(w, 0) for w in found], np.int32)
        places: list[tuple[int, str]] = []
        chains = Chains(self.sizes)
        known = np.concatenate([[False], ids > 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= LEAST_RUN:
                self._walk(ids[lo:hi].tolist(), lo, places, chains)
        spans = sorted({(lo, hi, self.labels[n], c) for n, c, lo, hi in chains.spans()})
        base_labels = {label for _, label in places}
        starts = [p for p, _ in places]
        return {
            "n_words": len(found),
            "n_base": len(places),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(base_labels | {s[2] for s in spans})),
            "score": 1.0 if places else chains.best,
            "spans": [{"label": label, "first": lo, "last": hi, "coverage": c} for lo, hi, label, c in spans],
        }

    def _walk(self, ids: list[int], offset: int, places: list, chains: Chains) -> None:
        statistics = self.automaton.statistics(ids)
        for i, (size, state) in enumerate(statistics):
            if size < LEAST_RUN:
                continue
            for phrase, label in self.sought:
                n = len(phrase)
                if size >= n and ids[i] == phrase[-1] and ids[i + 1 - n : i + 1] == phrase:
                    places.append((offset + i + 1 - n, label))
            if i + 1 == len(statistics) or statistics[i + 1][0] <= size:  # it cannot be longer
                for template, end in sorted(self.automaton.ends[state]):
                    chains.add(template, offset + i, size, end)


class Chains:
    """For each template the open chains of runs and all that covered enough, in one pass over the text."""

    def __init__(self, sizes: list[int]):
        self.sizes = sizes
        self.now: dict[int, list[tuple[int, int, int, int]]] = {}  # first word, last word, last place, covered
        self.best = 0.0
        self.full: dict[int, list[tuple[float, int, int]]] = {}

    def add(self, template: int, last: int, size: int, end: int) -> None:
        first = last + 1 - size
        # Chains whose gap is too wide are closed: later runs begin no earlier than this one.
        held = [c for c in self.now.get(template, ()) if first - c[1] <= MOST_GAP]
        made = [(first, size)]
        for start, text_end, place, had in held:
            gained = min(size, end - place)
            if last > text_end and gained > 0 and end - size - place <= MOST_GAP:
                # Words that overlap the chain, in text or template, count once.
                made.append((start, had + min(gained, last - text_end)))
        most = 0
        for start, covered in sorted(made, reverse=True):
            if covered > most:  # else a later start covers as much up to the same place
                most = covered
                held.append((start, last, end, covered))
                share = min(1.0, covered / self.sizes[template])
                self.best = max(self.best, share)
                if share >= COVERED:
                    self._keep(template, share, start, last)
        self.now[template] = held

    def _keep(self, template: int, share: float, first: int, last: int) -> None:
        """Chains end in text order, so only the last ones kept can overlap a new one; it takes the place of one, never of two."""
        full = self.full.setdefault(template, [])
        at = len(full)
        while at and full[at - 1][2] >= first:
            at -= 1
        if len(full) - at < 2 and all(share > c for c, *_ in full[at:]):
            full[at:] = [(share, first, last)]

    def spans(self) -> list[tuple[int, float, int, int]]:
        return [(template, *span) for template, full in self.full.items() for span in full]


def scanned(docs: DataFrame, templates=None) -> DataFrame:
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label:string,first:long,last:long,coverage:double>>"
    )
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("coverage", pa.float64())])
    types = {
        "n_words": pa.int64(),
        "n_base": pa.int64(),
        "first_word": pa.int64(),
        "last_word": pa.int64(),
        "base_labels": pa.string(),
        "labels": pa.string(),
        "score": pa.float64(),
        "spans": pa.list_(span),
    }

    def make():
        scanner = Scanner(templates)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[name] for r in rows], kind) for name, kind in types.items()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *types])

        return each

    return base.map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), make, schema)


def query(spark, folder: str) -> DataFrame:
    return scanned(base.read(spark, folder))
