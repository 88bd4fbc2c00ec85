"""Licence texts found by matching statistics on a generalised suffix automaton of licence words."""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import query, table

# Phrases that name a licence.
PHRASES = {
    "gpl": ["gnu general public license"],
    "apache": ["apache license"],
    "cc-by": ["cc by"],
    "mit": ["mit license"],
}
# Public notices by which works are put under a licence.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at",
        "Licensed under the Apache License, Version 2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "This work is licensed under the GNU General Public License, version 3",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions",
        "Released under the MIT License",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
#: Words of a match that takes part in a chain, words of the text a chain may skip, and share of a template that gives its label.
MIN_MATCH, MAX_GAP, MIN_COVER = 4, 16, 0.8

_WORD_BYTES = (string.ascii_lowercase + string.digits).encode() + bytes(range(128, 256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _WORD_BYTES else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased: runs of 0-9, a-z and everything beyond ASCII."""
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of several word sequences; each state stands for the substrings that end at the same places."""

    def __init__(self, sequences: Sequence[Sequence[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: For each state, the place where its substrings end first in each sequence.
        self.ends: list[dict[int, int]] = [{}]
        paths = []
        for sequence in sequences:
            last, path = 0, []
            for word in sequence:
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                path.append(last)
            paths.append(path)
        for number, path in enumerate(paths):
            for end, state in enumerate(path):
                while state > 0 and number not in self.ends[state]:
                    self.ends[state][number] = end
                    state = self.link[state]

    def _state(self, length: int, next: dict[int, int], link: int) -> int:
        self.next.append(next)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The state for substrings of q that are no longer than p and one word."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        state, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return state


class LicenseScanner:
    def __init__(self, phrases: Mapping[str, Sequence[str]], templates: Mapping[str, Sequence[str]],
                 min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        named = [(label, words(t.encode())) for group in (phrases, templates) for label, texts in group.items() for t in texts]
        self.n_phrases = sum(map(len, phrases.values()))
        self.labels = [label for label, _ in named]
        self.sizes = [len(w) for _, w in named]
        self.automaton = a = SuffixAutomaton([w for _, w in named])
        #: Phrases and templates that may end where a state's match ends, by state: those of the state and of its suffixes.
        own: dict[int, list[int]] = {}
        for number, (_, sequence) in enumerate(named):
            state = 0
            for word in sequence:
                state = a.next[state][a.vocabulary[word]]
            own.setdefault(state, []).append(number)
        self.wholes_at: list[list[int]] = []
        for state in range(len(a.next)):
            found, s = [], state
            while s > 0:
                found += own.get(s, [])
                s = a.link[s]
            self.wholes_at.append(found)

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, list[str], list[tuple[str, int, int, float]], float]:
        """n_words, n_base, first_word, last_word, base_labels, spans (label, first word, last word, covered share), score."""
        a, tokens = self.automaton, words(text)
        nexts, links, lengths, wholes_at = a.next, a.link, a.length, self.wholes_at
        state = length = 0
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []
        wholes: set[tuple[str, int, int, float]] = set()
        for i, c in enumerate(map(a.vocabulary.get, tokens)):
            if c is None:
                if length >= self.min_match:
                    matches.append((i - 1, length, state))
                state = length = 0
                continue
            if c not in nexts[state]:
                if length >= self.min_match:
                    matches.append((i - 1, length, state))
                while state and c not in nexts[state]:
                    state = links[state]
                    length = lengths[state]
            if c in nexts[state]:
                state = nexts[state][c]
                length += 1
                for number in wholes_at[state]:
                    if length >= self.sizes[number]:
                        start = i - self.sizes[number] + 1
                        if number < self.n_phrases:
                            places.append((start, number))
                        else:
                            wholes.add((self.labels[number], start, i, 1.0))
        if length >= self.min_match:
            matches.append((len(tokens) - 1, length, state))
        spans, best = self._chains(matches, wholes)
        starts = [s for s, _ in places]
        return (len(tokens), len(places), min(starts, default=None), max(starts, default=None),
                sorted({self.labels[n] for _, n in places}), spans, 1.0 if places else best)

    def _chains(self, matches: list[tuple[int, int, int]], wholes: set[tuple[str, int, int, float]]) -> tuple[list[tuple[str, int, int, float]], float]:
        """Matches, in text order, linked where they go on in the same template within `max_gap` words of the text.

        `wholes` are spans of templates that stand whole, also inside a longer match of another; a chain of a
        template with the bounds of one is that one.
        """
        open_chains: dict[int, list[int]] = {}  # template: first word, last word, last template word, words covered
        done = set(wholes)
        best = 1.0 if wholes else 0.0

        def close(number: int) -> None:
            nonlocal best
            first, last, _, covered = open_chains.pop(number)
            share = covered / self.sizes[number]
            best = max(best, share)
            if share >= self.min_cover:
                done.add((self.labels[number], first, last, share))

        for end, length, state in matches:
            for number, place in self.automaton.ends[state].items():
                if number < self.n_phrases:
                    continue
                chain = open_chains.get(number)
                if chain and place > chain[2] and end - length - chain[1] <= self.max_gap:
                    chain[3] += min(length, end - chain[1], place - chain[2])
                    chain[1], chain[2] = end, place
                else:
                    if chain:
                        close(number)
                    open_chains[number] = [end - length + 1, end, place, length]
        for number in list(open_chains):
            close(number)
        return sorted(done, key=lambda s: (s[1], s[2], s[0])), min(best, 1.0)


_COLUMNS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
            "spans array<struct<label:string,first_word:long,last_word:long,covered:double>>")


def scan_licenses(df: DataFrame, id: str, text: str, phrases: Mapping[str, Sequence[str]] = PHRASES,
                  templates: Mapping[str, Sequence[str]] = TEMPLATES, **limits) -> DataFrame:
    """id and, for every row: n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base labels come from phrases, wherever their words stand in a row; they are read off the automaton
    as suffixes of the longest match that ends at a word. spans are chains of long matches that cover a template to
    `min_cover` or more, and templates that stand whole; their labels join the base labels. score is 1 with a phrase, else the largest
    share of a template that one chain covers. A text is read word by word, once, with a state and the
    length of its match; the automaton is built from the templates in each task. A null, empty or
    wordless text has no places (null words, empty labels, score 0). Rows are judged each by itself.
    """
    id_type = df.schema[id].dataType.simpleString()
    schema = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                        ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct(
                            [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(phrases, templates, **limits)
        for batch in batches:
            rows = []
            for value in batch.column(1).cast(pa.large_binary()):
                n, n_base, first, last, base, spans, score = scanner.scan(value.as_py() or b"")
                labels = ",".join(sorted({*base, *(s[0] for s in spans)}))
                rows.append((n, n_base, first, last, ",".join(base), labels, score, [dict(zip(("label", "first_word", "last_word", "covered"), s)) for s in spans]))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *schema.names])

    found = df.select(F.col(id).alias("id"), F.col(text)).mapInArrow(scan, f"id {id_type}, {_COLUMNS}")
    return found.withColumnRenamed("id", id)


@query("op3_license_scan")
def op3_license_scan(spark, sf):
    """Licence phrases and notices in every document."""
    return scan_licenses(table(spark, sf, "documents"), "doc_id", "text")
