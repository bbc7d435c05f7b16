"""Licence notices by matching statistics against a suffix automaton of licence templates.

The token sequences of all templates go into one generalised suffix automaton. A text is streamed through
it: after each word the automaton's state and match length give the longest stretch ending there that is
also a stretch of a template. Long stretches of one template that follow each other are chained, and the
share of the template that a chain covers is its score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.llm.words import text_bytes, values

# Phrases whose places are counted, and the labels they give.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wording of public licence notices, by label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation "
            "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation either version 3 of the license or at your "
            "option any later version"),
    ("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

SHORTEST = 4
GAP = 8
COVERED = 0.6

_SIGNS = bytearray(range(256))
for _c in range(128):
    if not (48 <= _c <= 57 or 97 <= _c <= 122):
        _SIGNS[_c] = _c + 32 if 65 <= _c <= 90 else 32
_SIGNS = bytes(_SIGNS)


def licence_words(text: str | None) -> list[bytes]:
    """Words of the lower-cased text: letters a-z, digits and all characters beyond ASCII."""
    return text_bytes(text).translate(_SIGNS).split()


class Automaton:
    """Generalised suffix automaton over tokens; each state knows where its stretches end in the templates."""

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for t, tokens in enumerate(templates):
            last = 0
            for k, token in enumerate(tokens):
                last = self._extend(last, token)
                self.ends[last].add((t, k + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _new(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, token: int, target: int) -> int:
        clone = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, token: int) -> int:
        target = self.next[last].get(token)
        if target is not None:  # the stretch is known from an earlier template
            return target if self.length[target] == self.length[last] + 1 else self._split(last, token, target)
        new = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][token]
            exact = self.length[target] == self.length[state] + 1
            self.link[new] = target if exact else self._split(state, token, target)
        return new

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """State and match length after each token."""
        state = size = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if token in self.next[state]:
                state, size = self.next[state][token], size + 1
            yield state, size


class Scanner:
    """Templates, their automaton, and scanning of one text after another."""

    def __init__(self, templates=TEMPLATES):
        texts = [text.encode().split() for _, text in templates]
        self.labels = [label for label, _ in templates]
        self.ids = {w: k + 1 for k, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        self.sizes = [len(t) for t in texts]
        self.automaton = Automaton([[self.ids[w] for w in t] for t in texts])
        self.phrases = [(tuple(p.encode().split()), label) for p, label in PHRASES]

    def base(self, parts: list[bytes]) -> tuple[list[int], set[str]]:
        """Start of every phrase, and the labels."""
        starts, labels = [], set()
        if b"license" in parts:
            at = -1
            while True:
                try:
                    at = parts.index(b"license", at + 1)
                except ValueError:
                    break
                for phrase, label in self.phrases:
                    k = at - len(phrase) + 1
                    if k >= 0 and tuple(parts[k : at + 1]) == phrase:
                        starts.append(k)
                        labels.add(label)
        return sorted(starts), labels

    def stretches(self, parts: list[bytes]) -> dict[int, list[tuple[int, int, int]]]:
        """Per template the longest matches: (start in text, start in template, length)."""
        get = self.ids.get
        tokens = [get(w, 0) for w in parts]
        found: dict[int, list[tuple[int, int, int]]] = {}
        at, n = 0, len(tokens)
        known = bytes(1 if t else 0 for t in tokens)
        shortest = b"\1" * SHORTEST
        while (at := known.find(shortest, at)) >= 0:
            stop = known.find(b"\0", at)
            stop = n if stop < 0 else stop
            before: tuple[int, int, int] | None = None
            for k, (state, size) in enumerate(self.automaton.statistics(tokens[at:stop] + [0]), at):
                # a match that does not grow has ended at the word before
                if before and size <= before[1] and before[1] >= SHORTEST:
                    for t, end in self.automaton.ends[before[0]]:
                        found.setdefault(t, []).append((before[2] - before[1] + 1, end - before[1], before[1]))
                before = (state, size, k)
            at = stop
        return found

    def coverage(self, parts: list[bytes]) -> dict[str, float]:
        """Best covered share per label over chains of matches that advance in text and template."""
        best: dict[str, float] = {}
        for t, matches in self.stretches(parts).items():
            chains: list[list[int]] = []  # end in text, end in template, covered words, start of the last match
            far = GAP + self.sizes[t] // 4
            for start, place, size in sorted(matches):
                covered, chosen = size, None
                for chain in reversed(chains):
                    if start - chain[3] > far + self.sizes[t]:
                        break  # a match is no longer than the template, so all chains before end too far back
                    gap = start - chain[0]
                    if 0 <= gap <= far and place >= chain[1] and chain[2] + size > covered:
                        covered, chosen = chain[2] + size, chain
                chains.append([start + size, place + size, covered, start])
                label = self.labels[t]
                best[label] = max(best.get(label, 0.0), covered / self.sizes[t])
        return best

    def scan(self, text: str | None) -> tuple:
        parts = licence_words(text)
        starts, base = self.base(parts)
        covered = self.coverage(parts)
        labels = base | {label for label, share in covered.items() if share >= COVERED}
        return (
            len(parts), len(starts), starts[0] if starts else None, starts[-1] if starts else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), min(1.0, max(covered.values(), default=0.0)),
        )


@lru_cache(maxsize=1)
def default_scanner() -> Scanner:
    return Scanner()


def _scan(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = default_scanner()
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for batch in stream:
        rows = [scanner.scan(t) for t in values(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]], names=["doc_id", *names]
        )


def licence_scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: words, places of the base phrases, base labels, all labels, best covered share of a template.

    A null text is empty; repeated rows repeat; other columns are ignored.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _scan,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    )
