"""Licence phrases and template spans in texts, by a generalised suffix automaton.

The automaton holds all substrings of the tokenised licence templates. A text is
streamed through it; after each word, the matching statistic is the length of the
longest template passage that ends there. Maximal passages of at least ``least`` words
are anchors. Anchors of one template that follow each other in order, with small gaps,
are chained; a chain's words over the template's length is how much of the template is
covered. Words outside the templates reset the automaton, so only runs of known
words are walked.

Base phrases are counted on the words themselves, wherever they stand consecutively.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows
get a row each; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from retailmill.llm.common import map_rows, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Base phrases and their labels.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

#: Opening or notice texts of public licences.
TEMPLATES = {
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer.""",
    "cc": """This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.""",
    "cc-notice": "Licensed under CC BY-NC 4.0.",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software.""",
    "mit-notice": "Released under the MIT License.",
    "mpl": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


@dataclass(frozen=True)
class Settings:
    least: int = 4
    most_gap: int = 8
    least_cover: float = 0.3
    phrases: dict[str, str] = field(default_factory=lambda: dict(PHRASES))
    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))


class SuffixAutomaton:
    """Of several token sequences; each state knows where its passages end: for each
    sequence the end position of the first occurrence."""

    def __init__(self, sequences: list[list[str]]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for k, tokens in enumerate(sequences):
            last = 0
            for token in tokens:
                last = self._extend(last, token)
        for k, tokens in enumerate(sequences):  # mark ends, then pass them up the links
            at = 0
            for i, token in enumerate(tokens):
                at = self.next[at][token]
                up = at
                while up > 0 and k not in self.ends[up]:
                    self.ends[up][k] = i
                    up = self.link[up]

    def _extend(self, last: int, token: str) -> int:
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, token, q)
        now = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = now
            p = self.link[p]
        if p < 0:
            self.link[now] = 0
        else:
            q = self.next[p][token]
            self.link[now] = q if self.length[q] == self.length[p] + 1 else self._clone(p, token, q)
        return now

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _clone(self, p: int, token: str, q: int) -> int:
        copy = self._state(self.length[p] + 1)
        self.next[copy] = dict(self.next[q])
        self.link[copy] = self.link[q]
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def anchors(self, words: list[str], least: int) -> list[tuple[int, int, dict[int, int]]]:
        """Maximal matches of at least ``least`` words: (first word, length, end in each
        sequence). Streams the words; keeps one state and a length."""
        out = []
        root, at, n = self.next[0], 0, 0
        known = root.keys()
        for i, word in enumerate(words):
            if word not in known:
                if n:
                    if n >= least:
                        out.append((i - n, n, self.ends[at]))
                    at = n = 0
                continue
            if word not in self.next[at]:
                if n >= least:
                    out.append((i - n, n, self.ends[at]))
                while word not in self.next[at]:
                    at = self.link[at]
                    n = self.length[at]
            at = self.next[at][word]
            n += 1
        if n >= least:
            out.append((len(words) - n, n, self.ends[at]))
        return out


class Scanner:
    def __init__(self, settings: Settings):
        self.settings = settings
        self.labels = list(settings.templates)
        sequences = [words_of(t) for t in settings.templates.values()]
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)
        self.phrases = {k: words_of(p) for k, p in settings.phrases.items()}

    def spans(self, words: list[str]) -> list[tuple[str, int, int, float]]:
        """(template, first word, word after the last, covered share) of each chain."""
        s = self.settings
        open_chains: dict[int, list[int]] = {}
        done: list[tuple[int, list[int]]] = []
        for first, n, ends in self.automaton.anchors(words, s.least):
            for k, end in ends.items():
                chain = open_chains.get(k)
                begin = end - n + 1
                if chain and 0 <= first - chain[1] <= s.most_gap and 0 <= begin - chain[2] <= s.most_gap:
                    chain[1], chain[2], chain[3] = first + n, end + 1, chain[3] + n
                elif chain and first < chain[1] and begin < chain[2] and chain[1] - first == chain[2] - begin:
                    chain[3] += first + n - chain[1]  # anchors that overlap by the same words
                    chain[1], chain[2] = first + n, end + 1
                else:
                    if chain:
                        done.append((k, chain))
                    open_chains[k] = [first, first + n, end + 1, n]
        done += open_chains.items()
        found = [(self.labels[k], c[0], c[1], min(1.0, c[3] / self.sizes[k])) for k, c in done]
        return sorted(x for x in found if x[3] >= s.least_cover)

    def scan(self, text: str) -> tuple:
        words = words_of(text)
        places = []
        for label, phrase in self.phrases.items():
            last, n, i = phrase[-1], len(phrase), 0
            try:
                while True:
                    i = words.index(last, i) + 1
                    if words[max(0, i - n) : i] == phrase:
                        places.append((i - n, label))
            except ValueError:
                pass
        return len(words), sorted(places), self.spans(words)


def license_scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.
    Labels of the method are the templates' names without ``-notice``; score is the
    best covered share of a template, at least 0.5 where a base phrase stands."""

    def make():
        scanner = Scanner(settings)

        def fn(ids, text):
            out = {"doc_id": ids} | {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")}
            for t in text:
                n, places, spans = scanner.scan(t)
                base = {label for _, label in places}
                out["n_words"].append(n)
                out["n_base"].append(len(places))
                out["first_word"].append(min((i for i, _ in places), default=None))
                out["last_word"].append(max((i for i, _ in places), default=None))
                out["base_labels"].append(",".join(sorted(base)))
                out["labels"].append(",".join(sorted(base | {x[0].removesuffix("-notice") for x in spans})))
                out["score"].append(max([0.5 if places else 0.0, *(x[3] for x in spans)]))
                out["spans"].append(",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans))
            return out

        return fn

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    return map_rows(texts(docs), make, schema)
