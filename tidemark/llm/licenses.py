"""Licence notices in texts, found by a suffix automaton over licence words.

All templates and phrases make one generalised suffix automaton whose letters
are words.  A text's words are fed through it once; at each word the automaton
knows the longest stretch ending there that occurs in any template (matching
statistics).  Long stretches are then chained, per template, into spans that run
forward in both text and template, and a template counts as found when its spans
cover enough of it.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import add_from_text, table
from tidemark.llm.registry import query

# Phrases with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Short notices of public licences, by SPDX-like label.
TEMPLATES = {
    "apache-2.0": ["licensed under the apache license version 2 0",
                   "licensed under the apache license version 2 0 the license you may not use this file except in"
                   " compliance with the license you may obtain a copy of the license at",
                   "unless required by applicable law or agreed to in writing software distributed under the license"
                   " is distributed on an as is basis without warranties or conditions of any kind"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files the software to deal in the software without restriction"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted provided"
            " that the following conditions are met", "licensed under the bsd license"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation"],
    "lgpl": ["licensed under the gnu lesser general public license",
             "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
             " general public license"],
    "agpl": ["licensed under the gnu affero general public license"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is"
            " hereby granted"],
    "cc-by": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0"
              " international license"],
    "cc-by-sa": ["licensed under cc by sa 4 0"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_BYTES = 4 * 1024 * 1024


def word_blocks(data: bytes, size: int = BLOCK_BYTES):
    """Lists of a text's words in order, cut between words, so that long texts need little memory."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        if end < len(data):
            gap = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]").search(data, end)
            end = gap.start() if gap else len(data)
        yield WORD.findall(data[at:end])
        at = end


class Automaton:
    """Generalised suffix automaton of word sequences, with the places where each state's stretch ends."""

    def __init__(self, templates: list[tuple[str, list[bytes]]], phrases: list[tuple[str, list[bytes]]]):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.templates = templates
        self.ends: list[set[tuple[int, int]]] = [set()]  # (template, last word), longest stretch of a state
        self.phrases: list[list[tuple[str, int]]] = [[]]
        for number, (_, words) in enumerate([*templates, *phrases]):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
                if number < len(templates):
                    self.ends[last].add((number, at))
            if number >= len(templates):
                self.phrases[last].append((phrases[number - len(templates)][0], len(words)))
        by_length = sorted(range(1, len(self.next)), key=lambda s: self.length[s])
        for state in reversed(by_length):
            self.ends[self.link[state]] |= self.ends[state]
        for state in by_length:  # a phrase that ends a shorter stretch ends the longer one too
            self.phrases[state] += self.phrases[self.link[state]]

    def _new(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        self.phrases.append([])
        return len(self.next) - 1

    def _split(self, state: int, letter: int, target: int) -> int:
        copy = self._new(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(letter) == target:
            self.next[state][letter] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, letter: int) -> int:
        known = self.next[last].get(letter)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, letter, known)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and letter not in self.next[last]:
            self.next[last][letter] = new
            last = self.link[last]
        if last >= 0:
            target = self.next[last][letter]
            self.link[new] = target if self.length[target] == self.length[last] + 1 else self._split(last, letter, target)
        return new

    def stream(self, letters, first: int, min_match: int, phrases: list, matches: list) -> None:
        """Feed consecutive known words, of which the first has number ``first`` in the text."""
        state = length = 0
        for at, letter in enumerate(letters, first):
            before, before_length = state, length
            while state and letter not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(letter, 0)
            length = length + 1 if state else 0
            if before_length >= min_match and length <= before_length:
                matches.append((at - before_length, before_length, before))
            for label, size in self.phrases[state]:
                if size <= length:
                    phrases.append((at - size + 1, label))
        if length >= min_match:
            matches.append((first + len(letters) - length, length, state))


def chain(automaton: Automaton, matches: list[tuple[int, int, int]], max_gap: int, min_cover: float):
    """Spans (label, first word, last word, cover) of the templates that matches cover well enough."""
    by_template = defaultdict(list)
    for start, length, state in matches:
        for template, end in automaton.ends[state]:
            if end >= length - 1:
                by_template[template].append((start, length, end - length + 1))
    spans = []
    for template, found in by_template.items():
        label, words = automaton.templates[template]
        chains: list[list[int]] = []  # text start, text end, template end, covered words
        for start, length, place in sorted(found):
            fits = [c for c in chains if c[1] <= start <= c[1] + max_gap and c[2] <= place]
            if fits:
                best = max(fits, key=lambda c: c[3])
                best[1:] = [start + length, place + length, best[3] + length]
            else:
                chains.append([start, start + length, place + length, length])
            chains = [c for c in chains if c[1] + max_gap >= start or c[3] >= min_cover * len(words)]
        spans += [(label, c[0], c[1] - 1, c[3] / len(words)) for c in chains if c[3] >= min_cover * len(words)]
    return sorted(spans, key=lambda s: (s[1], s[2], s[0], s[3]))


ADDED = ("n_words bigint, phrases array<struct<label: string, first: bigint>>, "
         "spans array<struct<label: string, first: bigint, last: bigint, cover: double>>")


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, phrases: dict[str, str] | None = None,
                  min_match: int = 4, max_gap: int = 12, min_cover: float = 0.6) -> DataFrame:
    """``docs`` with ``n_words``, ``phrases`` (every place of a phrase) and ``spans`` of templates.

    Words are runs of ASCII letters and digits or anything beyond ASCII, with A-Z
    in lower case, numbered from 0.  A span is a chain of stretches of at least
    ``min_match`` words, at most ``max_gap`` words apart, that cover at least
    ``min_cover`` of a template.  A null or empty text has no words and no
    findings.  Texts of any length are fed in blocks.  Columns named as the
    results are replaced; repeated rows each get their findings.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases

    def words(text: str) -> list[bytes]:
        return WORD.findall(text.encode().lower())

    entries = [(label, words(t)) for label, texts in templates.items() for t in texts]
    named = [(label, words(p)) for p, label in phrases.items()]

    def start():
        import numpy as np

        automaton = Automaton(entries, named)
        letter = automaton.vocabulary

        def scan(text: str | None):
            if not text:
                return 0, [], []
            codes = np.concatenate([np.fromiter((letter.get(w, -1) for w in block), np.int32, len(block))
                                    for block in word_blocks(text.encode().lower())] or [np.zeros(0, np.int32)])
            known = np.flatnonzero(codes >= 0)
            found, matches = [], []
            if len(known):
                for run in np.split(known, np.flatnonzero(np.diff(known) > 1) + 1):
                    automaton.stream(codes[run[0]:run[-1] + 1].tolist(), int(run[0]), min_match, found, matches)
            spans = chain(automaton, matches, max_gap, min_cover) if matches else []
            return (len(codes), [{"label": b, "first": a} for a, b in sorted(found)],
                    [dict(zip(("label", "first", "last", "cover"), s)) for s in spans])

        return lambda texts: list(zip(*map(scan, texts)))

    return add_from_text(docs, ADDED, start)


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and licence templates in all documents."""
    out = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    starts, base = F.col("phrases.first"), F.col("phrases.label")
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return out.select("doc_id", "n_words", F.size("phrases").cast("bigint").alias("n_base"),
                      F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                      labels(base).alias("base_labels"), labels(F.array_union(base, F.col("spans.label"))).alias("labels"),
                      F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("spans.cover")), F.lit(0.0)))
                      .alias("score"), F.size("spans").cast("bigint").alias("n_spans"))
