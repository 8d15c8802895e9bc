"""License texts in documents: winnowed fingerprints find candidates, banded alignment measures them.

Templates and documents are words (letters and digits, A-Z lower-cased). Of every ``WINDOW`` neighbouring grams of
``GRAM`` words the one with the least hash is a fingerprint, so that a document that shares ``GRAM + WINDOW - 1`` words in a
row with a template also shares a fingerprint with it. An inverted index from fingerprint to template and position
travels to the tasks; its size is checked, and more templates than ``INDEX_BYTES`` are scanned in several passes whose
rows are put together. The text is aligned with a template within a band around the diagonals of its hits. An alignment
that covers at least ``percent`` of the template's words is a match; of overlapping matches of one template the best
stays, and the words before and after it are aligned anew until nothing else matches.

Null texts, and templates that are null or without words, match nothing. Repeated rows give repeated matches.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import LOWER, byte_class, grams, slices, stretches, window_minimum, words_of

GRAM, WINDOW, BAND = 3, 2, 8
PERCENT = 80
INDEX_BYTES = 4 << 20
MATCH, MISMATCH, GAP = 1.0, -0.75, -0.6

_INSIDE = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Words in the original text, where A-Z are letters too.
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
MATCHES = (
    "doc_id long, license_id string, coverage double, n_matched int, n_template int, "
    "first_word int, last_word int, start int, stop int"
)

# The wording of common notices.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def words(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def fingerprints(found, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The chosen grams of a slice of words: index of the first word, and hash. Shorter texts have one for all their words."""
    at, value = grams(found, gram)
    if len(at):
        low_bits = np.uint64((1 << 24) - 1)
        key = (value & ~low_bits) | (np.arange(len(at), dtype=np.uint64) & low_bits)
        low = (window_minimum(key, window) & low_bits).astype(np.int64)
        base = np.arange(len(low), dtype=np.int64)
        low += (base >> 24) << 24
        row = found.row[at]
        whole = row[: len(low)] == row[window - 1 :] if len(low) else np.zeros(0, bool)
        alone = np.flatnonzero((found.count >= gram) & (found.count < gram + window - 1))  # fewer grams than a window
        few = np.flatnonzero(np.isin(row, alone)) if len(alone) else np.zeros(0, np.int64)
        pick = np.unique(np.r_[low[whole], few])
        at, value = at[pick], value[pick]
    short = np.flatnonzero((found.count > 0) & (found.count < gram))
    first = found.first[short]
    return np.r_[at, first], np.r_[value, stretches(found, first, first + found.count[short])]


def aligned(template: list[str], text: list[str], low: int, high: int) -> tuple[float, int, int, int]:
    """The best local alignment with ``low <= text position - template position <= high``: score, matches, first, last + 1."""
    best = (0.0, 0, 0, 0)
    before: dict[int, tuple[float, int, int]] = {}
    for i, word in enumerate(template):
        row: dict[int, tuple[float, int, int]] = {}
        for j in range(max(0, i + low), min(len(text), i + high + 1)):
            score, hits, start = before.get(j - 1, (0.0, 0, j))
            same = text[j] == word
            cell = (score + (MATCH if same else MISMATCH), hits + same, start)
            for other in (before.get(j), row.get(j - 1)):
                if other is not None and other[0] + GAP > cell[0]:
                    cell = (other[0] + GAP, other[1], other[2])
            if cell[0] > 0:
                row[j] = cell
                if (cell[0], cell[1]) > best[:2]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        before = row
    return best


def alignments(
    template: list[str], text: list[str], bands: list[tuple[int, int]], percent: int
) -> Iterator[tuple[float, int, int, int]]:
    """Matches that do not overlap, the best first, each as by ``aligned``: of all, then of the words that are left.

    ``bands`` are ascending and disjoint ranges of text position - template position. Scores are kept by their last word:
    those of words before a match stay as they are, and behind it only those that reach into it are computed again.
    """
    n = len(template)
    tops = [high for _, high in bands]
    reach: dict[int, int] = {}  # last word: the least first word of its alignments
    valid: dict[int, tuple] = {}  # last word: its best match
    queue: list[tuple] = []
    taken: list[int] = []  # first words of the matches

    def sweep(begin: int, end: int, again: bool) -> None:
        before: dict[int, tuple[float, int, int]] = {}
        j = begin
        k = bisect_right(tops, j - n)
        while k < len(bands):
            j = max(j, bands[k][0])
            if j >= end or (again and reach.get(j, j) >= begin):
                return
            row: dict[int, tuple[float, int, int]] = {}
            top = None
            active = k
            while active < len(bands) and bands[active][0] <= j:
                active += 1
            for low, high in reversed(bands[k:active]):
                for i in range(max(0, j - high), min(n, j - low + 1)):
                    score, hits, start = before.get(i - 1, (0.0, 0, j))
                    same = text[j] == template[i]
                    cell = (score + (MATCH if same else MISMATCH), hits + same, start)
                    for other in (row.get(i - 1), before.get(i)):
                        if other is not None and other[0] + GAP > cell[0]:
                            cell = (other[0] + GAP, other[1], other[2])
                    if cell[0] > 0:
                        row[i] = cell
                        if 100 * cell[1] >= percent * n and (top is None or cell[:2] > (-top[0], -top[1])):
                            top = (-cell[0], -cell[1], i, j, cell[2])
            reach[j] = min((c[2] for c in row.values()), default=j)
            valid.pop(j, None)
            if top:
                valid[j] = top
                heapq.heappush(queue, top)
            before = row
            j += 1
            while k < len(bands) and tops[k] <= j - n:
                k += 1

    sweep(0, len(text), False)
    while queue:
        found = heapq.heappop(queue)
        if valid.get(found[3]) != found:
            continue
        score, hits, _, last, first = found
        yield -score, -hits, first, last + 1
        for j in range(first, last + 1):
            valid.pop(j, None)
        at = bisect_left(taken, first)
        end = taken[at] if at < len(taken) else len(text)
        insort(taken, first)
        sweep(last + 1, end, True)


def _index(templates: list[tuple[str, str]]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[tuple[str, list[str]]]]:
    """Sorted fingerprints, for each the templates and word positions that have it, and the templates as words."""
    listed, places = [], {}
    for name, text in templates:
        own = words(text)
        if not own:
            continue
        for _, data, offsets in slices(pa.array([text])):
            at, value = fingerprints(words_of(data, offsets, _INSIDE, LOWER))
            for position, h in zip(at.tolist(), value.tolist(), strict=True):
                places.setdefault(h, []).append((len(listed), position))
        listed.append((name, own))
    keys = np.array(sorted(places), dtype=np.uint64)
    return keys, [places[k] for k in keys.tolist()], listed


def _matches(text: str, hits: list[tuple[int, int]], templates: list, percent: int) -> Iterator[tuple]:
    """Matches of one document from its hits, which are (template, text position - template position)."""
    at = [m.span() for m in _WORD.finditer(text)]
    own = words(text)
    for number in sorted({t for t, _ in hits}):
        name, template = templates[number]
        bands: list[tuple[int, int]] = []
        for d in sorted({d for t, d in hits if t == number}):
            if bands and d - BAND <= bands[-1][1] + 1:
                bands[-1] = (bands[-1][0], d + BAND)
            else:
                bands.append((d - BAND, d + BAND))
        for _, matched, first, last in alignments(template, own, bands, percent):
            yield name, matched / len(template), matched, len(template), first, last - 1, at[first][0], at[last - 1][1]


def _scan(templates: list[tuple[str, str]], percent: int):
    kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int32()] * 6]
    names = [c.split()[0] for c in MATCHES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places, listed = _index(templates)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            out = []
            for row, data, offsets in slices(texts):
                found = words_of(data, offsets, _INSIDE, LOWER)
                at, value = fingerprints(found)
                if not len(keys) or not len(value):
                    continue
                spot = np.minimum(np.searchsorted(keys, value), len(keys) - 1)
                hit = np.flatnonzero(keys[spot] == value)
                per_row: dict[int, list[tuple[int, int]]] = {}
                for k in hit.tolist():
                    owner = int(found.row[at[k]])
                    position = int(at[k] - found.first[owner])
                    per_row.setdefault(owner, []).extend((t, position - p) for t, p in places[spot[k]])
                for owner, hits in per_row.items():
                    doc = ids[row + owner].as_py()
                    out += [(doc, *match) for match in _matches(texts[row + owner].as_py(), hits, listed, percent)]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license_id string, text string")


def scanned(
    docs: DataFrame,
    templates: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """A row per match: document, license, share of the template's words matched, word range and character range."""
    templates = (templates if templates is not None else default_templates(docs.sparkSession)).select("license_id", "text").dropna()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(1, -(-(templates.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // index_bytes))

    def part(number: int) -> DataFrame:
        own = templates if parts == 1 else templates.where(F.pmod(F.xxhash64("license_id", "text"), F.lit(parts)) == number)
        return texts.mapInArrow(_scan(sorted(map(tuple, own.collect())), percent), MATCHES)

    return reduce(DataFrame.unionByName, map(part, range(parts)))
