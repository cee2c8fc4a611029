"""License scans: MinHash bands retrieve templates, exact containment verifies them.

A text is read as its word shingles, in order. For a template of m shingles the
text is cut into overlapping windows of 2m shingles that begin every m: each run
of m shingles lies within one of them, so a window around an unchanged copy has
a Jaccard similarity of at least 1/2 with the template. A band is `ROWS` MinHash
values; a window and a template that agree in a band are candidates. With
similarity s they agree in at least one of `BANDS` bands with the probability
1 - (1 - s^ROWS)^BANDS: 0.99998 for an unchanged copy, and 0.9997 at s = 0.4,
which a copy with four fifths of the shingles reaches. A candidate counts if the
window contains at least 4/5 of the template's shingles, which is decided on the
exact sets.

Null texts and texts of fewer words than a shingle match only templates that are
as short (none here). Each input row gives one output row, repeated rows equal
ones; other columns are left out. Without templates nothing is found.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.shingles import ALNUM, slices, text_shingles
from rowtide.llm.workers import ship

BANDS, ROWS = 16, 1
#: Fifths of a template's shingles that a window must contain.
FIFTHS = 4
#: Shingles that are hashed at once, unless one text has more.
BLOCK = 1 << 18
#: Bytes of text that are made into shingles at once, unless one text is longer.
TEXT_BYTES = 1 << 21

# Statements and notices of public licenses.
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0-line": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
}

_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Template:
    name: str
    shingles: np.ndarray

    @property
    def size(self) -> int:
        return len(self.shingles)

    def contained(self, window: np.ndarray) -> float:
        """Share of the template's shingles that a window has."""
        return float(np.isin(self.shingles, window).mean())


def templates_of(texts: Mapping[str, str]) -> list[Template]:
    hashes, begins = text_shingles(pa.array(list(texts.values()), pa.string()), ALNUM)
    cut = [np.unique(hashes[a:b]) for a, b in zip(begins[:-1], begins[1:])]
    return [Template(n, s) for n, s in zip(texts, cut) if len(s)]


def hashed(shingles: np.ndarray, i: int) -> np.ndarray:
    """The i-th hash function of shingles, 32 bits."""
    return ((shingles * _MULTIPLIERS[i]) >> np.uint64(32)).astype(np.uint32)


class Bands:
    """Signatures of templates, by the size of their windows."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.sizes: dict[int, list[int]] = {}
        for i, t in enumerate(templates):
            self.sizes.setdefault(t.size, []).append(i)
        self.least = np.array(
            [[hashed(t.shingles, i).min() for i in range(BANDS * ROWS)] for t in templates], np.uint32
        ).reshape(len(templates), BANDS * ROWS)
        # Which low bits of a value any template of a size has, for each hash function.
        self.marked = {}
        for size, own in self.sizes.items():
            for i in range(BANDS * ROWS):
                table = np.zeros(1 << 16, bool)
                table[self.least[own, i] & 0xFFFF] = True
                self.marked[size, i] = table

    def candidates(self, shingles: np.ndarray, ends: np.ndarray) -> set[tuple[int, int]]:
        """Pairs of a window's begin and a template that agree in a band.

        `shingles` are those of several texts, which end at `ends`; a window
        does not go beyond its text.
        """
        found: set[tuple[int, int]] = set()
        windows = {size: _windows(ends, size) for size in self.sizes}
        for band in range(BANDS):
            rows = range(band * ROWS, band * ROWS + ROWS)
            values = {i: hashed(shingles, i) for i in rows}
            for size, own in self.sizes.items():
                begins, last = windows[size]
                least = {i: _least(values[i], begins, last) for i in rows}
                near = np.ones(len(begins), bool)
                for i in rows:
                    near &= self.marked[size, i][least[i] & np.uint32(0xFFFF)]
                for w in np.flatnonzero(near).tolist():
                    for t in own:
                        if all(least[i][w] == self.least[t, i] for i in rows):
                            found.add((int(begins[w]), t))
        return found

    def matches(self, shingles: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int, float]]]:
        """Verified windows of each text: begin within it, template, containment."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(ends) - 1)]
        for begin, t in sorted(self.candidates(shingles, ends)):
            template = self.templates[t]
            text = int(np.searchsorted(ends, begin, "right")) - 1
            share = template.contained(shingles[begin : min(begin + 2 * template.size, ends[text + 1])])
            if share * 5 >= FIFTHS:
                out[text].append((begin - int(ends[text]), t, share))
        return out


def _windows(ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's blocks of `size` shingles begin, and which is its text's last."""
    counts = -(-np.diff(ends) // size)
    firsts = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    begins = ends[text] + (np.arange(firsts[-1]) - firsts[text]) * size
    last = np.zeros(len(begins), bool)
    last[firsts[1:][counts > 0] - 1] = True
    return begins, last


def _least(values: np.ndarray, begins: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value of each window, which is a block and the next one of its text."""
    block = np.minimum.reduceat(values, begins)
    out = block.copy()
    np.minimum(block[:-1], block[1:], out=out[:-1], where=~last[:-1])
    return out


def scan(docs: DataFrame, texts: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """`doc_id`, `n_licenses`, `licenses` (names, sorted) and `windows`, where they were found.

    A window is (license, first word, words, containment).
    """
    templates = templates_of(texts)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(templates)
        kind = pa.list_(
            pa.struct(
                [("license", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]
            )
        )
        for batch in batches:
            found = []
            for rows in found_in(bands, batch.column(1)):
                found.append(
                    [
                        {
                            "license": templates[t].name,
                            "start": begin,
                            "words": 2 * templates[t].size + 4,
                            "containment": share,
                        }
                        for begin, t, share in rows
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "windows"])

    ship(docs.sparkSession)
    found = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        search,
        "doc_id bigint, windows array<struct<license:string,start:bigint,words:bigint,containment:double>>",
    )
    names = F.array_sort(F.array_distinct(F.transform("windows", lambda w: w["license"])))
    return found.select(
        "doc_id",
        F.size(names).cast("bigint").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
        "windows",
    )


def found_in(bands: Bands, texts: pa.Array) -> Iterator[list[tuple[int, int, float]]]:
    """Matches of each text of a column."""
    for part in slices(texts, TEXT_BYTES):
        yield from by_text(bands, *text_shingles(part, ALNUM))


def by_text(bands: Bands, hashes: np.ndarray, begins: np.ndarray) -> Iterator[list[tuple[int, int, float]]]:
    """Matches of each text, several texts at a time."""
    first = 0
    while first < len(begins) - 1:
        end = int(np.searchsorted(begins, begins[first] + BLOCK, "right")) - 1
        end = max(end, first + 1)
        ends = begins[first : end + 1] - begins[first]
        if ends[-1] == 0 or not bands.templates:
            yield from ([] for _ in range(end - first))
        else:
            yield from bands.matches(hashes[begins[first] : begins[end]], ends)
        first = end
