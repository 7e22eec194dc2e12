"""Licence notices in texts: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Words are lower-case runs of letters and digits. A template's shingles are its runs of five words (all words, if fewer).
Templates are grouped by scale: the next power of two to their number of shingles. At scale S a text's shingle sequence is
cut into blocks of S, and a window is two neighbouring blocks, so any passage of up to S shingles lies whole in a window.
Such a window resembles a template that it contains to 80 % by at least 0.8 m / (2 S + 0.2 m) with m > S / 2 shingles,
that is by 0.19 or more. Bands of ``rows`` minima collide with probability 1 - (1 - s ** rows) ** bands at resemblance s:
with one row and 48 bands above 0.9999. Every retrieved window is then checked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import scan

BANDS, ROWS = 48, 1
CONTAINMENT = (80, 100)
MATCHES = "doc_id long, license string, matched long, template_shingles long, containment double, first_word long, last_word long, n_windows long"

# Fixed texts: licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}

_SEPARATOR = scan.NON_LETTER & ~np.isin(np.arange(256), list(b"0123456789"))


def _shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for first, data, off in scan.chunks(column):
        data = scan.LOWER[data]
        starts, ends, word_off = scan.words(data, off, _SEPARATOR)
        h, h_off = scan.shingles(scan.word_hashes(data, starts, ends), word_off)
        yield first, h, h_off, np.diff(word_off)


def _keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """One key per band from (rows of a band, windows) minima."""
    key = np.zeros(minima.shape[1], np.uint64)
    for r in range(rows):
        key = scan.mix(key ^ minima[r])
    return key


class Index:
    """Templates by scale, with the band keys of each."""

    def __init__(self, templates: dict[str, str], bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.names = bands, rows, list(templates)
        self.seeds = scan.mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
        self.sets, self.scales = [], {}
        for _, h, h_off, _ in _shingles(pa.array([templates[n] for n in self.names], pa.string())):
            self.sets += [np.unique(h[h_off[i] : h_off[i + 1]]) for i in range(len(h_off) - 1)]
        for t, s in enumerate(self.sets):
            if len(s):
                self.scales.setdefault(1 << (len(s) - 1).bit_length(), []).append(t)

    def permuted(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return (hashes ^ self.seeds[k]) * (self.seeds[k] | np.uint64(1))

    def band_keys(self, t: int, band: int) -> int:
        minima = np.array([[self.permuted(self.sets[t], band * self.rows + r).min()] for r in range(self.rows)], np.uint64)
        return int(_keys(minima, self.rows)[0])

    def candidates(self, h: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, template, first shingle, end) of every window that shares a band with a template."""
        layout = {}
        for scale in self.scales:
            n_blocks = -(-np.diff(off) // scale)
            block_off = np.concatenate(([0], np.cumsum(n_blocks)))
            number = np.arange(block_off[-1]) - np.repeat(block_off[:-1], n_blocks)
            starts = np.repeat(off[:-1], n_blocks) + number * scale
            last = np.zeros(len(starts), bool)
            last[block_off[1:][n_blocks > 0] - 1] = True
            layout[scale] = (starts, last, {t: np.zeros(len(starts), bool) for t in self.scales[scale]})
        minima = {scale: [] for scale in self.scales}
        for k in range(self.bands * self.rows if len(h) else 0):
            values = self.permuted(h, k)
            for scale, (starts, last, found) in layout.items():
                low = np.minimum.reduceat(values, starts)
                low[:-1] = np.where(last[:-1], low[:-1], np.minimum(low[:-1], low[1:]))
                minima[scale].append(low)
                if len(minima[scale]) == self.rows:
                    keys = _keys(np.stack(minima[scale]), self.rows)
                    for t, hit in found.items():
                        hit |= keys == np.uint64(self.band_keys(t, k // self.rows))
                    minima[scale] = []
        for scale, (starts, last, found) in layout.items():
            for t, hit in found.items():
                for w in np.flatnonzero(hit):
                    doc = int(np.searchsorted(off, starts[w], "right")) - 1
                    yield doc, t, int(starts[w]), int(min(starts[w] + 2 * scale, off[doc + 1]))


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document and licence found in ``documents`` (doc_id, text).

    matched and containment are those of the best window (the first of equals), first_word and last_word span the
    template's shingles in it (word numbers from 0), n_windows counts the windows that reach the containment. Null, empty
    and unmatched texts give no rows; repeated rows are scanned each for itself; other columns are ignored. Nothing is
    shuffled; the templates travel with the tasks.
    """
    index = Index(TEMPLATES if templates is None else templates, bands, rows)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in MATCHES.split(", ")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, h, off, n_words in _shingles(batch.column("text")):
                best: dict[tuple[int, int], list[int]] = {}
                for doc, t, start, end in index.candidates(h, off):
                    inside = np.isin(h[start:end], index.sets[t])
                    matched = len(np.unique(h[start:end][inside]))
                    if CONTAINMENT[1] * matched < CONTAINMENT[0] * len(index.sets[t]):
                        continue
                    at = np.flatnonzero(inside) + start - off[doc]
                    row = [matched, int(at[0]), int(min(at[-1] + scan.SHINGLE, n_words[doc]) - 1)]
                    old = best.get((doc, t))
                    best[doc, t] = [*(row if old is None or matched > old[0] else old[:3]), (old[3] if old else 0) + 1]
                if best:
                    ids = batch.column("doc_id").slice(first, len(off) - 1).to_pylist()
                    out = [(ids[d], index.names[t], m, len(index.sets[t]), m / len(index.sets[t]), a, b, n) for (d, t), (m, a, b, n) in sorted(best.items())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.mapInArrow(task, MATCHES)
