"""License texts in documents, by patience alignment with templates.

Words (ASCII letters lowered, ASCII punctuation parts words) of a stretch of a document
are aligned with a template's: words that stand once in both are anchors, their longest
increasing subsequence is kept, and the gaps between kept anchors are aligned the same
way, as are equal words at a gap's ends. Coverage is the aligned share of the template's
words. A stretch is as long as two templates, and stretches overlap by half, so that a
notice lies whole in one; only stretches that hold enough of a template's distinct words
to reach the least coverage are aligned.

Defined cases: null or empty texts hold no license; a license that stands more than once is
reported once, at its best place, ties to the first; rows that repeat are each reported;
null doc_ids are carried; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import by_size, map_arrow, record, texts_of
from .words import PUNCTUATION, Words

LEAST_COVERAGE = 0.8

# Wordings of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction'
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by piles of patience sorting."""
    tops, ends, before = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile:
            before[i] = ends[pile - 1]
        if pile == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[pile], ends[pile] = v, i
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def patience_align(text: list, template: list) -> list[tuple[int, int]]:
    """(place in text, place in template) of aligned words, both increasing."""
    out, work = [], [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once = _once(template, c, d)
        here = _once(text, a, b)
        shared = sorted((i, once[w]) for w, i in here.items() if w in once)
        kept = [shared[k] for k in longest_increasing([j for _, j in shared])]
        i, j = a, c
        for x, y in kept:
            work.append((i, x, j, y))
            out.append((x, y))
            i, j = x + 1, y + 1
        if kept:
            work.append((i, b, j, d))
    return sorted(out)


def _once(words: list, a: int, b: int) -> dict:
    place: dict = {}
    for i in range(a, b):
        place[words[i]] = None if words[i] in place else i
    return {w: i for w, i in place.items() if i is not None}


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.code = Words(pa.array([text]), PUNCTUATION, lower=True).code
        self.words, self.distinct = self.code.tolist(), np.unique(self.code)

    def in_words(self, words: Words, least: float) -> list[tuple[int, float, int, int]]:
        """(row, coverage, first word, last word) of the best stretch of each row that reaches ``least``."""
        size = len(self.words)
        place = np.minimum(np.searchsorted(self.distinct, words.code), len(self.distinct) - 1)
        held = np.flatnonzero(self.distinct[place] == words.code)
        if not len(held):
            return []
        # Blocks of a template's length from a row's start; a stretch is two of them.
        row = np.searchsorted(words.first, held, "right") - 1
        blocks = np.concatenate([[0], np.cumsum(-(-words.counts // size) + 1)])
        block = blocks[row] + (held - words.first[row]) // size
        pair = np.unique(block * len(self.distinct) + place[held])
        count = np.bincount(pair // len(self.distinct), minlength=blocks[-1] + 1)
        both = count[:-1] + count[1:]
        best: dict = {}
        for k in np.flatnonzero(both >= np.ceil(least * len(self.distinct) * 0.5)).tolist():
            r = int(np.searchsorted(blocks, k, "right") - 1)
            begin = int(words.first[r]) + (k - int(blocks[r])) * size
            end = min(begin + 2 * size, int(words.first[r + 1]))
            part = words.code[begin:end]
            if begin >= end or np.isin(self.distinct, part).mean() < least * 0.5:
                continue
            aligned = patience_align(part.tolist(), self.words)
            share = len(aligned) / size
            if share >= least and share > best.get(r, (0,))[0]:
                at = begin - int(words.first[r])
                best[r] = (share, at + aligned[0][0], at + aligned[-1][0])
        return [(r, *v) for r, v in sorted(best.items())]


def _scanner(templates: dict[str, str], least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Template(n, t) for n, t in templates.items()]
        for part in by_size(batches):
            words = Words(part.column("text"), PUNCTUATION, lower=True)
            found = [(r, t.name, share, a, b) for t in known for r, share, a, b in t.in_words(words, least)]
            rows = pa.array([f[0] for f in found], pa.int64())
            yield record(
                _FOUND, doc_id=part.column("doc_id").take(rows), license=[f[1] for f in found], coverage=[f[2] for f in found],
                first_word=[f[3] for f in found], last_word=[f[4] for f in found],
            )

    return scan


def license_scan(docs: DataFrame, templates=TEMPLATES, least=LEAST_COVERAGE) -> DataFrame:
    """One row per document and license found: doc_id, license, coverage, first_word, last_word."""
    return map_arrow(texts_of(docs), _scanner(dict(templates), least), "doc_id long, license string, coverage double, first_word long, last_word long")
