"""License scan by conditional compression and wording differences.

Around every license word the words of the text are aligned with those of each template; the span of an alignment is
a candidate block, so what stands before and after a statement, on its line or not, does not count. The words on one
side only are the differences. A block is compressed plainly and with its template as a raw zstandard dictionary.
It is confirmed on the wording, or, where much was added between the template's words, on the share of bytes saved.
Of blocks that overlap, the one with the fewest differences stands.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Wording of common public licenses and of the statements that name them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
            " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
            " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
            " copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
                   " compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
            " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
            " later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
                 " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your"
                 " option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
                " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
            " provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]
CUE = r"(?i)licen[cs]e|copyright|permission|redistribut|unencumbered|public domain|rights reserved|free software|mozilla public"
#: A place keeps this share of its template's words in order, and more words than differ or this share of its bytes.
MIN_SAVED, MIN_KEPT = 0.25, 0.8
#: Words added to a place that one kept word outweighs: few, for the tightest span, and more, for widely parted words.
GAINS = (2, 8)

_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
_CUE = re.compile(CUE)
_BREAK = re.compile(r"[.!?]\s|\n")
_CLOSING = re.compile(r"[^\w\s]*")


@dataclass
class Template:
    name: str
    words: list[str]
    compressor: zstandard.ZstdCompressor
    text: str
    codes: np.ndarray


def prepare(templates: list[tuple[str, str]]) -> tuple[list[Template], dict[str, int]]:
    """The templates, and the code of each of their words."""
    out, vocabulary = [], {}
    for name, text in templates:
        data = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words = _WORD.findall(text.lower())
        codes = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64)
        out.append(Template(name, words, zstandard.ZstdCompressor(level=9, dict_data=data), text, codes))
    return out, vocabulary


def align(template: np.ndarray, text: np.ndarray, gain: int) -> list[tuple[int, int]]:
    """(template word, text word) in order, of the span with most kept words; ``gain`` added words outweigh one."""
    n, m = len(template), len(text)
    best, ramp = np.zeros((n + 1, m + 1), np.int64), np.arange(m + 1)
    for i in range(n):
        row = best[i].copy()
        np.maximum(row[1:], np.where(text == template[i], best[i, :-1] + gain, 0), out=row[1:])
        best[i + 1] = np.maximum.accumulate(row + ramp) - ramp
    pairs, i, j = [], n, int(best[n].argmax())
    while i and best[i, j] > 0:
        if best[i, j] == best[i - 1, j]:
            i -= 1
        elif text[j - 1] == template[i - 1] and best[i, j] == best[i - 1, j - 1] + gain:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        else:
            j -= 1
    return pairs[::-1]


def regions(cues: list[int], reach: int, n: int) -> Iterator[tuple[int, int]]:
    """Overlapping stretches of the n words of a text that hold each span of up to ``reach`` words with a cue."""
    k = 0
    while k < len(cues):
        low, high = max(cues[k] - reach, 0), cues[k] + reach
        while k + 1 < len(cues) and cues[k + 1] - reach <= high:
            k += 1
            high = cues[k] + reach
        high, k = min(high + 1, n), k + 1
        for at in range(low, max(high - reach, low + 1), reach):
            yield at, min(at + 2 * reach, high)


def places(codes: np.ndarray, cues: list[int], t: Template) -> Iterator[list[tuple[int, int]]]:
    """Alignments that keep enough of the template's words, by (template word, text word)."""
    n = len(t.codes)
    found = set()
    stack = list(regions(cues, n * (1 + max(GAINS)), len(codes)))
    while stack:
        low, high = stack.pop()
        # no alignment keeps a word that does not occur
        if np.isin(t.codes, codes[low:high]).sum() < MIN_KEPT * n:
            continue
        tight = None
        for gain in GAINS:
            pairs = [(a, b + low) for a, b in align(t.codes, codes[low:high], gain)]
            tight = tight or pairs
            if len(pairs) >= MIN_KEPT * n and tuple(pairs) not in found:
                found.add(tuple(pairs))
                yield pairs
        stack += [(low, tight[0][1]), (tight[-1][1] + 1, high)]


def differences(template: list[str], block: list[str], pairs: list[tuple[int, int]]) -> list[str]:
    """["-word" or "+word" ...] of the words of template and block that are on one side only."""
    out, i, j = [], 0, 0
    for a, b in [*pairs, (len(template), len(block))]:
        out += [f"-{w}" for w in template[i:a]] + [f"+{w}" for w in block[j:b]]
        i, j = a + 1, b + 1
    return out


def scan_text(text: str, templates: list[Template], vocabulary: dict[str, int], plain: zstandard.ZstdCompressor) -> list[tuple]:
    """(offset, block, license, saved, kept share, differences) per confirmed license place of one text."""
    spans = [m.span() for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    codes = np.array([vocabulary.get(w, -1) for w in words], np.int64)
    ends = [b for _, b in spans]
    cues = sorted({min(bisect.bisect_right(ends, m.start()), len(words) - 1) for m in _CUE.finditer(text)}) if words else []
    found = []
    for t in templates:
        for pairs in places(codes, cues, t):
            (first, low), (last, high) = pairs[0], pairs[-1]
            # words in the place of the template's outer ones, up to the end of the line or sentence
            while first and low and not _BREAK.search(text, ends[low - 1], spans[low][0]):
                first, low = first - 1, low - 1
            while last + 1 < len(t.words) and high + 1 < len(words) and not _BREAK.search(text, ends[high], spans[high + 1][0]):
                last, high = last + 1, high + 1
            diff = differences(t.words, words[low:high + 1], [(a, b - low) for a, b in pairs])
            begin, end = spans[low][0], _CLOSING.match(text, ends[high]).end()
            raw = text[begin:end].encode("utf-8", "surrogatepass")
            saved = 1 - len(t.compressor.compress(raw)) / len(plain.compress(raw))
            if len(pairs) > len(diff) or saved >= MIN_SAVED:
                share = len(pairs) / len(t.words)
                rank = share - len(diff) / len(t.words), len(t.words), saved
                found.append((rank, begin, end, t.name, saved, share, diff))
    found.sort(key=lambda f: f[0], reverse=True)
    taken: list[tuple] = []
    for _, begin, end, name, saved, share, diff in found:
        k = bisect.bisect_left(taken, (end,))
        if not k or taken[k - 1][1] <= begin:
            taken.insert(k, (begin, end, name, saved, share, diff))
    return [(a, text[a:b], *rest) for a, b, *rest in taken]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per license place: doc_id, offset, license, saved, kept, differences, exact, block.

    ``offset`` and ``block`` are the place's own, whatever stands around it; a text has as many rows as places.
    Documents without one give no row; null and empty texts neither. Every row is scanned by itself, so null
    and repeated ids are allowed. An empty table gives an empty result. Other columns are ignored.
    """
    kind = docs.select(F.col(id_col).alias("doc_id")).schema[0].dataType.simpleString()
    chosen = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ready, vocabulary), plain = prepare(chosen), zstandard.ZstdCompressor(level=9)
        for batch in batches:
            take, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = scan_text(text, ready, vocabulary, plain)
                take += [i] * len(found)
                rows += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(take, pa.int64())), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.float64()),
                 pa.array([r[4] for r in rows], pa.float64()), pa.array([r[5] for r in rows], pa.list_(pa.string())),
                 pa.array([not r[5] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.string())],
                ["doc_id", "offset", "license", "saved", "kept", "differences", "exact", "block"])

    cued = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").rlike(CUE))
    return cued.mapInArrow(run, f"doc_id {kind}, offset long, license string, saved double, kept double,"
                                " differences array<string>, exact boolean, block string")
