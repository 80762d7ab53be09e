"""License scans: MinHash bands over overlapping windows of a text retrieve templates, exact containment verifies.

A template's shingles are cut into segments of at most ``segment``. A text that holds the share ``containment`` of
the template holds that share of some segment, and so few shingles of it are then missing that nothing can stand in
its middle (words put there would break ``shingle`` - 1 of them): wherever words were put into the notice, and
however many, that segment lies close together. A segment of o shingles falls into the class of the next power of
two, p >= o. For that class a text is read in windows of 3p/2 shingles that start every p/2 shingles (one or two
shingles: at each), so the segment lies in some window. There its Jaccard similarity is known from below (its
shingles against all of the window's), and the number of bands is set so that the window shares a band with it with
probability ``found``. Bands have one row each: ordinary text shares no shingle with a template, so that is selective
enough. The text around a retrieved window, a template and ``gap`` words to either side, is checked by the exact
share of the template's shingles within any stretch as long as the template and ``gap`` words. A stretch must also
hold the words that tell the licence from its kin (its version, its full name).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import slices

#: Notices as their licences ask for them, and the usual short forms.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
    ),
}
#: What tells a licence from its kin. A match holds those of these phrases that its template has.
TELLING = {
    "Apache-2.0": ("Version 2.0", "LICENSE-2.0"),
    "GPL-3.0": ("GNU General Public License", "version 3"),
    "GPL-2.0": ("GNU General Public License", "version 2"),
    "LGPL-3.0": ("GNU Lesser General Public License", "version 3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "version 2.1"),
    "AGPL-3.0": ("GNU Affero General Public License", "version 3"),
    "MPL-2.0": ("Mozilla Public License", "2.0"),
    "CC-BY-NC-4.0": ("NC 4.0", "NonCommercial 4.0"),
    "CC-BY-4.0": ("Attribution 4.0",),
}
#: A word that turns the sense, directly before the match.
TURNED_BY = {"proprietary": ("not",)}
SPANS = "array<struct<template:string,start:bigint,end:bigint,containment:double>>"
_SPAN_TYPE = pa.list_(pa.struct([("template", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                 ("containment", pa.float64())]))
_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *range(128, 256)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A"):ord("Z") + 1] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class Bands:
    """``shingle``: words of a shingle (a shorter template is one shingle); ``containment``: share of a
    template's shingles that a match holds at least; ``found``: probability to retrieve its segment's window;
    ``gap``: words that may stand in between, all together; ``segment``: shingles retrieved as one, at most."""

    shingle: int = 5
    containment: float = 0.8
    found: float = 0.9999
    gap: int = 60
    segment: int = 16
    seed: int = 42


def windows_for(shingles: int) -> tuple[int, int]:
    """(step, blocks): windows of ``blocks`` * ``step`` shingles start every ``step`` shingles."""
    top = 1 << (shingles - 1).bit_length()
    step = max(1, top // 2)
    return step, -(-(top + step - 1) // step)


def bands_for(shingles: int, spec: Bands) -> int:
    """Bands that retrieve a window with ``containment`` of a template of so many shingles."""
    step, blocks = windows_for(shingles)
    shared = math.ceil(spec.containment * shingles)
    jaccard = shared / (blocks * step + shingles - shared)
    return 1 if jaccard >= 1 else math.ceil(math.log(1 - spec.found) / math.log(1 - jaccard))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word: letters of any script and digits."""
    edge = np.diff(np.concatenate([[False], _WORD[raw], [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word, from sums over all bytes (arithmetic modulo 2^64)."""
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(raw) + 1, _ODD, np.uint64))
        back = np.cumprod(np.full(len(raw) + 1, _BACK, np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOW[raw].astype(np.uint64) + np.uint64(1)) * power[:-1])])
        return _mix((sums[end] - sums[start]) * back[start])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, one less than ``size`` fewer than words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = words[:n].copy()
        for i in range(1, size):
            out = out * _ODD + words[i:n + i]
        return _mix(out)


def _seeds(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, np.uint64) | np.uint64(1)


@dataclass
class Template:
    name: str
    words: list[bytes]
    size: int
    own: set[tuple[bytes, ...]]
    telling: list[list[bytes]]
    turned_by: set[bytes]


@dataclass
class Segment:
    template: Template
    hashes: np.ndarray


def _words(text: str) -> list[bytes]:
    raw = text.encode()
    low = raw.lower()
    return [low[a:b] for a, b in zip(*word_places(np.frombuffer(raw, np.uint8)))]


def _holds(words: list[bytes], run: list[bytes]) -> bool:
    return any(words[i:i + len(run)] == run for i in range(len(words) - len(run) + 1))


def prepare(templates, spec: Bands, telling=None, turned_by=None) -> list[Template]:
    out = []
    for name, texts in templates.items():
        phrases = [_words(p) for p in (telling or {}).get(name, ())]
        turning = {w.encode().lower() for w in (turned_by or {}).get(name, ())}
        for i, text in enumerate(texts):
            words = _words(text)
            if not words:
                continue
            size = min(spec.shingle, len(words))
            own = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)}
            out.append(Template(f"{name}#{i + 1}", words, size, own, [p for p in phrases if _holds(words, p)], turning))
    return out


def segments(template: Template, spec: Bands) -> list[Segment]:
    """The template's different shingles in order, cut into equal parts: ``segment`` or fewer, and so few that a part
    with ``containment`` of its shingles misses less than words put in its middle would break."""
    low = b" ".join(template.words)
    raw = np.frombuffer(low, np.uint8)
    hashes = shingle_hashes(word_hashes(raw, *word_places(raw)), template.size)
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    whole = math.ceil(round((template.size - 1) / max(1e-9, 1 - spec.containment), 6)) - 1
    most = max(1, min(spec.segment, whole))
    return [Segment(template, part) for part in np.array_split(hashes, -(-len(hashes) // most))]


def _verified(t: Template, words: list[bytes], low: int, high: int, spec: Bands):
    """The best stretch that begins before word ``high`` and ends after word ``low``: share of the template's shingles,
    first word, end. The shortest of equal ones, then the first."""
    at = [(i, s) for i in range(len(words) - t.size + 1) if (s := tuple(words[i:i + t.size])) in t.own]
    longest = len(t.words) - t.size + spec.gap
    best, held, first = None, Counter(), 0
    for last, (end, shingle) in enumerate(at):
        held[shingle] += 1
        while end - at[first][0] > longest or held[at[first][1]] > 1 and first < last:
            held[at[first][1]] -= 1
            if not held[at[first][1]]:
                del held[at[first][1]]
            first += 1
        a, b, share = at[first][0], end + t.size, len(held) / len(t.own)
        if share < spec.containment or a >= high or b <= low or a and words[a - 1] in t.turned_by:
            continue
        if all(_holds(words[a:b], p) for p in t.telling):
            best = max(best or (0, 0, 0, 0), (share, a - b, -a, b))
    return best and (best[0], -best[2], best[3])


class Scanner:
    """All classes of segments with their band tables."""

    def __init__(self, templates, spec: Bands, telling=None, turned_by=None):
        self.spec = spec
        self.classes: dict[tuple[int, tuple[int, int]], list[Segment]] = {}
        for t in prepare(templates, spec, telling, turned_by):
            for s in segments(t, spec):
                self.classes.setdefault((t.size, windows_for(len(s.hashes))), []).append(s)
        self.bands = {c: max(bands_for(len(t.hashes), spec) for t in own) for c, own in self.classes.items()}
        self.seeds = _seeds(max(self.bands.values(), default=1), spec.seed)

    def scan(self, raws: list[bytes]) -> list[list[dict]]:
        """Spans (byte offsets) of each text."""
        sizes = np.array([len(r) + 1 for r in raws])
        raw = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        start, end = word_places(raw)
        base = np.cumsum(sizes) - sizes
        first = np.searchsorted(start, base)
        last = np.append(first[1:], len(start))
        hashes = word_hashes(raw, start, end)
        found: list[dict] = [{} for _ in raws]
        by_size: dict[int, list[tuple[int, int]]] = {}
        for size, window in self.classes:
            by_size.setdefault(size, []).append(window)
        for size, windows in by_size.items():
            self._scan_size(size, windows, raw, start, end, first, last, hashes, found)
        return [self._spans(f, b) for f, b in zip(found, base)]

    def _scan_size(self, size, windows, raw, start, end, first, last, words, found):
        n = len(words) - size + 1
        if n <= 0:
            return
        shingles = shingle_hashes(words, size)
        for f, l in zip(first, last):  # shingles that reach into the next text are none
            shingles[max(f, l - size + 1):l] = _LAST
        blocks = {}
        for window in windows:
            step = window[0]
            counts = (last - first + step - 1) // step
            doc = np.repeat(np.arange(len(first)), counts)
            place = first[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)) * step
            inside = place < n
            blocks[window] = (doc[inside], place[inside])
        none = shingles == _LAST
        for b in range(max(self.bands[size, w] for w in windows)):
            with np.errstate(over="ignore"):
                value = _mix(shingles * self.seeds[b])
            value[none] = _LAST
            for window in windows:
                doc, place = blocks[window]
                if b >= self.bands[size, window] or not len(place):
                    continue
                block = np.minimum.reduceat(value, place) if window[0] > 1 else value[place]
                least = block.copy()
                for ahead in range(1, window[1]):
                    same = doc[ahead:] == doc[:-ahead]
                    least[:-ahead][same] = np.minimum(least[:-ahead], block[ahead:])[same]
                for s in self.classes[size, window]:
                    with np.errstate(over="ignore"):
                        mine = _mix(s.hashes * self.seeds[b]).min()
                    for w in np.flatnonzero(least == mine):
                        d, stop = doc[w], min(last[doc[w]], place[w] + window[0] * window[1] + size - 1)
                        self._check(s.template, d, place[w], stop, first[d], last[d], raw, start, end, found)

    def _check(self, t, doc, place, stop, first, last, raw, start, end, found):
        """Check the text around the window: as far as a stretch that touches it can reach, and a word before."""
        seen = found[doc].setdefault(t.name, {})
        if (place, stop) in seen:
            return
        reach = len(t.words) + self.spec.gap
        a, b = max(first, place - reach - 1), min(last, stop + reach)
        words = [raw[x:y].tobytes().lower() for x, y in zip(start[a:b], end[a:b])]
        hit = _verified(t, words, place - a, stop - a, self.spec)
        seen[place, stop] = hit and (hit[0], int(start[a + hit[1]]), int(end[a + hit[2] - 1]))

    def _spans(self, found, base) -> list[dict]:
        out = []
        for name, windows in found.items():
            hits = sorted(h for h in windows.values() if h)
            kept = []
            for share, a, b in reversed(hits):
                if not any(a < y and x < b for _, x, y in kept):
                    kept.append((share, a, b))
            out += [{"template": name, "start": a - int(base), "end": b - int(base), "containment": s} for s, a, b in kept]
        return sorted(out, key=lambda s: (s["start"], s["end"], s["template"]))


def scan_licenses(docs: DataFrame, templates=None, spec: Bands = Bands(), doc_id: str = "doc_id", text: str = "text",
                  telling=None, turned_by=None) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``: spans (template, start, end, containment), by start.

    ``templates`` maps a licence to its texts, a list as long as a person keeps; it travels with the tasks. ``telling``
    maps it to phrases without which a match is none, ``turned_by`` to words that undo a match they precede; both go
    with the own templates by default, as ``TELLING`` and ``TURNED_BY``.
    Offsets are code points, from the first to the last word of a shingle that matches. Of overlapping stretches
    with the same template the best one counts. A NULL or empty text has no spans. Every row stays, texts are
    read whole, and nothing is shuffled.
    """
    chosen = TEMPLATES if templates is None else templates
    if templates is None:
        telling, turned_by = telling or TELLING, turned_by or TURNED_BY
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        scanner = Scanner(chosen, spec, telling, turned_by)
        for batch in slices(batches, "text"):
            raws = [t.encode() for t in batch.column("text").to_pylist()]
            made = scanner.scan(raws)
            for raw, spans in zip(raws, made):
                for s in spans:
                    s["start"], s["end"] = (len(raw[:s[k]].decode()) for k in ("start", "end"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, _SPAN_TYPE)], ["doc_id", "spans"])

    return rows.mapInArrow(work, f"doc_id {kind}, spans {SPANS}")


