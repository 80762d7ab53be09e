import random
import re

import pytest

from tillwatch.llm import license_scan as ls

SCHEMA = "doc_id bigint, text string, spans string, template string"


def filler(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def documents():
    draw = random.Random(9)
    rows = [(0, None), (1, ""), (2, "all rights"), (3, "All  Rights\nRESERVED"), (3, "All  Rights\nRESERVED"), (4, "éü — All rights reserved. ß"), (None, "x")]
    for name, texts in ls.TEMPLATES.items():
        for text in texts:
            for k in (0, 3, 17, 100):
                rows.append((10 * len(rows), f"Ünï {filler(draw, k)} {text.upper() if k == 3 else text} {filler(draw, 40)}"))
            words = text.split()
            if len(words) > 30:
                broken = list(words)
                broken[len(words) // 2] = "changed"
                rows.append((10 * len(rows), f"{filler(draw, 9)} {' '.join(broken)} {filler(draw, 9)}"))
                rows.append((10 * len(rows), " ".join(words[:len(words) // 3])))
    rows.append((999_999, filler(draw, 3000) + " Released under the MIT License. " + filler(draw, 50_000) + " all rights reserved"))
    return rows


def low_words(text):
    return [w.encode().lower() for w in re.findall(r"[a-zA-Z0-9\u0080-\U0010ffff]+", text or "")]


def plain(text, spec):
    """Names of templates that some stretch of the whole text holds, by trying the longest stretch from each word."""
    low = low_words(text)
    out = set()
    for name, texts in ls.TEMPLATES.items():
        phrases = [b" " + b" ".join(low_words(p)) + b" " for p in ls.TELLING.get(name, ())]
        for i, template in enumerate(texts):
            t = low_words(template)
            own_text = b" " + b" ".join(t) + b" "
            needed = [p for p in phrases if p in own_text]
            size = min(spec.shingle, len(t))
            own = {tuple(t[k:k + size]) for k in range(len(t) - size + 1)}
            at = [k for k in range(len(low) - size + 1) if tuple(low[k:k + size]) in own]
            for k in at:
                if k and low[k - 1].decode() in ls.TURNED_BY.get(name, ()):
                    continue
                near = [x for x in at if k <= x < k + len(own) + spec.gap]
                words = b" " + b" ".join(low[k:near[-1] + size]) + b" "
                share = len({tuple(low[x:x + size]) for x in near}) / len(own)
                if share >= spec.containment and all(p in words for p in needed):
                    out.add(f"{name}#{i + 1}")
    return out


def test_like_brute_force(spark):
    spec, rows = ls.Bands(), documents()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    got = ls.scan_licenses(docs).collect()
    assert len(got) == len(rows)
    found = sorted((str(r["doc_id"]), sorted({s["template"] for s in r["spans"]})) for r in got)
    want = sorted((str(i), sorted(plain(t, spec))) for i, t in rows)
    assert found == want


def names(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: {s["template"] for s in r["spans"]} for r in ls.scan_licenses(docs).collect()}


def test_words_put_into_a_notice(spark):
    """Up to ``gap`` words at any place of any notice, whatever words and windows stand before it."""
    draw = random.Random(5)
    notices = [x for texts in ls.TEMPLATES.values() for x in texts]
    texts = []
    for n in (0, 10, 20, 30, 60):
        for notice in notices:
            words = notice.split()
            at = len(words) // 2
            texts += [f"{filler(draw, k)} {' '.join(words[:at])} {filler(draw, n)} {' '.join(words[at:])} {filler(draw, 20)}"
                      for k in (0, 5, 11)]
    for notice in (x for x in notices if len(x.split()) > 45):  # two places, thirty words each
        words = notice.split()
        cut = len(words) // 3
        texts.append(f"{' '.join(words[:cut])} {filler(draw, 30)} {' '.join(words[cut:2 * cut])} {filler(draw, 30)} {' '.join(words[2 * cut:])}")
    found = names(spark, texts)
    assert found == {i: plain(t, ls.Bands()) for i, t in enumerate(texts)}
    isc = next(x for x in notices if x.startswith("Permission to use")).split()
    assert "ISC#1" in plain(f"{' '.join(isc[:15])} {filler(draw, 60)} {' '.join(isc[15:])}", ls.Bands())


def test_versions_and_kin_are_told_apart(spark):
    gpl = ("This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General "
           "Public License as published by the Free Software Foundation{} either version {} of the License, or (at your "
           "option) any later version.")
    cases = {
        "Under the GNU General Public License, version 2, it is licensed.": set(),
        "This work is licensed under the GNU General Public License, version 2.": {"GPL-2.0"},
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        "This work is licensed under the GNU General Public License, version 1.": set(),
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": {"LGPL-2.1"},
        "This work is licensed under the GNU Affero General Public License, version 3.": {"AGPL-3.0"},
        gpl.format(";", "", ";", "2"): {"GPL-2.0"}, gpl.format(":", "", ",", "3"): {"GPL-3.0"},
        gpl.format(":", "Affero ", ",", "3"): {"AGPL-3.0"}, gpl.format(":", "Lesser ", ",", "3"): {"LGPL-3.0"},
        gpl.format(":", "", ",", "1"): set(),
        "Not all rights reserved.": set(), "All rights reserved.": {"proprietary"},
        "Licensed under the Apache License, Version 1.1.": set(),
        "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.": {"GPL-2.0"},
    }
    found = names(spark, list(cases))
    assert [{n.split("#")[0] for n in found[i]} for i in range(len(cases))] == list(cases.values())


def test_spans_are_code_points(spark):
    text = "éü — All rights reserved. ß then, licensed under cc by-nc 4.0 !"
    got = ls.scan_licenses(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["spans"]
    assert [text[s["start"]:s["end"]] for s in got] == ["All rights reserved", "licensed under cc by-nc 4.0"]
    assert all(s["containment"] == 1.0 for s in got)


def test_own_templates_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "please share alike and give credit to us")], "doc_id bigint, text string")
    got = ls.scan_licenses(docs, {"own": ("share alike and give credit",), "none": ("",)}).first()["spans"]
    assert [s["template"] for s in got] == ["own#1"]
    assert ls.scan_licenses(docs, {}).first()["spans"] == [] and ls.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shingles", [1, 2, 3, 7, 11, 60, 300])
def test_bands_reach_the_promised_probability(shingles):
    spec = ls.Bands()
    step, blocks = ls.windows_for(shingles)
    assert step * blocks >= shingles + step - 1
    shared = -(-shingles * 4 // 5)
    jaccard = shared / (step * blocks + shingles - shared)
    assert 1 - (1 - jaccard) ** ls.bands_for(shingles, spec) >= spec.found


def test_hashes_follow_the_words():
    import numpy as np

    raw = np.frombuffer(b"The quick THE, quick\nthe2 quick-the", np.uint8)
    start, end = ls.word_places(raw)
    words = [raw[a:b].tobytes().lower() for a, b in zip(start, end)]
    hashes = ls.word_hashes(raw, start, end)
    assert len(set(hashes.tolist())) == len(set(words))
    assert all((x == y) == (a == b) for x, a in zip(hashes, words) for y, b in zip(hashes, words))
