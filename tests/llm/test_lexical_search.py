import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tillwatch.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, n int, places string, score int"
ITEMS = "item_id bigint, text string, rank int, doc_id int"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    counts = [(i, Counter(terms(t))) for i, t, *_ in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    merged = {}
    for i, t, *_ in items:
        merged.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in merged.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * c.total() * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in words if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def tables(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["Äpfel", "ÄPFEL", "x1y", "中文"]
    docs = [(i, rnd.choice(" ,._\n\x00-").join(rnd.choice(words).upper() if rnd.random() < .3 else rnd.choice(words) for _ in range(rnd.randint(1, 60))))
            for i in range(300)]
    docs += [(900 + i, docs[7][1]) for i in range(80)] + [docs[9]] * 3
    docs += [(None, docs[3][1]), (None, "w1"), (500, None), (501, ""), (502, " ,;"), (503, "w2 " * 60_000 + "w3" * 20)]
    items = [(i, " ".join(rnd.sample(words, 6))) for i in range(9)]
    items += [(20, None), (21, "unheard of"), (3, "w5 w6"), (None, "w1 w7"), (22, "w1"), (23, " ".join(f"w{i}" for i in range(40)))]
    return docs, items


@pytest.mark.parametrize("pairs, tile_terms, tile_docs", [(1 << 20, 2048, 512), (20, 3, 16)])
def test_equals_plain_scores(spark, monkeypatch, pairs, tile_terms, tile_docs):
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", pairs)
    docs, items = tables(spark)
    frame = spark.createDataFrame([(*d, 1, "p", 2) for d in docs], DOCS).repartition(3)
    got = lexical_search.ranked_search(frame, spark.createDataFrame([(*i, 1, 2) for i in items], ITEMS), top=10)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, items, 10)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical_search.ranked_search(docs.limit(0), items).collect() == []
    assert lexical_search.ranked_search(docs, items.limit(0)).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, " - ")], "doc_id bigint, text string")
    assert lexical_search.ranked_search(nothing, items).collect() == []


def test_tiles_stay_exact_with_heavy_weights():
    """Weights so large that a tile may hold one term only: sums still equal those of Python's integers."""
    weights = np.array([8_000_000_000, 7_999_999_999, 5], np.int64)
    block = lexical_search.Block(None, np.array([0, 3]), np.array([0, 1, 2]), [b"a", b"b", b"c"])
    impacts = np.array([999_999, 999_998, 999_997], np.int64)
    (first, scores), = lexical_search.tile_scores(block, weights, impacts, np.zeros(3, np.int64), np.array([0, 1, 2]), 1)
    assert first == 0 and scores.tolist() == [[sum(int(w) * int(i) for w, i in zip(weights, impacts))]]


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(lexical_search, "PART", 7)
    text = "alpha beta  gamma-delta " * 9 + "longerthantheparts" * 4
    assert lexical_search.term_counts(text.encode()) == Counter(t.encode() for t in terms(text))


def test_best_keeps_ties_by_id():
    best = lexical_search.Best(1, 2)
    best.add(0, np.array([[5, 5, 5]]), np.array([9, 3, 7]), np.zeros(3, bool))
    best.cut()
    best.add(0, np.array([[5, 4]]), np.array([1, 2]), np.zeros(2, bool))
    best.cut()
    assert best.kept[2].tolist() == [1, 3]
