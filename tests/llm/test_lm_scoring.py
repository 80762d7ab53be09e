import math
from collections import Counter

import pytest

from tillwatch.llm import lm_scoring

SCHEMA = "doc_id bigint, text string, score string, n_tokens string"
DOCS = [(1, "The cat sat on the mat"), (2, "the dog sat\ton the  log\n"), (3, None), (4, " \n"), (5, "a"), (None, "zebra the cat"),
        (6, "the cat sat on the mat"), (6, "the cat sat on the mat"), (7, "ÄPFEL äpfel Ärger the")]
TARGET = [("the cat sat",), (None,), ("on the mat the cat",)]


def split(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def plain(docs, target, spec):
    words = {w for _, t in docs for w in split(t)}
    names = words | {None}

    def grams(text):
        ids = [w if w in words else None for w in split(text)]
        return list(zip(["<s>"] + ids, ids))

    def model(texts):
        two = Counter(g for t in texts for g in grams(t))
        one, before = Counter(), Counter()
        for (v, w), n in two.items():
            one[w] += n
            before[v] += n
        total = sum(one.values()) + spec.add * len(names)

        def loss(v, w):
            return -math.log((two[v, w] + spec.prior * (one[w] + spec.add) / total) / (before[v] + spec.prior))
        return loss

    aim, all_of_it = model([t for t, in target]), model([t for _, t in docs])
    out = []
    for i, t in docs:
        g = grams(t)
        if not g:
            out.append((str(i), 0, None, None))
        else:
            out.append((str(i), len(g), sum(aim(*x) for x in g) / len(g), sum(all_of_it(*x) for x in g) / len(g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("spec", [lm_scoring.Bigrams(), lm_scoring.Bigrams(add=0.1, prior=2.0, words=4, bigrams=3),
                                  lm_scoring.Bigrams(words=0, bigrams=0)])
@pytest.mark.parametrize("target", [TARGET + [("yeti the cat yeti",)], []])
def test_like_plain_loops(spark, spec, target):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in DOCS], SCHEMA)
    got = lm_scoring.cross_entropy_difference(docs, spark.createDataFrame(target, "text string"), spec).collect()
    rows = sorted([(str(r["doc_id"]), r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got], key=str)
    want = plain(DOCS, target, spec)
    assert [r[:2] for r in rows] == [w[:2] for w in want]
    for r, w in zip(rows, want):
        assert r[2:] == w[2:] or (r[2] == pytest.approx(w[2]) and r[3] == pytest.approx(w[3]))
    assert all((r["score"] is None) == (r["n_tokens"] == 0) or r["score"] == pytest.approx(r["target_loss"] - r["background_loss"]) for r in got)


def test_target_texts_score_lower(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat " * 5), (2, "shares fell on weak demand " * 5)], "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.cross_entropy_difference(docs, spark.createDataFrame(TARGET, "text string")).collect()}
    assert got[1] < got[2]


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert lm_scoring.cross_entropy_difference(docs, spark.createDataFrame(TARGET, "text string")).count() == 0


@pytest.mark.parametrize("words, bigrams", [(1 << 16, 1 << 20), (30, 0), (40, 5), (0, 0)])
def test_every_word_and_bigram_counts(spark, words, bigrams):
    """What is broadcast and what is dealt out changes no score: rare words and bigrams have losses of their own."""
    rows = DOCS + [(100 + i, " ".join(f"w{i}x{j}" for j in range(20)) + " the cat" * (i % 4)) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spec = lm_scoring.Bigrams(words=words, bigrams=bigrams)
    got = lm_scoring.cross_entropy_difference(docs, spark.createDataFrame(TARGET, "text string"), spec).collect()
    got = sorted([(str(r["doc_id"]), r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got], key=str)
    want = plain(rows, TARGET, spec)
    assert [r[:2] for r in got] == [w[:2] for w in want]
    for r, w in zip(got, want):
        assert r[2:] == w[2:] or r[2:] == pytest.approx(w[2:])
