import random

import numpy as np
import xxhash

from tillwatch.llm import simhash

SCHEMA = "doc_id bigint, text string, fp string, component_id string"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c == " " or 9 <= ord(c) <= 13:
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(prints))]


def documents():
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Éa b c d"), (None, "one"), (4, "one")]
    for k in range(25):
        base = [draw.choice(words) for _ in range(draw.randint(3, 200))]
        for i in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((100 * k + 10 + i, draw.choice([" ", "\n", "  "]).join(copy)))
    return rows


def test_groups_like_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    want_fp = [plain_fingerprint(t) for _, t in rows]
    want = sorted(zip([str(i) for i, _ in rows], [f"{f:016x}" for f in want_fp], components(want_fp, [i for i, _ in rows])))
    for limit in (4096, 2):
        got = [(str(r[0]), r[1], r[2]) for r in simhash.simhash_groups(docs, limit=limit).collect()]
        assert sorted(got) == want


def test_words_across_chunks(monkeypatch):
    text = " ".join(f"w{i % 37}x{i % 11}" for i in range(500))
    want = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint(text.encode()) == want == plain_fingerprint(text)


def test_index_finds_every_pair_within_three_bits(spark):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 63, 40, np.int64)
    made = [int(b) for b in base]
    for b in base:
        flip = 0
        for bit in draw.choice(63, 3, replace=False):
            flip |= 1 << int(bit)
        made.append(int(b) ^ flip)
    prints = spark.createDataFrame([(f,) for f in set(made)], "fp bigint")
    for limit in (4096, 3):
        links = {frozenset(r) for r in simhash.fingerprint_links(prints, limit).collect()}
        assert {frozenset((made[i], made[i + 40])) for i in range(40)} <= links


def test_keep_one(spark):
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string")
    groups = simhash.simhash_groups(docs).collect()
    kept = [r["doc_id"] for r in simhash.keep_one(docs).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({r["component_id"] for r in groups})
    assert kept.count(None) == 1
    assert simhash.keep_one(docs.limit(0)).count() == 0 and simhash.simhash_groups(docs.limit(0)).count() == 0


def test_keep_one_of_each_group_where_ids_repeat(spark):
    one, two = "the cat sat on the mat and looked at the dog", "shares fell sharply on weak demand for copper and tin"
    rows = [(1, one, "a"), (1, two, "b"), (2, two, "c"), (3, one, "d"), (1, one, "a"), (5, "", "e"), (None, one, "f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, content string")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([rows[0], rows[1], rows[5], rows[6]], key=str)
    renamed = simhash.keep_one(docs.withColumnsRenamed({"doc_id": "id", "text": "body"}), doc_id="id", text="body")
    assert renamed.count() == 4
