import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tillwatch.llm import bpe
from tillwatch.llm.queries import tokenizer

PATH, PATTERN = tokenizer()


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(7)
    made = ["", " ", "a", "the", "  \n\n x", "don't I'LL 123456   \r\n", "😀é漢字" * 30, "a" * 5000, "ab" * 400, "x" * 64, "y" * 65,
            "<|endoftext|>", "the" * 21, "   z", "é"]
    made += ["".join(draw.choice("abcé \n'st1!😀ßthe") for _ in range(draw.randint(1, 400))) for _ in range(200)]
    return made


def test_same_ids_as_the_library(library):
    many = texts()
    ids, sizes = bpe.Encoder(PATH, PATTERN).encode(many)
    ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
    assert [ids[e - n:e].tolist() for e, n in zip(ends, sizes)] == [library.encode_ordinary(t) for t in many]


def test_long_texts_and_forgetting(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    encoder = bpe.Encoder(PATH, PATTERN)
    many = texts()
    for text in many:
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)
        assert encoder._one_by_one([text])[0].tolist() == library.encode_ordinary(text)
    assert len(encoder.place) <= 20 + max(len(set(encoder.pattern.findall(t))) for t in many)


def test_trees_agree():
    words = bpe.vocabulary(PATH)
    pieces = [p for p in (t.encode() for t in texts()) if 1 <= len(p) <= bpe.SHORT]
    for piece in pieces:
        assert bpe.merge_short([piece], words)[0].tolist() == bpe.merge_long(piece, words)


def test_operator_round_trip(spark, library):
    rows = [(i, t, "x", i) for i, t in enumerate(texts())] + [(None, None, None, None), (3, "again", "x", 1), (3, "again", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, tokens string, decoded bigint")
    got = bpe.encode(docs, PATH, PATTERN, decoded="decoded").collect()
    assert len(got) == len(rows)
    for row in got:
        assert set(row.asDict()) == {"doc_id", "tokens", "decoded", "tokens_", "decoded_"}
    by_id = {r["doc_id"]: r for r in got}
    for i, t in enumerate(texts()):
        if i != 3:
            assert bytes(by_id[i]["decoded_"]).decode() == t and by_id[i]["tokens_"] == library.encode_ordinary(t)
    assert by_id[None]["tokens_"] == [] and bytes(by_id[None]["decoded_"]) == b""
    assert bpe.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_decode_alone_and_digests(spark, library):
    frame = spark.createDataFrame([(1, [464, 1, 2]), (2, []), (3, None), (4, [10 ** 8, -5, 65])], "doc_id bigint, tokens array<int>")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(frame, PATH).collect()}
    assert got == {1: library.decode_bytes([464, 1, 2]), 2: b"", 3: b"", 4: library.decode_bytes([65])}
    text = "Ünder the bridge 42"
    row = bpe.digests(bpe.encode(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), PATH, PATTERN, decoded="decoded")).first()
    ids = library.encode_ordinary(text)
    assert row["n_tokens"] == len(ids)
    assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
