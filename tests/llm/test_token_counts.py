import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillwatch.llm import token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rnd = random.Random(3)
    pieces = ["the", "word", " ", "  ", "\n", "\t", "▁", "é", "中文字", "😀", "<s>", "</s>", "<unk>", "1234", "x" * 90, "\x00", "don't", " ", "　", "a▁b", "ﬁ"]
    made = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    return made + ["", " ", "   ", "▁", " a", "a ", "a  b", "  a  ", "x" * 5000, "a " * 3000, "word " * 400_000, "\n \n"]


@pytest.mark.parametrize("part", [1 << 20, 5])
def test_equals_the_library(spark, library, monkeypatch, part):
    monkeypatch.setattr(token_counts, "PART", part)
    rows = [(i, t, 5, "x") for i, t in enumerate(texts())] + [(None, None, 1, "x"), (None, "same", 1, "x"), (1, "same", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, text_ string")
    got = token_counts.count_tokens(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "text_", "n_tokens_"]
    want = sorted(((str(i), len(library.encode(t or ""))) for i, t, *_ in rows))
    assert sorted((str(r[0]), r[3]) for r in got.collect()) == want


def test_parts_of_a_text_are_its_pre_tokens(monkeypatch):
    for text in texts():
        whole = [w for part in token_counts.parts(text) for w in part]
        monkeypatch.setattr(token_counts, "PART", 1)
        assert [w for part in token_counts.parts(text) for w in part] == whole
        monkeypatch.undo()


def test_without_the_frequent_table_the_counts_are_the_same(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    full = token_counts.count_tokens(docs, PATH).collect()
    monkeypatch.setattr(token_counts, "FREQUENT", 0)
    monkeypatch.setattr(token_counts, "REMEMBERED", 10)
    assert sorted(token_counts.count_tokens(docs, PATH).collect()) == sorted(full)


def test_nothing_is_shuffled(spark, folder):
    plan = entry.queries()["op13_token_counts"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_empty_table(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id bigint, text string"), PATH).collect() == []


def test_registered_query_equals_the_library(spark, folder, library):
    got = entry.queries()["op13_token_counts"](spark, folder)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("text", F.coalesce("text", F.lit("")))
    want = {r["doc_id"]: (len(r["text"].encode()), len(library.encode(r["text"]))) for r in docs.collect()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got.collect()} == want
    assert got.filter("over_limit <> (n_tokens > 4096)").isEmpty()
