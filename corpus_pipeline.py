"""From raw documents to token ids: quality, line dedup, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept. ``run`` writes each
stage's rows as Parquet in the shared folder and reads them back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm import bpe, lines, mixing, quality, simhash
from tillwatch.llm.common import stored, table
from tillwatch.llm.queries import tokenizer
from tillwatch.session import ship_package


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source; n_chars follows the text."""
    return lines.drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash group."""
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in shuffled order."""
    return mixing.mix(docs).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the bytes decoded from them."""
    path, pattern = tokenizer()
    tokens = bpe.encode(docs.select("doc_id", "source", "lang", "text"), path, pattern, decoded="decoded")
    return bpe.digests(tokens.withColumn("ids", F.col("tokens")))


STAGES = [
    ("quality", good_quality),
    ("lines", without_boilerplate),
    ("near-duplicates", one_of_each_group),
    ("mix", mixed),
    ("encode", encoded),
]

#: Training a classifier is beyond SQL; tests/llm compares with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
