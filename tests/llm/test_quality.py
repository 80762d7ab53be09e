import random

import numpy as np
import pytest

from tillwatch.llm import quality


def documents(n=400):
    draw = random.Random(1)
    words = ["".join(draw.choice("abcdefghijklmn") for _ in range(draw.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = " ".join(draw.choice(words) for _ in range(draw.randint(20, 200)))
        if bad:
            text = draw.choice([text.upper().replace(" ", "!! "), " ".join([draw.choice(words)] * 80), text.replace(" ", "*** ")])
        rows.append((i, text, "en", "spam" if bad and i % 8 else "site", len(text), "c", "m"))
        if i % 2 == 0:
            labels.append((i, 0 if bad else 1, 0))
    return rows, labels


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, content string, metadata string"
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def data(spark):
    rows, labels = documents()
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)


def test_held_out_documents(data):
    scores = {r["doc_id"]: r for r in quality.quality_scores(*data).collect()}
    unseen = [i for i in scores if i % 2 == 1]
    known = [i for i in scores if i % 2 == 0]
    assert sum(scores[i]["keep"] == (i % 4 != 0) for i in known) >= 0.97 * len(known)
    assert sum(scores[i]["keep"] for i in unseen) >= 0.97 * len(unseen)


def test_filter_agrees_with_scores_and_keeps_columns(data):
    docs, labels = data
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in quality.quality_scores(docs, labels).collect() if r["keep"]}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_odd_rows_and_labels(spark, data):
    docs, labels = data
    odd = spark.createDataFrame([(None, None, None, None, None, None, None), (900, "", "", "", 0, "", ""), (900, "", "", "", 0, "", ""),
                                 (901, "é" * 5000, "en", None, -3, "x", "y"), (902, "!" * 100_000, None, "site", None, None, None)], SCHEMA)
    more = labels.unionByName(spark.createDataFrame([(2, None, None), (None, 1, 0), (2, 1, 0), (2, 1, 1), (7777, 0, 0)], LABELS))
    got = quality.quality_scores(docs.unionByName(odd), more).collect()
    assert len(got) == 405 and all(0 <= r["score"] <= 1 and r["keep"] is not None for r in got)


def test_without_labels_everything_stays(data):
    docs, labels = data
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()
    assert quality.keep_good(docs, labels.filter("quality = 1")).count() == docs.count()
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_calibration():
    draw = np.random.default_rng(4)
    margin = draw.normal(size=20_000)
    y = (draw.random(20_000) < 1 / (1 + np.exp(-(2.5 * margin - 1)))).astype(float)
    scale, shift = quality.platt(margin, y)
    assert abs(scale - 2.5) < 0.15 and abs(shift + 1) < 0.1


def test_confident_metadata_teaches_the_content_view(spark):
    rows, _ = documents()
    # only pages of a source that tells the quality are labelled; the other source is left to the exchange
    labels = [(r[0], 0 if r[0] % 4 == 0 else 1, 0) for r in rows if r[0] % 3 == 0]
    docs = spark.createDataFrame(rows, SCHEMA)
    for rounds in (0, 2):
        scores = quality.quality_scores(docs, spark.createDataFrame(labels, LABELS), quality.CoTraining(rounds=rounds)).collect()
        right = np.mean([(r["content_score"] >= 0.5) == (r["doc_id"] % 4 != 0) for r in scores])
        assert right >= 0.9


def test_calibration_and_threshold_use_every_held_back_label(spark, monkeypatch):
    draw = np.random.default_rng(4)
    margin = draw.normal(size=30_000)
    y = (draw.random(30_000) < 1 / (1 + np.exp(-(2.5 * margin - 1)))).astype(float)
    rows = spark.createDataFrame([(float(a), float(-a), float(b)) for a, b in zip(margin, y)], "m double, n double, y double")
    (a, b), (c, d) = quality.platt_of(rows, ["m", "n"])
    assert (a, b) == pytest.approx(quality.platt(margin, y)) and (c, d) == pytest.approx((-a, b))
