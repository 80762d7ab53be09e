"""Quality classifier by co-training: text content and page metadata teach each other.

Two logistic models see different columns of a document. Each starts from the labelled rows; in each round
a model's confident predictions on unlabelled rows become labels for the other one. In the end both are
calibrated on labelled rows that no model was fitted on, their log-odds are added (less the shared prior),
and every document gets a score.

The text is read once for a short list of numbers per document; all rounds run on that small table, over
all of its rows. Calibration and threshold are those of all held-back labels.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import fresh, lists, stored
from tillwatch.operators.quantiles import exact_quantiles

#: Byte classes whose shares are content features.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t", b".,;:'\"-()",
           b"!", b"?", b"|", b"*#$%&@~^", b"<>[]{}=+/\\_`")
N_CONTENT = len(CLASSES) + 1 + 11
SOURCES, LANGS = 32, 16
_OTHER = len(CLASSES)
_CLASS_OF = np.full(256, _OTHER, np.uint8)
for _i, _bytes in enumerate(CLASSES):
    _CLASS_OF[list(_bytes)] = _i


@dataclass(frozen=True)
class CoTraining:
    """``sure_good``/``sure_bad``: calibrated probabilities that count as confident; ``pseudo_weight``: of
    such a row in a fit; ``keep_good``: share of good held-back rows that the threshold must keep."""

    rounds: int = 2
    sure_good: float = 0.98
    sure_bad: float = 0.1
    pseudo_weight: float = 0.5
    keep_good: float = 0.995
    max_iter: int = 15
    reg: float = 1e-3


@dataclass
class View:
    """A linear model of one view and its calibration (scale, shift)."""

    weights: list[float] = field(default_factory=list)
    bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def margin(self, features: str) -> Column:
        if not self.weights:
            return F.lit(0.0)
        terms = F.zip_with(F.col(features), F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        return F.aggregate(terms, F.lit(self.bias), lambda s, x: s + x)

    def logit(self, features: str) -> Column:
        return F.lit(self.scale) * self.margin(features) + F.lit(self.shift)


@dataclass
class QualityModel:
    content: View
    metadata: View
    prior: float
    threshold: float

    def score(self, content: str, metadata: str) -> Column:
        """Probability of good quality, from both views."""
        logit = self.content.logit(content) + self.metadata.logit(metadata) - F.lit(self.prior)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), logit))))


def content_numbers(text: str) -> list[float]:
    """Shares of byte classes, word and line statistics of one whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    counts = np.bincount(_CLASS_OF[raw], minlength=_OTHER + 1)
    words, lines = text.split(), text.split("\n")
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    seen = Counter(words)
    distinct = len(seen) / n_words
    letters = max(1, int(counts[0] + counts[1]))
    return [*(counts / n).tolist(), counts[0] / letters, math.log1p(len(raw)) / 10, math.log1p(len(words)) / 10,
            len(raw) / n_words / 20, distinct, math.log(max(distinct, 1e-6)) / 5,
            max(seen.values(), default=0) / n_words, sum(map(eq, words, words[1:])) / n_words,
            len(set(lines)) / n_lines, math.log1p(n_words / n_lines) / 5, float(not words)]


def content_features(text: str = "text") -> Column:
    """array<double> of N_CONTENT numbers; a NULL text counts as empty."""
    def numbers(texts: pa.Array) -> pa.Array:
        flat = [x for t in texts.to_pylist() for x in content_numbers(t or "")]
        return lists(np.array(flat, float), [N_CONTENT] * len(texts), pa.float64())

    return F.arrow_udf(numbers, "array<double>")(F.col(f"`{text}`").cast("string"))


def metadata_features(source: str = "source", lang: str = "lang", n_chars: str = "n_chars") -> Column:
    """array<double> from the page's source, language and size; NULLs have places of their own."""
    def one_hot(name: str, buckets: int) -> Column:
        place = F.when(F.col(name).isNull(), F.lit(buckets)).otherwise(F.pmod(F.xxhash64(name), F.lit(buckets)))
        return F.transform(F.sequence(F.lit(0), F.lit(buckets)), lambda i: (i == place).cast("double"))

    size = F.ln(F.greatest(F.coalesce(F.col(n_chars).cast("double"), F.lit(0.0)), F.lit(0.0)) + 1) / 10
    bends = [F.greatest(size - F.lit(k), F.lit(0.0)) for k in (0.55, 0.65, 0.75, 0.85)]
    return F.concat(one_hot(source, SOURCES), one_hot(lang, LANGS),
                    F.array(size, F.col(n_chars).isNull().cast("double"), *bends))


def _fit(rows: DataFrame, features: str, spec: CoTraining) -> View:
    """Logistic regression on (y, weight, features); without both classes, a view that says nothing."""
    if rows.select("y").distinct().count() < 2:
        return View()
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", maxIter=spec.max_iter,
                               regParam=spec.reg).fit(
        rows.select("y", "weight", array_to_vector(features).alias("x")))
    return View(model.coefficients.toArray().tolist(), float(model.intercept))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make ``margin`` log-odds of ``y``, by Newton steps with a small ridge."""
    x = np.stack([margin, np.ones(len(margin))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - y) + 1e-3 * (at - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), slope)
        at = at - step
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def platt_of(rows: DataFrame, margins: list[str], y: str = "y") -> list[tuple[float, float]]:
    """``platt`` of each margin column over all rows of a stored table: every Newton step is one aggregation."""
    at, going = [np.array([1.0, 0.0]) for _ in margins], set(range(len(margins)))
    for _ in range(25):
        sums = []
        for i in sorted(going):
            x = F.col(margins[i])
            logit = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x * float(at[i][0]) + float(at[i][1])))
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
            off, bend = p - F.col(y), p * (F.lit(1.0) - p)
            sums += [F.coalesce(F.sum(c), F.lit(0.0)).alias(f"s{i}_{k}") for k, c in enumerate((x * off, off, x * x * bend, x * bend, bend))]
        found = rows.agg(*sums).first()
        for i in sorted(going):
            a, b, xx, x1, one = (found[f"s{i}_{k}"] for k in range(5))
            slope = np.array([a, b]) + 1e-3 * (at[i] - [1.0, 0.0])
            step = np.linalg.solve(np.array([[xx, x1], [x1, one]]) + 1e-3 * np.eye(2), slope)
            at[i] = at[i] - step
            if np.abs(step).max() < 1e-8:
                going.discard(i)
        if not going:
            break
    return [(float(a), float(b)) for a, b in at]


def _calibrate(views: tuple[View, View], rows: DataFrame, prior: float) -> None:
    judged = stored(rows.select("y", views[0].margin("content").alias("a"), views[1].margin("metadata").alias("b")), "calibration")
    for view in views:
        view.scale, view.shift = 0.0, prior
    told = [(view, name) for view, name in zip(views, "ab") if view.weights]
    if told and judged.select("y").distinct().count() == 2:
        for (view, _), found in zip(told, platt_of(judged, [name for _, name in told])):
            view.scale, view.shift = found


def train(features: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining()) -> QualityModel:
    """Co-train on (doc_id, content, metadata) and labels (doc_id, quality).

    A document labelled several times counts by the mean. Labels that are NULL, or of unknown documents,
    are not used. Without labels of both kinds every score is the prior and everything is kept.
    """
    votes = (labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
             .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("double").alias("y")))
    held = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(5)) == 0
    rows = stored(features.select("doc_id", "content", "metadata").join(votes, "doc_id", "left")
                  .withColumn("held", held), "co-training")
    known = rows.filter("y IS NOT NULL")
    good, n = known.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.count("y")).first()
    prior = math.log((good + 1) / (n - good + 1))
    fitting = known.filter(~F.col("held")).select("doc_id", "y", F.lit(1.0).alias("weight"), "content", "metadata")
    tuning = known.filter("held")
    views = (_fit(fitting, "content", spec), _fit(fitting, "metadata", spec))
    _calibrate(views, tuning, prior)
    unknown = rows.filter("y IS NULL")
    for _ in range(spec.rounds if views[0].weights else 0):
        taught = []
        for teacher, its, learner in ((views[1], "metadata", "content"), (views[0], "content", "metadata")):
            p = F.lit(1.0) / (F.lit(1.0) + F.exp(-teacher.logit(its)))
            sure = unknown.withColumn("p", p).filter((F.col("p") >= spec.sure_good) | (F.col("p") <= spec.sure_bad))
            pseudo = sure.select("doc_id", (F.col("p") >= spec.sure_good).cast("double").alias("y"),
                                 F.lit(spec.pseudo_weight).alias("weight"), "content", "metadata")
            taught.append(_fit(fitting.unionByName(pseudo), learner, spec))
        views = tuple(taught)
        _calibrate(views, tuning, prior)
    model = QualityModel(*views, prior, 0.0)
    if views[0].weights:
        scores = stored(tuning.filter("y = 1").select(model.score("content", "metadata").alias("score")), "held-scores")
        low = exact_quantiles(scores, "score", {"low": round(1 - spec.keep_good, 12)}).first()["low"]
        model.threshold = 0.0 if low is None else min(0.5, low)
    return model


def featured(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), content_features().alias("content"),
                       metadata_features().alias("metadata"))


def quality_scores(docs: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining()) -> DataFrame:
    """(doc_id, content_score, metadata_score, score, keep) for each row of ``docs``."""
    features = stored(featured(docs), "quality-features")
    model = train(features, labels, spec)
    p = [F.lit(1.0) / (F.lit(1.0) + F.exp(-v.logit(c)))
         for v, c in ((model.content, "content"), (model.metadata, "metadata"))]
    return features.select("doc_id", p[0].alias("content_score"), p[1].alias("metadata_score"),
                           model.score("content", "metadata").alias("score")).withColumn(
        "keep", F.col("score") >= F.lit(model.threshold))


def keep_good(docs: DataFrame, labels: DataFrame, spec: CoTraining = CoTraining()) -> DataFrame:
    """``docs`` without those that the classifier rejects; the texts are read twice and never shuffled."""
    model = train(featured(docs), labels, spec)
    a, b = fresh(docs, "_content"), fresh(docs, "_metadata")
    return (docs.withColumn(a, content_features()).withColumn(b, metadata_features())
            .filter(model.score(a, b) >= F.lit(model.threshold)).drop(a, b))
