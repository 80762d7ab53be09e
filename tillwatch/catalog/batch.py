"""Cleaning, features, evaluation, sampling, files."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.catalog.inputs import (
    labelled_scores,
    order_transactions,
    run_metrics,
    scored,
    steady,
    steady_sql,
    transactions,
    with_parts,
)
from tillwatch.catalog.registry import query
from tillwatch.functions.decisions import decide
from tillwatch.functions.predicates import reject_reason
from tillwatch.operators import cleaning, entity_features, evaluation, history, quality, quantiles, sampling
from tillwatch.operators.skew import HotKeys
from tillwatch.plans import training
from tillwatch.plans.amount_history import EntityHistories
from tillwatch.plans.amount_sketches import RANK_ERROR, AmountSketches
from tillwatch.schema import FEATURE_COLUMNS, TRANSACTION_COLUMNS
from tillwatch.session import scratch_path
from tillwatch.sources import incremental, metrics
from tillwatch.sources import transactions as tx_io
from tillwatch.sources.paths import signature

DAY = 86_400
TX = ", ".join(TRANSACTION_COLUMNS)


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    raw = transactions(spark, folder)
    return cleaning.clean(raw, quantiles.amount_stats(raw, exact=True))


_KEPT: dict[tuple, str] = {}


def _once(spark: SparkSession, folder: str, name: str, tables: list[str], make) -> str:
    """Path of what ``make(path)`` wrote for these tables in this session; Spark deletes it at the end.

    The key holds the state of the tables' files, so a table that was written anew counts as another one.
    """
    state = tuple(signature(spark, f"{folder}/{table}.parquet") for table in tables)
    place = (spark.sparkContext.applicationId, folder, name, state)
    if place not in _KEPT:
        path = scratch_path(spark, name)
        make(path)
        _KEPT[place] = path
    return _KEPT[place]


def _table_once(spark: SparkSession, folder: str, name: str, tables: list[str], rows) -> DataFrame:
    return tx_io.read_clean(spark, _once(spark, folder, name, tables, lambda path: tx_io.write_clean(rows(), path)))


def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned rows as the table the later jobs read."""
    return _table_once(spark, folder, "clean-table", ["events"], lambda: cleaned(spark, folder))


def order_table(spark: SparkSession, folder: str) -> DataFrame:
    """The order transactions as a table: the feature jobs read their input more than once."""
    return _table_once(spark, folder, "order-table", ["lineitem", "orders"], lambda: order_transactions(spark, folder))


def kept_table(spark: SparkSession, folder: str) -> DataFrame:
    """Valid rows, one per id, amounts as they came; written once, as the history jobs read it often."""
    return _table_once(spark, folder, "kept-table", ["events"], lambda: cleaning.dedupe_first(
        transactions(spark, folder).filter(cleaning.is_keepable())))


#: The clean table comes in two loads: the days that models are trained on, and those after them.
EARLY, LATE = "tx_time_days < 20", "NOT coalesce(tx_time_days < 20, false)"


def entity_histories(spark: SparkSession, folder: str) -> EntityHistories:
    """Running amounts of customers and terminals, extended by both loads of the clean table."""
    def make(path: str) -> None:
        clean, histories = clean_table(spark, folder), EntityHistories(spark, path)
        histories.extend(clean.filter(EARLY), "early")
        histories.extend(clean.filter(LATE), "late")

    return EntityHistories(spark, _once(spark, folder, "entity-histories", ["events"], make))


# ----- profile -----

BAD_DATE = "TRY_CAST(tx_datetime AS TIMESTAMP) IS NULL"
PROFILE = (f"count(*) AS row_count, count(*) FILTER ({BAD_DATE}) AS bad_dates, "
           "count(*) FILTER (tx_amount <= 0) AS nonpositive_amounts, "
           "count(*) FILTER (tx_fraud NOT IN (0, 1)) AS invalid_labels, "
           "count(*) FILTER (tx_fraud IS NULL) AS null_labels")


@query(with_parts(f"SELECT {PROFILE} FROM tx_raw", "tx_raw"))
def quality_profile(spark, folder):
    return quality.quality_profile(transactions(spark, folder))


@query(with_parts("SELECT " + ", ".join(
    f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS {c}" for c in TRANSACTION_COLUMNS) + " FROM tx_raw", "tx_raw"))
def null_profile(spark, folder):
    return quality.null_profile(transactions(spark, folder))


@query(with_parts("SELECT transaction_id, count(*) AS copies FROM tx_raw GROUP BY 1 HAVING count(*) > 1", "tx_raw"))
def duplicate_ids(spark, folder):
    return quality.duplicate_ids(transactions(spark, folder))


@query(with_parts(f"SELECT {PROFILE}, (SELECT count(*) FROM (SELECT 1 FROM tx_raw GROUP BY transaction_id "
                  "HAVING count(*) > 1)) AS duplicated_ids FROM tx_raw", "tx_raw"))
def load_report(spark, folder):
    return quality.load_report(transactions(spark, folder))


@query(with_parts("SELECT q1, q3, median, lower, upper FROM tx_stats", "tx_stats"))
def iqr_bounds(spark, folder):
    return quantiles.amount_stats(transactions(spark, folder), exact=True)


@query(with_parts("SELECT count(*) AS rows, true AS q1_within, true AS q3_within, true AS median_within, true AS same_by_tree "
                  "FROM tx_raw", "tx_raw"))
def iqr_bounds_approximate(spark, folder):
    """Sketched quantiles: their ranks among all rows lie within the promised error."""
    rows = transactions(spark, folder)
    quartiles, median, tree = quantiles.approx_quartiles(rows), quantiles.approx_median(rows), quantiles.amount_stats_by_tree(rows)
    placed = rows.select("tx_amount", *[table.select(c).scalar().alias(n) for n, table, c in (
        ("q1", quartiles, "q1"), ("q3", quartiles, "q3"), ("median", median, "median"),
        ("t1", tree, "q1"), ("t3", tree, "q3"), ("tm", tree, "median"))])
    known = F.count("tx_amount")

    def within(value, share, error):
        below, upto = F.count_if(F.col("tx_amount") < F.col(value)), F.count_if(F.col("tx_amount") <= F.col(value))
        return (below <= (share + error) * known + 1) & (upto >= (share - error) * known - 1)

    quarter, half = 1 / quantiles.QUARTILE_ACCURACY, quantiles.MEDIAN_ERROR
    return placed.agg(
        F.count(F.lit(1)).alias("rows"), within("q1", 0.25, quarter).alias("q1_within"),
        within("q3", 0.75, quarter).alias("q3_within"), within("median", 0.5, half).alias("median_within"),
        (within("t1", 0.25, quarter) & within("t3", 0.75, quarter) & within("tm", 0.5, half)).alias("same_by_tree"))


@query(with_parts("SELECT tx_time_days < 20 AS early, count(*) AS n, true AS fences_within FROM tx_raw WHERE tx_amount IS NOT NULL GROUP BY 1", "tx_raw"))
def period_fences(spark, folder):
    """Quartiles and median of two periods from daily sketches: their ranks among the period's rows lie within the error."""
    rows = transactions(spark, folder)
    sketches = AmountSketches(spark, scratch_path(spark, "sketches"))
    for name, load in (("early", EARLY), ("late", LATE)):
        sketches.extend(rows.filter(load), name)
    out = []
    for early, first, last in ((True, None, 19), (False, 20, None)):
        found = sketches.stats(first, last)
        placed = rows.filter(f"(tx_time_days < 20) = {early} AND tx_amount IS NOT NULL").select(
            "tx_amount", *[found.select(c).scalar().alias(c) for c in ("q1", "median", "q3")])
        within = [(F.count_if(F.col("tx_amount") < F.col(c)) <= (share + RANK_ERROR) * F.count("tx_amount"))
                  & (F.count_if(F.col("tx_amount") <= F.col(c)) >= (share - RANK_ERROR) * F.count("tx_amount"))
                  for c, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))]
        counted = sketches.distribution([0.0], first, last).select("n").scalar()
        out.append(placed.agg((within[0] & within[1] & within[2]).alias("fences_within"), F.max(counted).alias("n"))
                   .select(F.lit(early).alias("early"), "n", "fences_within"))
    return out[0].unionByName(out[1])


@query(with_parts("SELECT tx_fraud, count(*) AS rows, "
                  "CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM tx_raw) AS share FROM tx_raw GROUP BY 1", "tx_raw"))
def class_balance(spark, folder):
    return quality.class_balance(transactions(spark, folder))


@query(with_parts("""SELECT CASE WHEN tx_amount < -100 THEN 0 WHEN tx_amount >= 400 THEN 51
  ELSE CAST(floor((tx_amount + 100) / 10) AS BIGINT) + 1 END AS bin, count(*) AS rows
  FROM tx_raw WHERE tx_amount IS NOT NULL GROUP BY 1""", "tx_raw"))
def feature_histogram(spark, folder):
    return quality.histogram(transactions(spark, folder), "tx_amount", -100.0, 400.0, 50)


def _summary_sql(column: str) -> str:
    return (f"SELECT '{column}' AS \"column\", count({column}) AS known, count(*) FILTER ({column} IS NULL) AS nulls, "
            f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
            f"{steady_sql(f'avg({column})')} AS mean, {steady_sql(f'stddev_samp({column})')} AS std FROM tx_raw")


@query(with_parts(" UNION ALL ".join(_summary_sql(c) for c in ("tx_amount", "tx_time_seconds", "tx_fraud")), "tx_raw"))
def feature_distributions(spark, folder):
    out = quality.column_summary(transactions(spark, folder), ["tx_amount", "tx_time_seconds", "tx_fraud"])
    return out.withColumns({"mean": steady(F.col("mean")), "std": steady(F.col("std"))})


@query(with_parts(f"""SELECT transaction_id, CASE WHEN transaction_id IS NULL THEN 'missing_id'
  WHEN {BAD_DATE} THEN 'bad_date' WHEN tx_fraud IS NULL OR tx_fraud NOT IN (0, 1) THEN 'bad_label'
  WHEN coalesce(customer_id, -1) < 0 THEN 'bad_customer' WHEN coalesce(terminal_id, -1) < 0 THEN 'bad_terminal'
  WHEN tx_amount IS NULL THEN 'missing_amount' WHEN tx_amount <= 0 THEN 'nonpositive_amount' END AS reject_reason
  FROM tx_raw""", "tx_raw"))
def validate_row(spark, folder):
    return transactions(spark, folder).select("transaction_id", reject_reason().alias("reject_reason"))


# ----- clean -----

@query(with_parts(f"SELECT {TX} FROM tx_clean", "tx_clean"))
def clean(spark, folder):
    return cleaned(spark, folder)


@query(with_parts(f"SELECT {TX.replace('tx_amount', 'coalesce(tx_amount, median) AS tx_amount')} FROM tx_clean",
                  "tx_clean"))
def clean_impute_nulls(spark, folder):
    raw = transactions(spark, folder)
    return cleaning.clean(raw, quantiles.amount_stats(raw, exact=True), handle_null="impute")


@query(with_parts(f"SELECT {TX} FROM tx_clean WHERE tx_amount IS NOT NULL", "tx_clean"))
def clean_drop_nulls(spark, folder):
    raw = transactions(spark, folder)
    return cleaning.clean(raw, quantiles.amount_stats(raw, exact=True), handle_null="drop")


@query(with_parts(f"SELECT DISTINCT {TX} FROM tx_raw", "tx_raw"))
def dedupe_any(spark, folder):
    """Copies in this table are exact, so any kept row is the same row."""
    return cleaning.dedupe_any(transactions(spark, folder))


@query(with_parts(f"""SELECT {TX} FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
  ORDER BY tx_time_seconds, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_days, tx_fraud) AS rn
  FROM tx_big) WHERE rn = 1""", "tx_big"))
def dedupe_first(spark, folder):
    return cleaning.dedupe_first(order_transactions(spark, folder))


# ----- features -----

RATIO = "tx_amount / CASE WHEN a <= 0 THEN CAST(1 AS DOUBLE) ELSE a END"


def _entity_sql(table: str) -> str:
    return (f"SELECT {TX}, {steady_sql('a')} AS avg_customer_amount, c AS customer_tx_count, "
            f"{steady_sql('ta')} AS avg_terminal_amount, tc AS terminal_tx_count, "
            f"{steady_sql(RATIO)} AS customer_amount_ratio FROM (SELECT *, "
            "avg(tx_amount) OVER (PARTITION BY customer_id) AS a, count(tx_amount) OVER (PARTITION BY customer_id) AS c, "
            "avg(tx_amount) OVER (PARTITION BY terminal_id) AS ta, count(tx_amount) OVER (PARTITION BY terminal_id) AS tc "
            f"FROM {table})")


def _steady_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: steady(F.col(c)) for c in
                           ("avg_customer_amount", "avg_terminal_amount", "customer_amount_ratio")})


@query(with_parts(_entity_sql("tx_clean"), "tx_clean"))
def customer_terminal_features(spark, folder):
    return _steady_features(entity_features.customer_terminal_features(clean_table(spark, folder)))


@query(with_parts(_entity_sql("tx_big"), "tx_big"))
def customer_terminal_features_orders(spark, folder):
    return _steady_features(entity_features.customer_terminal_features(order_table(spark, folder)))


# Low limits: the paths for hot keys, which tables of this size would not need.
SPLIT_EARLY = HotKeys(rows_per_task=50, max_keys=100_000)


@query(with_parts(_entity_sql("tx_big"), "tx_big"))
def customer_terminal_features_hot_keys(spark, folder):
    return _steady_features(entity_features.customer_terminal_features(
        order_table(spark, folder), SPLIT_EARLY))


@query(with_parts(_entity_sql("tx_clean"), "tx_clean"))
def customer_terminal_windows(spark, folder):
    """The plain two-window plan."""
    return _steady_features(entity_features.customer_terminal_features(clean_table(spark, folder), as_window=True))


FRAMES = {"1d": DAY, "7d": 7 * DAY, "30d": 30 * DAY}


def _past_sql(key: str, prefix: str) -> str:
    parts = []
    for name, length in FRAMES.items():
        over = f"OVER (PARTITION BY {key} ORDER BY tx_time_seconds RANGE BETWEEN {length} PRECEDING AND 1 PRECEDING)"
        parts.append(f"count(tx_amount) {over} AS {prefix}_tx_count_{name}, "
                     f"{steady_sql(f'avg(tx_amount) {over}', 5)} AS {prefix}_avg_amount_{name}")
    return ", ".join(parts)


PAST_SQL = with_parts(f"SELECT transaction_id, {_past_sql('customer_id', 'customer')}, "
                      f"{_past_sql('terminal_id', 'terminal')} FROM tx_kept", "tx_kept")


def _past_only(spark: SparkSession, folder: str, **options) -> DataFrame:
    slim = kept_table(spark, folder).select("transaction_id", "customer_id", "terminal_id", "tx_time_seconds",
                                            "tx_amount")
    out = history.past_only_features(slim, slim, "customer_id", FRAMES, "customer", **options)
    out = history.past_only_features(out, slim, "terminal_id", FRAMES, "terminal", **options)
    made = [c for c in out.columns if "_tx_count_" in c or "_avg_amount_" in c]
    return out.select("transaction_id", *[steady(F.col(c), 5).alias(c) if "_avg_" in c else F.col(c) for c in made])


@query(PAST_SQL)
def past_only_features(spark, folder):
    return _past_only(spark, folder)


@query(PAST_SQL)
def past_only_features_busy_keys(spark, folder):
    """Running sums for every key with more than 60 rows, hot keys above 50."""
    return _past_only(spark, folder, hot_keys=SPLIT_EARLY, sliding_rows=60)


@query(with_parts("SELECT transaction_id, " + ", ".join(
    f"count(*) OVER (PARTITION BY customer_id ORDER BY tx_time_seconds RANGE BETWEEN {n} PRECEDING AND CURRENT ROW) "
    f"AS customer_tx_last_{name}" for name, n in {"10m": 600, "1h": 3600, "1d": DAY}.items()) + " FROM tx_kept",
    "tx_kept"))
def tx_frequency(spark, folder):
    slim = kept_table(spark, folder).select("transaction_id", "customer_id", "tx_time_seconds", "tx_amount")
    out = history.tx_frequency(slim, slim, "customer_id", {"10m": 600, "1h": 3600, "1d": DAY}, "customer")
    return out.select("transaction_id", *[c for c in out.columns if "_last_" in c])


# ----- scaling, sampling -----

def feature_frame(spark: SparkSession, folder: str) -> DataFrame:
    rows = entity_features.customer_terminal_features(clean_table(spark, folder))
    return training.without_nulls(rows.select("transaction_id", *FEATURE_COLUMNS, "tx_fraud"), "drop")


FEATURE_SQL = (f"SELECT transaction_id, tx_fraud, tx_amount, tx_time_seconds, tx_time_days, a AS avg_customer_amount, "
               f"c AS customer_tx_count, ta AS avg_terminal_amount, tc AS terminal_tx_count, "
               f"{RATIO} AS customer_amount_ratio FROM (SELECT *, "
               "avg(tx_amount) OVER (PARTITION BY customer_id) AS a, count(tx_amount) OVER (PARTITION BY customer_id) AS c, "
               "avg(tx_amount) OVER (PARTITION BY terminal_id) AS ta, count(tx_amount) OVER (PARTITION BY terminal_id) AS tc "
               "FROM tx_clean) WHERE tx_amount IS NOT NULL")


@query(with_parts(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {steady_sql(f'avg({c})', 5)} AS mean, {steady_sql(f'stddev_samp({c})', 5)} AS std "
    f"FROM ({FEATURE_SQL})" for c in FEATURE_COLUMNS), "tx_clean"))
def standardise(spark, folder):
    out = training.standardise_stats(feature_frame(spark, folder))
    return out.withColumns({"mean": steady(F.col("mean"), 5), "std": steady(F.col("std"), 5)})


@query(with_parts("SELECT transaction_id, " + ", ".join(
    f"{steady_sql(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()', 5)} AS {c}" for c in FEATURE_COLUMNS)
    + f" FROM ({FEATURE_SQL})", "tx_clean"))
def standardised_features(spark, folder):
    """The fitted assemble-and-scale pipeline, its vector unpacked."""
    frame = feature_frame(spark, folder)
    ready = training.preparation().fit(frame).transform(frame)
    values = ready.select("transaction_id", vector_to_array("scaled_features").alias("v"))
    return values.select("transaction_id", *[steady(F.col("v")[i], 5).alias(c) for i, c in enumerate(FEATURE_COLUMNS)])


PLACE = "CAST(('0x' || substr(md5(concat('42:', transaction_id)), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


@query(with_parts(f"SELECT {TX} FROM tx_raw WHERE {PLACE} < CAST(0.1 AS DOUBLE)", "tx_raw"))
def sample_by_key(spark, folder):
    return sampling.sample_by_key(transactions(spark, folder), "transaction_id", 0.1)


@query(with_parts(f"SELECT transaction_id, {PLACE} < CAST(0.8 AS DOUBLE) AS in_train FROM tx_kept", "tx_kept"))
def split_by_key(spark, folder):
    kept = cleaning.dedupe_first(transactions(spark, folder).filter(cleaning.is_keepable()))
    train, test = sampling.split_by_key(kept)
    return (train.select("transaction_id", F.lit(True).alias("in_train"))
            .unionByName(test.select("transaction_id", F.lit(False).alias("in_train"))))


def _share_near(n, total, share: float):
    """Within five standard deviations of a Bernoulli sample."""
    return F.abs(n - share * total) <= 5 * F.sqrt(share * (1 - share) * total)


@query(with_parts("SELECT count(*) AS rows, true AS share_near, true AS only_given_rows FROM tx_raw", "tx_raw"))
def sample_fraction(spark, folder):
    """Bernoulli sample: which rows depends on the partitioning, how many and that they are rows of the table does not."""
    rows = transactions(spark, folder)
    marked = sampling.sample_fraction(rows, 0.1).groupBy("transaction_id").agg(F.count(F.lit(1)).alias("taken"))
    given = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    both = given.join(marked, "transaction_id", "full")
    taken = F.coalesce("taken", F.lit(0))
    return both.agg(F.sum("n").alias("rows"), _share_near(F.sum(taken), F.sum("n"), 0.1).alias("share_near"),
                    F.bool_and(taken <= F.coalesce("n", F.lit(0))).alias("only_given_rows"))


@query(with_parts("SELECT count(*) AS rows, true AS complete, true AS share_near FROM tx_raw", "tx_raw"))
def random_split(spark, folder):
    """Each row is in one part: counted per id over both parts."""
    rows = transactions(spark, folder).persist()
    train, test = sampling.random_split(rows)
    parts = train.select("transaction_id", F.lit(1).alias("train")).unionByName(test.select("transaction_id", F.lit(0).alias("train")))
    split = parts.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("parts"), F.sum("train").alias("train"))
    given = rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n"))
    out = given.join(split, "transaction_id", "full").agg(
        F.sum("n").alias("rows"), F.bool_and(F.col("n").eqNullSafe(F.col("parts"))).alias("complete"),
        _share_near(F.sum("train"), F.sum("n"), 0.8).alias("share_near"))
    return out


# ----- evaluation -----

THRESHOLD, COST_FN, COST_FP = 0.4, 100.0, 5.0
CALLED = f"score >= CAST({THRESHOLD} AS DOUBLE)"
CONFUSION_SQL = (f"SELECT count(*) FILTER ({CALLED} AND label = 1) AS tp, count(*) FILTER ({CALLED} AND label = 0) AS fp, "
                 f"count(*) FILTER (NOT {CALLED} AND label = 0) AS tn, "
                 f"count(*) FILTER (NOT {CALLED} AND label = 1) AS fn FROM labelled")
RATES_SQL = ("SELECT *, CAST(fn AS DOUBLE) / nullif(fn + tp, 0) AS fnr, CAST(fp AS DOUBLE) / nullif(fp + tn, 0) AS fpr "
             f"FROM ({CONFUSION_SQL})")


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_matrix(labelled_scores(spark, folder), THRESHOLD)


@query(with_parts(CONFUSION_SQL, "labelled"))
def confusion_matrix(spark, folder):
    return confusion(spark, folder)


@query(with_parts(f"SELECT *, fnr <= 0.02 AND fpr <= 0.05 AS within_limits FROM ({RATES_SQL})", "labelled"))
def error_rates(spark, folder):
    return evaluation.with_limits(evaluation.with_error_rates(confusion(spark, folder)), 0.02, 0.05)


@query(with_parts(f"SELECT *, fn * CAST({COST_FN} AS DOUBLE) + fp * CAST({COST_FP} AS DOUBLE) AS loss "
                  f"FROM ({CONFUSION_SQL})", "labelled"))
def expected_loss(spark, folder):
    return evaluation.with_expected_loss(confusion(spark, folder), COST_FN, COST_FP)


@query(with_parts(f"""SELECT loss, baseline_loss, (baseline_loss - loss) / baseline_loss AS reduction,
  (baseline_loss - loss) / baseline_loss >= 0.3 AS target_met FROM (SELECT
  count(*) FILTER (NOT score >= CAST(0.4 AS DOUBLE) AND label = 1) * CAST({COST_FN} AS DOUBLE)
  + count(*) FILTER (score >= CAST(0.4 AS DOUBLE) AND label = 0) * CAST({COST_FP} AS DOUBLE) AS loss,
  count(*) FILTER (NOT baseline_score >= CAST(0.5 AS DOUBLE) AND label = 1) * CAST({COST_FN} AS DOUBLE)
  + count(*) FILTER (baseline_score >= CAST(0.5 AS DOUBLE) AND label = 0) * CAST({COST_FP} AS DOUBLE) AS baseline_loss
  FROM labelled)""", "labelled"))
def loss_vs_baseline(spark, folder):
    return evaluation.loss_vs_baseline(labelled_scores(spark, folder), "score", "baseline_score", 0.4, 0.5,
                                       COST_FN, COST_FP)


ROC_SQL = """SELECT (sum(r) FILTER (label = 1) - CAST(count(*) FILTER (label = 1) AS DOUBLE)
  * (count(*) FILTER (label = 1) + 1) / 2) / (CAST(count(*) FILTER (label = 1) AS DOUBLE)
  * count(*) FILTER (label = 0)) FROM (SELECT label, rank() OVER (ORDER BY score)
  + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS r FROM labelled)"""
CURVE_SQL = """SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (SELECT score,
  CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM labelled GROUP BY score)
  WINDOW w AS (ORDER BY score DESC)"""
PR_SQL = f"""SELECT sum(pos * (p + coalesce(lag_p, p)) / 2) / sum(pos) FROM (SELECT *, lag(p) OVER (ORDER BY score DESC)
  AS lag_p FROM (SELECT score, CAST(pos AS DOUBLE) AS pos, CAST(tp AS DOUBLE) / (tp + fp) AS p FROM ({CURVE_SQL})))"""


@query(with_parts(f"SELECT {steady_sql(f'({ROC_SQL})', 8)} AS roc_auc, {steady_sql(f'({PR_SQL})', 8)} AS pr_auc",
                  "labelled"))
def roc_pr_auc(spark, folder):
    areas = evaluation.curve_areas(evaluation.score_curve(labelled_scores(spark, folder)))
    return areas.select(steady(F.col("roc_auc"), 8).alias("roc_auc"), steady(F.col("pr_auc"), 8).alias("pr_auc"))


@query(with_parts(f"SELECT {steady_sql(f'({ROC_SQL})', 8)} AS roc_auc, {steady_sql(f'({PR_SQL})', 8)} AS pr_auc",
                  "labelled"))
def roc_pr_auc_evaluator(spark, folder):
    """The same areas by the ML evaluator with every threshold kept; only two numbers reach the driver."""
    rows = labelled_scores(spark, folder).withColumn("label", F.col("label").cast("double"))
    by = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    roc, pr = by.evaluate(rows), by.setMetricName("areaUnderPR").evaluate(rows)
    found = spark.createDataFrame([(roc, pr)], "roc_auc DOUBLE, pr_auc DOUBLE")
    return found.select(*[steady(F.col(c), 8).alias(c) for c in found.columns])


PRF_SQL = f"""SELECT {steady_sql('w1 * p1 + w0 * p0')} AS precision, {steady_sql('w1 * r1 + w0 * r0')} AS recall,
  {steady_sql('w1 * 2 * p1 * r1 / (p1 + r1) + w0 * 2 * p0 * r0 / (p0 + r0)')} AS f1 FROM (SELECT
  CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tn AS DOUBLE) / (tn + fn) AS p0,
  CAST(tp AS DOUBLE) / (tp + fn) AS r1, CAST(tn AS DOUBLE) / (tn + fp) AS r0,
  CAST(tp + fn AS DOUBLE) / (tp + fp + tn + fn) AS w1, CAST(tn + fp AS DOUBLE) / (tp + fp + tn + fn) AS w0
  FROM ({CONFUSION_SQL}))"""


@query(with_parts(PRF_SQL, "labelled"))
def weighted_prf(spark, folder):
    out = evaluation.weighted_prf(confusion(spark, folder))
    return out.select(*[steady(F.col(c)).alias(c) for c in out.columns])


@query(with_parts(PRF_SQL, "labelled"))
def weighted_prf_evaluator(spark, folder):
    rows = labelled_scores(spark, folder).select(
        F.col("label").cast("double").alias("label"), (F.col("score") >= THRESHOLD).cast("double").alias("prediction"))
    by = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    values = tuple(by.setMetricName(m).evaluate(rows) for m in ("weightedPrecision", "weightedRecall", "f1"))
    found = spark.createDataFrame([values], "precision DOUBLE, recall DOUBLE, f1 DOUBLE")
    return found.select(*[steady(F.col(c)).alias(c) for c in found.columns])


def _tune_sql(limits: str) -> str:
    return f"""SELECT score AS threshold, tp, fp, n - fp AS tn, p - tp AS fn, CAST(p - tp AS DOUBLE) / p AS fnr,
  CAST(fp AS DOUBLE) / n AS fpr, (p - tp) * CAST({COST_FN} AS DOUBLE) + fp * CAST({COST_FP} AS DOUBLE) AS loss
  FROM (SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n FROM ({CURVE_SQL}))
  {limits} ORDER BY loss, score DESC LIMIT 1"""


@query(with_parts(_tune_sql(""), "labelled"))
def tune_threshold(spark, folder):
    return evaluation.tune_threshold(evaluation.score_curve(labelled_scores(spark, folder)), COST_FN, COST_FP)


@query(with_parts(_tune_sql("WHERE CAST(p - tp AS DOUBLE) / p <= 0.9 AND CAST(fp AS DOUBLE) / n <= 0.05"), "labelled"))
def tune_threshold_within_limits(spark, folder):
    return evaluation.tune_threshold(evaluation.score_curve(labelled_scores(spark, folder)), COST_FN, COST_FP,
                                     max_fnr=0.9, max_fpr=0.05)


@query(with_parts("""SELECT transaction_id, CASE WHEN score >= CAST(0.7 AS DOUBLE) OR coalesce(tx_amount > 300, false)
  THEN 'decline' WHEN score >= CAST(0.4 AS DOUBLE) OR coalesce(terminal_id = 7, false) THEN 'manual_review'
  ELSE 'approve' END AS decision FROM tx_scored""", "tx_scored"))
def decide_transactions(spark, folder):
    rows = scored(transactions(spark, folder))
    return rows.select("transaction_id", decide(F.col("score"), 0.4, 0.7, F.col("tx_amount") > 300,
                                                F.col("terminal_id") == 7).alias("decision"))


# ----- models: fitted weights have no twin -----

@query("SELECT * FROM (VALUES ('logistic_regression', true), ('random_forest', true)) t(model, roc_area_above_70)")
def train_compare_models(spark, folder):
    """Train both models on the cleaned rows and compare them on the held-out part."""
    trained = training.train_and_compare(clean_table(spark, folder))
    return trained.comparison.select("model", (F.col("auc") > 0.7).alias("roc_area_above_70"))


EARLIER_SQL = """SELECT *, avg(tx_amount) OVER c AS avg_customer_amount, count(tx_amount) OVER c AS customer_tx_count,
  avg(tx_amount) OVER t AS avg_terminal_amount, count(tx_amount) OVER t AS terminal_tx_count FROM tx_clean
  WINDOW c AS (PARTITION BY customer_id ORDER BY tx_time_seconds RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  t AS (PARTITION BY terminal_id ORDER BY tx_time_seconds RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
MEANS = ["avg_customer_amount", "avg_terminal_amount"]
COUNTS = ["customer_tx_count", "terminal_tx_count"]


@query(with_parts(f"""SELECT transaction_id, {', '.join(COUNTS)}, {', '.join(f"{steady_sql(c, 5)} AS {c}" for c in MEANS)},
  {steady_sql("tx_amount / CASE WHEN avg_customer_amount <= 0 THEN 1 ELSE avg_customer_amount END", 5)} AS customer_amount_ratio,
  tx_amount IS NOT NULL AND avg_customer_amount IS NOT NULL AND avg_terminal_amount IS NOT NULL AS is_scored, true AS in_unit
  FROM ({EARLIER_SQL})""", "tx_clean"))
def score_batch(spark, folder):
    """Train on the first load, save, load, score all cleaned rows on features looked up in the stored histories.

    Features see earlier rows only, in training as in scoring; a row that lacks one stays, without a score.
    """
    clean = clean_table(spark, folder)
    trained = training.train_and_compare(clean.filter(EARLY), training.TrainingOptions(trees=5, depth=4))
    path = scratch_path(spark, "pipeline")
    training.save_pipeline(trained.pipeline, path)
    rows = entity_histories(spark, folder).features(clean).select("transaction_id", *FEATURE_COLUMNS)
    scored_rows = training.score(rows, training.load_pipeline(path))
    return scored_rows.select(
        "transaction_id", *COUNTS, *[steady(F.col(c), 5).alias(c) for c in (*MEANS, "customer_amount_ratio")],
        F.col("score").isNotNull().alias("is_scored"), F.coalesce(F.col("score").between(0, 1), F.lit(True)).alias("in_unit"))


@query("SELECT CAST(i AS INTEGER) AS candidate, true AS same_as_evaluator, true AS useful FROM range(4) t(i)")
def grid_search(spark, folder):
    """Four candidates on past-only features, validated on later rows; the best one's area also by the ML evaluator."""
    options = training.TrainingOptions(max_iter=10)
    path = scratch_path(spark, "model-rows")  # the search and the evaluator read them: features are made once
    training.training_frame(clean_table(spark, folder), options).write.parquet(path)
    frame = spark.read.parquet(path)
    found = training.grid_search(frame, options, (0.01, 0.1), (0.0, 0.5))
    rows = found.candidates.collect()
    best = max(rows, key=lambda r: (r["auc"], -r["candidate"]))
    by = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="probability", numBins=0)
    area = by.evaluate(found.best.transform(frame.filter(F.col("tx_time_seconds") > found.cut)))
    return found.candidates.select("candidate", ((F.col("candidate") != best["candidate"]) | (F.abs(F.col("auc") - area) < 1e-9)).alias("same_as_evaluator"),
                                   (F.col("auc") > 0.7).alias("useful"))


# ----- files -----

@query(with_parts(f"SELECT {TX} FROM tx_raw", "tx_raw"))
def read_transactions_csv(spark, folder):
    """Written as headerless CSV, read back with the fixed schema."""
    path = scratch_path(spark, "tx-csv")
    transactions(spark, folder).write.csv(path)
    return tx_io.read_transactions_csv(spark, path)


def _with_remarks(spark: SparkSession, folder: str) -> str:
    """The transactions as CSV text with a remark line before every 50th id."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TRANSACTION_COLUMNS]
    line = F.concat_ws(",", *cells)
    lines = F.when(F.col("transaction_id") % 50 == 0, F.array(F.lit("# next block"), line)).otherwise(F.array(line))
    path = scratch_path(spark, "tx-remarks")
    transactions(spark, folder).select(F.explode(lines).alias("value")).write.text(path)
    return path


@query(with_parts(f"SELECT {TX} FROM tx_raw", "tx_raw"))
def read_transactions_csv_remarks(spark, folder):
    """Remark lines are skipped."""
    return tx_io.read_transactions_csv(spark, _with_remarks(spark, folder))


@query(with_parts("SELECT count(*) + count(*) FILTER (transaction_id % 50 = 0) AS rows, count(transaction_id) AS ids, "
                  "count(tx_amount) AS amounts FROM tx_raw", "tx_raw"))
def read_transactions_csv_no_remarks(spark, folder):
    """Without a remark sign such lines are rows of NULLs."""
    rows = tx_io.read_transactions_csv(spark, _with_remarks(spark, folder), comment=None)
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count("transaction_id").alias("ids"), F.count("tx_amount").alias("amounts"))


@query(with_parts(f"SELECT {TX} FROM tx_clean", "tx_clean"))
def write_read_clean(spark, folder):
    path = scratch_path(spark, "tx-clean")
    tx_io.write_clean(cleaned(spark, folder), path)
    return tx_io.read_clean(spark, path)


@query(with_parts("SELECT tx_time_days, count(*) AS rows FROM tx_raw GROUP BY 1", "tx_raw"))
def incremental_files(spark, folder):
    """Two ingests over a growing folder: the second takes the new files only."""
    inbox, manifest, table = (scratch_path(spark, n) for n in ("inbox", "manifest", "ingested"))
    raw = transactions(spark, folder)
    early = F.col("tx_time_days") < 15
    raw.filter(early).write.option("compression", "none").csv(inbox)
    incremental.ingest_new_files(spark, inbox, manifest, table, pattern="*.csv")
    raw.filter(~early).write.mode("append").option("compression", "none").csv(inbox)
    incremental.ingest_new_files(spark, inbox, manifest, table, pattern="*.csv")
    return spark.read.parquet(table).groupBy("tx_time_days").agg(F.count(F.lit(1)).alias("rows"))


METRIC_ROWS = """SELECT 'lr_auc' AS metric, CAST(event_id % 1000 AS VARCHAR) AS value, concat('run-', event_id) AS run_id
  FROM events UNION ALL SELECT 'rf_auc', CAST(event_id % 777 AS VARCHAR), concat('run-', event_id) FROM events
  UNION ALL SELECT 'best_model', event_type, concat('run-', event_id) FROM events"""


@query(METRIC_ROWS)
def metrics_round_trip(spark, folder):
    path = scratch_path(spark, "metrics")
    run_metrics(spark, folder).write.mode("append").option("header", "true").csv(path)
    return metrics.read_metrics(spark, path)


@query("SELECT concat('run-', event_id) AS run_id, CAST(event_id % 1000 AS VARCHAR) AS lr_auc, "
       "CAST(event_id % 777 AS VARCHAR) AS rf_auc, event_type AS best_model FROM events")
def metrics_pivot(spark, folder):
    return metrics.metrics_pivot(run_metrics(spark, folder), ["lr_auc", "rf_auc", "best_model"])


@query(with_parts("SELECT metric, CAST(value AS VARCHAR) AS value, run_id FROM (SELECT 'rows' AS metric, count(*) AS value, 'r1' AS run_id "
                  "FROM tx_raw UNION ALL SELECT 'frauds', count(*) FILTER (tx_fraud = 1), 'r1' FROM tx_raw UNION ALL "
                  "SELECT 'rows', count(*), 'r2' FROM tx_raw)", "tx_raw"))
def metrics_export(spark, folder):
    """Two runs append their numbers; all of them are read back."""
    path = scratch_path(spark, "metrics-export")
    rows = transactions(spark, folder).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("tx_fraud") == 1).alias("frauds")).first()
    metrics.export_metrics(metrics.metrics_frame(spark, rows.asDict(), "r1"), path)
    metrics.export_metrics(metrics.metrics_frame(spark, {"rows": rows["rows"]}, "r2"), path)
    return metrics.read_metrics(spark, path)
