"""Minute-measurement queries: cleaning, calendar labels, classifiers."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday import operators as op
from matchday.operators.evaluate import ALL_SEVEN, FOREST_RUNS, WEATHER, WEEKDAY_RUNS
from matchday.operators.forest import Settings
from matchday.sources.fixtures import measurements_view, periods_view
from matchday.sources.tables import read_table


def clean_measurements(spark: SparkSession, base: str) -> DataFrame:
    return op.clean_measurements(measurements_view(spark, base))


def calendar_labels(spark: SparkSession, base: str) -> DataFrame:
    return op.calendar_labels(clean_measurements(spark, base), fields=("month", "hour", "weekday"))


def month_hour_data(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned rows with month and hour: input of the forest experiment."""
    return op.calendar_labels(clean_measurements(spark, base), fields=("month", "hour"))


def weekday_data(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned rows with weekday and non-negative weather: input of the
    naive Bayes comparison."""
    labelled = op.calendar_labels(clean_measurements(spark, base), fields=("weekday",))
    return op.nonnegative_rows(labelled, WEATHER)


def nonnegative_rows(spark: SparkSession, base: str) -> DataFrame:
    return weekday_data(spark, base)


def split_rows(spark: SparkSession, base: str) -> DataFrame:
    return op.with_split(clean_measurements(spark, base))


def label_index(spark: SparkSession, base: str) -> DataFrame:
    return op.label_index_map(month_hour_data(spark, base), "month")


def part_label_index(spark: SparkSession, base: str) -> DataFrame:
    """Every line item with its part's place by falling number of line items."""
    items = read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return op.with_label_index(items, "l_partkey")


def random_split(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned rows of which exactly four fifths are train rows."""
    return op.with_random_split(clean_measurements(spark, base), 0.8)


def period_measurements(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned measurements of every period, however periods overlap: how many,
    the power that tenants took, and the highest price."""
    points = clean_measurements(spark, base).select("time", "power_tenants", "electricity_price")
    merged = [
        F.count(F.lit(1)).alias("n"), F.sum(F.col("power_tenants").cast("long")).alias("power"), F.max("electricity_price").alias("top_price")
    ]
    held = op.interval_join(points, periods_view(spark, base), "time", "period_start", "period_end", merged=merged)
    return held.groupBy("period_id", "period_start", "period_end").agg(
        F.sum("n").alias("n"), F.sum("power").alias("power"), F.max("top_price").alias("top_price")
    )


#: One tree on all rows and all three weather columns.
ONE_TREE = Settings(trees=1, depth=3, subset=3, bagged=False)


def tree_predictions(spark: SparkSession, base: str) -> DataFrame:
    """Test rows of one tree of depth 3 on the weather, with the probability
    given to the true month."""
    preds = op.random_forest_job(month_hour_data(spark, base), WEATHER, "month", settings=ONE_TREE)
    return _with_true_probability(preds, "time", *WEATHER, "month")


def _with_true_probability(preds: DataFrame, *columns: str) -> DataFrame:
    true = F.coalesce(F.get(vector_to_array("probability"), F.col("label_index").cast("int")), F.lit(0.0))
    return preds.select(*columns, "label_index", "prediction", F.round(true, 6).alias("true_prob"))


def rf_predictions(spark: SparkSession, base: str) -> DataFrame:
    preds = op.random_forest_job(month_hour_data(spark, base), ALL_SEVEN, "month")
    return _with_true_probability(preds, "time", "month")


def rf_scored_rows(spark: SparkSession, base: str) -> DataFrame:
    """What must hold for every row that the month forest scores: its label
    index, the number of classes, probabilities that sum to 1, and a
    prediction that is the most probable class."""
    preds = op.random_forest_job(month_hour_data(spark, base), ALL_SEVEN, "month")
    p = vector_to_array("probability")
    return preds.select(
        "time",
        "month",
        "label_index",
        F.size(p).alias("n_classes"),
        F.round(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), 9).alias("prob_sum"),
        (F.array_position(p, F.array_max(p)) - 1 == F.col("prediction")).alias("is_most_probable"),
    )


#: Labels of the prediction table of ``cyclic_accuracy`` and their cycles.
CYCLES = {"month": 12, "hour": 24, "weekday": 7}


def cyclic_accuracy(spark: SparkSession, base: str) -> DataFrame:
    """The four metrics of arithmetic predictions of month, hour and weekday at
    cycles 12, 24 and 7, with distances of label indices and in calendar order.

    The predicted index is the true one moved by ``(time div 60) % 7 - 3``
    around the classes, so that distances wrap; every class is given the same
    probability.  One pass fits the three indexes, one gives all metrics."""
    data = calendar_labels(spark, base).select("time", *CYCLES)
    index = op.fit_label_indexes(data, list(CYCLES))
    preds = index.transform(data)
    for label, known in zip(CYCLES, index.labelsArray):
        moved = F.pmod(F.col(f"label_index_{label}") + F.pmod(F.expr("time div 60"), F.lit(7)) - 3, F.lit(len(known)))
        preds = preds.withColumns({
            f"prediction_{label}": moved.cast("double"),
            f"probability_{label}": array_to_vector(F.array_repeat(F.lit(1.0 / len(known)), len(known))),
        })
    return op.evaluate_tables(preds, CYCLES, ("frequency", "calendar"))


def nb_predictions(spark: SparkSession, base: str) -> DataFrame:
    """Test rows of the weekday naive Bayes model: features, label, label
    index, predicted index and the probability given to the true class."""
    preds = op.naive_bayes_job(weekday_data(spark, base), WEATHER, "weekday")
    return _with_true_probability(preds, "time", *WEATHER, "weekday")


def nb_report(spark: SparkSession, base: str) -> DataFrame:
    """Naive Bayes on weekday; distances between label indices (cycle 24)."""
    return op.experiment_report(weekday_data(spark, base), WEEKDAY_RUNS[:1])


def nb_calendar_report(spark: SparkSession, base: str) -> DataFrame:
    """Naive Bayes on weekday with distances in calendar order over 7 days."""
    return op.experiment_report(weekday_data(spark, base), WEEKDAY_RUNS[:1], order="calendar")


def calendar_weather_data(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned rows with month, hour and weekday and non-negative weather."""
    return op.nonnegative_rows(calendar_labels(spark, base), WEATHER)


def nb_month_hour_reports(spark: SparkSession, base: str) -> DataFrame:
    """Naive Bayes on month and on hour: distances between label indices, then
    in calendar order, at the true cycles 12 and 24."""
    runs = [op.Run("naive_bayes", WEATHER, label) for label in ("month", "hour")]
    return op.experiment_report(calendar_weather_data(spark, base), runs, order=("frequency", "calendar"))


# Runs fitted at the same time by the report queries (each run caches its own
# training points, so memory use grows with this number).
REPORT_PARALLELISM = 3


def rf_experiments(spark: SparkSession, base: str) -> DataFrame:
    return op.experiment_report(month_hour_data(spark, base), FOREST_RUNS, parallelism=REPORT_PARALLELISM)


def model_comparison(spark: SparkSession, base: str) -> DataFrame:
    """Naive Bayes row, then random forest row, for weekday from the weather
    columns."""
    return op.experiment_report(weekday_data(spark, base), WEEKDAY_RUNS, parallelism=REPORT_PARALLELISM)
