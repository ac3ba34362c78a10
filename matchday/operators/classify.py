"""Train/test split, feature preparation and the two classifiers.

Naive Bayes is a ``pyspark.ml`` job, the forest one of ``forest``: statistics
are aggregated on executors and only the fitted model (bounded by classes x
features x tree nodes) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.columns import free_names, int_div
from matchday.operators.forest import Settings, apply_forest, fit_forest, row_key, spread
from matchday.operators.joins import skew_join
from matchday.operators.ranking import global_positions
from matchday.operators.sampling import with_random_split

LABEL_INDEX = "label_index"
FEATURES = "features"


def split_flag(key: str = "time", unit: int = 60, buckets: int = 5, test_bucket: int = 0) -> Column:
    """True for test rows under the key rule ``pmod(key div unit, buckets) == test_bucket``.

    With minute data and the defaults every fifth minute is test data (20%).
    Unlike ``randomSplit``, the rule does not depend on partitioning or row
    order, so the same rows are test rows on every run and every cluster.
    """
    return F.pmod(int_div(F.col(key), F.lit(unit)), F.lit(buckets)) == test_bucket


def split_rows(
    df: DataFrame,
    method: str = "key",
    key: str = "time",
    unit: int = 60,
    buckets: int = 5,
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Split into (train, test).

    ``method="key"``: deterministic key rule (``split_flag``), about
    ``1/buckets`` test.  ``method="random"``: exactly the first of ``weights``
    as its share of the rows, by a hash of each row and ``seed`` (see
    ``sampling.with_random_split``).
    """
    if method == "random":
        drawn = with_random_split(df, float(weights[0]) / float(sum(weights)), seed, name=free_names(df, "_split")[0])
        part = drawn.columns[-1]
        return drawn.filter(F.col(part) == "train").drop(part), drawn.filter(F.col(part) == "test").drop(part)
    if method != "key":
        raise ValueError(f"unknown split method {method!r}")
    flag = split_flag(key, unit, buckets)
    return df.filter(~flag), df.filter(flag)


def with_split(df: DataFrame, key: str = "time", unit: int = 60, buckets: int = 5) -> DataFrame:
    """The input with a ``split`` column, 'train' or 'test', by the key rule."""
    return df.withColumn(
        "split", F.when(split_flag(key, unit, buckets), F.lit("test")).otherwise(F.lit("train"))
    )


def fit_label_index(df: DataFrame, label: str) -> StringIndexerModel:
    """Index labels by descending frequency (ties by label text) on *all* rows,
    so no test label is unseen.  Numeric labels are indexed as text, hence
    ties order as ``1, 10, 11, 12, 2, ...``."""
    return StringIndexer(
        inputCol=label, outputCol=LABEL_INDEX, stringOrderType="frequencyDesc", handleInvalid="error"
    ).fit(df)


def label_index_map(df: DataFrame, label: str) -> DataFrame:
    """The label index with row counts, from one scan: rows are counted per
    label, and the few labels numbered by descending count (ties by label
    text), as ``fit_label_index`` does.

    Output: <label>, label_index double, n bigint.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.desc("n"), F.col(label).cast("string"))
    return counts.select(label, (F.row_number().over(order) - 1).cast("double").alias(LABEL_INDEX), "n")


def label_positions(df: DataFrame, label: str) -> DataFrame:
    """The label index for any number of labels: positions in the order of
    falling counts (ties by label text) over range partitions, no list of
    labels on the driver and no window in one task.  Null labels have none.

    Output: <label>, label_index double, n bigint.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    placed = global_positions(counts, [F.desc("n"), F.col(label).cast("string")], LABEL_INDEX)
    return placed.select(label, (F.col(LABEL_INDEX) - 1).cast("double").alias(LABEL_INDEX), "n")


def with_label_index(df: DataFrame, label: str, **skew) -> DataFrame:
    """Append ``label_index`` from ``label_positions`` to every row; a label
    may hold any share of the rows (``joins.skew_join``, which takes ``skew``).
    A null label has a null index."""
    index = label_positions(df, label).drop("n")
    return skew_join(df.drop(LABEL_INDEX), index, [label], "left", **skew).select(
        *(c for c in df.columns if c != LABEL_INDEX), LABEL_INDEX
    )


def fit_label_indexes(df: DataFrame, labels: Sequence[str]) -> StringIndexerModel:
    """One index for each of several labels, as ``fit_label_index``, in one
    pass; their columns are ``label_index_<label>``."""
    return StringIndexer(
        inputCols=list(labels), outputCols=[f"{LABEL_INDEX}_{x}" for x in labels], stringOrderType="frequencyDesc", handleInvalid="error"
    ).fit(df)


def _columns(df: DataFrame, features: Sequence[str], label: str, split: dict) -> DataFrame:
    """The columns that a job needs, its key rule's included."""
    key = [split.get("key", "time")] if split.get("method", "key") == "key" else []
    return df.select(*dict.fromkeys([*features, label, *key]))


def bayes(smoothing: float = 1.0, suffix: str = "") -> NaiveBayes:
    """Multinomial naive Bayes; features must be non-negative."""
    return NaiveBayes(
        featuresCol=FEATURES + suffix, labelCol=LABEL_INDEX, modelType="multinomial", smoothing=smoothing, **_outputs(suffix)
    )


def _outputs(suffix: str) -> dict[str, str]:
    return {
        "rawPredictionCol": "rawPrediction" + suffix,
        "probabilityCol": "probability" + suffix,
        "predictionCol": "prediction" + suffix,
    }


def random_forest_job(
    df: DataFrame, features: Sequence[str], label: str, num_trees: int = 8, seed: int = 1, split: dict | None = None,
    settings: Settings | None = None,
) -> DataFrame:
    """Train a random forest on the train part and score the test part (see
    ``forest``: 8 trees of depth 5 over 32 bins, unless ``settings`` say otherwise).

    Output: the test rows with label_index, features (as a vector),
    rawPrediction, probability, prediction.
    """
    split = dict(split or {})
    data = _columns(df, features, label, split)
    index = fit_label_index(data, label)
    train, test = split_rows(data, **split)
    settings = settings or Settings(trees=num_trees, seed=seed)
    model = fit_forest(index.transform(train), features, LABEL_INDEX, len(index.labels), settings, row_key(data))
    given = index.transform(spread(test))
    scored = VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(apply_forest(given, model))
    return scored.select(*given.columns, FEATURES, *_outputs("").values())


def naive_bayes_job(
    df: DataFrame, features: Sequence[str], label: str, smoothing: float = 1.0, split: dict | None = None
) -> DataFrame:
    """Train multinomial naive Bayes (smoothing 1) on the train part and score
    the test part.  Features must be non-negative (see ``nonnegative_rows``).

    Output: as ``random_forest_job``.
    """
    split = dict(split or {})
    data = _columns(df, features, label, split)
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    train, test = split_rows(data, **split)
    return Pipeline(stages=[assembler, fit_label_index(data, label), bayes(smoothing)]).fit(train).transform(test)
