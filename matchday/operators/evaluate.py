"""Prediction metrics and model reports.

All four metrics of a model come from **one** aggregation over its
predictions (one job), not one action per metric.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import cyclic_within, half_up_ratio
from matchday.operators.classify import LABEL_INDEX, bayes, fit_label_indexes, split_rows
from matchday.operators.forest import Forest, Settings, binned, grow, judge_forests, row_key, spread
from matchday.schemas import MEASUREMENT_FEATURES

# English day names, Monday first, for calendar-order distances.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

CLASSIFIER_NAMES = {"random_forest": "RandomForest", "naive_bayes": "NaiveBayes"}


def parity_cycle(label: str) -> int:
    """Cycle used for within-one/two on label *indices*: 12 for month, else 24."""
    return 12 if label == "month" else 24


def calendar_cycle(label: str) -> int:
    """True cycle of a calendar label: month 12, hour 24, weekday 7."""
    return {"month": 12, "hour": 24, "weekday": 7}.get(label.lower(), 24)


def index_labels(preds: DataFrame, index_col: str = LABEL_INDEX) -> list[str]:
    """Label values of an indexed column, read from its ML metadata (no job)."""
    meta = preds.schema[index_col].metadata.get("ml_attr", {})
    vals = meta.get("vals")
    if vals is None:
        raise ValueError(f"{index_col} carries no label metadata")
    return list(vals)


def calendar_number(text: Column) -> Column:
    """Calendar position of a label given as text: the number itself for
    month/hour, 0-6 (Monday first) for an English day name, else null."""
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return F.coalesce(text.try_cast("int"), (F.nullif(F.array_position(names, text), F.lit(0)) - 1).cast("int"))


def is_calendar_value(text: str) -> bool:
    """Whether ``calendar_number`` knows the label."""
    return text in WEEKDAYS or text.lstrip("+-").isdigit()


def evaluate_predictions(
    preds: DataFrame,
    cycle: int,
    order: str = "frequency",
    label_col: str = LABEL_INDEX,
    prediction_col: str = "prediction",
    probability_col: str = "probability",
) -> DataFrame:
    """Percent exact, percent within one and two (cyclic), and the mean
    probability given to the true class, rounded to 2, 2, 2 and 4 digits.

    ``order="frequency"`` measures distances between label *indices*
    (frequency order), reproducing the original report.  ``order="calendar"``
    first decodes index and prediction to label values and measures distance
    in calendar order, which is what "within one month" means.

    The true-class probability is read at the label index; an index beyond
    the model's classes (labels unseen in training) counts as 0.  An empty
    test set gives nulls, not an error.

    Output (one row): n_test bigint, correct, within_one, within_two, avg_prob.
    """
    label, prediction = _compared(preds, order, label_col, prediction_col)
    counts, metrics = _metrics(label, prediction, _true_probability(F.col(label_col), F.col(probability_col)), cycle)
    return preds.agg(F.count(F.lit(1)).alias("n_test"), *counts).select("n_test", *metrics)


def evaluate_tables(preds: DataFrame, cycles: dict[str, int], orders: Sequence[str]) -> DataFrame:
    """``evaluate_predictions`` for several labels of one table, in one pass.

    Of each label, ``preds`` has label_index_<label>, prediction_<label> and
    probability_<label>; ``cycles`` gives its cycle.

    Output, a row a label and order: label, distance, cycle int, then as
    ``evaluate_predictions``.
    """
    aggregates, rows = [], []
    for name, cycle in cycles.items():
        at = f"{LABEL_INDEX}_{name}"
        for order in orders:
            label, prediction = _compared(preds, order, at, f"prediction_{name}")
            counts, metrics = _metrics(label, prediction, _true_probability(F.col(at), F.col(f"probability_{name}")), cycle, f"_{name}_{order}")
            aggregates += counts
            named = [F.lit(name).alias("label"), F.lit(order).alias("distance"), F.lit(cycle).alias("cycle"), F.col("n_test")]
            rows.append(F.struct(*named, *metrics))
    return preds.agg(F.count(F.lit(1)).alias("n_test"), *aggregates).select(F.inline(F.array(*rows)))


def _compared(preds: DataFrame, order: str, label_col: str, prediction_col: str) -> tuple[Column, Column]:
    """True and predicted label as the numbers whose distance counts."""
    label, prediction = F.col(label_col), F.col(prediction_col)
    if order == "frequency":
        return label, prediction
    if order != "calendar":
        raise ValueError(f"unknown order {order!r}")
    known = index_labels(preds, label_col)
    strange = [v for v in known if not is_calendar_value(v)]
    if strange:
        raise ValueError(f"labels without a place in the calendar: {strange}")
    values = F.array(*[F.lit(v) for v in known])
    return tuple(calendar_number(F.element_at(values, x.cast("int") + 1)) for x in (label, prediction))


def exact_sum(probability: Column) -> Column:
    """Sum of numbers between 0 and 1 that no order of summation changes: as
    fixed point with 18 digits, whose sums are whole numbers that merge."""
    return F.sum(probability.cast("decimal(19,18)"))


def _true_probability(index: Column, probability: Column) -> Column:
    """The probability given to the class with a row's label index, or 0."""
    return F.coalesce(F.get(vector_to_array(probability), index.cast("int")), F.lit(0.0))


def _metrics(label: Column, prediction: Column, true_prob: Column, cycle: int, suffix: str = "") -> tuple[list[Column], list[Column]]:
    """The aggregates over prediction rows, and the four metrics from them and
    ``n_test``."""
    correct, one, two, prob = (f"_{x}{suffix}" for x in ("correct", "one", "two", "prob"))
    counts = [
        F.count_if(label == prediction).alias(correct),
        F.count_if(cyclic_within(label, prediction, cycle, 1)).alias(one),
        F.count_if(cyclic_within(label, prediction, cycle, 2)).alias(two),
        exact_sum(true_prob).alias(prob),
    ]
    n = F.col("n_test")
    metrics = [
        half_up_ratio(correct, n, digits=2, scale=100).alias("correct"),
        half_up_ratio(one, n, digits=2, scale=100).alias("within_one"),
        half_up_ratio(two, n, digits=2, scale=100).alias("within_two"),
        F.round(F.col(prob).cast("double") / F.nullif(n, F.lit(0)), 4).alias("avg_prob"),
    ]
    return counts, metrics


def model_report(
    preds: DataFrame,
    classifier: str,
    features: Sequence[str],
    label: str,
    cycle: int | None = None,
    order: str = "frequency",
) -> DataFrame:
    """One report row: classifier, input (space-separated features), label and
    the four metrics."""
    if cycle is None:
        cycle = parity_cycle(label) if order == "frequency" else calendar_cycle(label)
    metrics = evaluate_predictions(preds, cycle, order)
    return metrics.select(
        F.lit(CLASSIFIER_NAMES.get(classifier, classifier)).alias("classifier"),
        F.lit(" ".join(features)).alias("input"),
        F.lit(label).alias("label"),
        "correct",
        "within_one",
        "within_two",
        "avg_prob",
    )


@dataclass(frozen=True)
class Run:
    """One model run: classifier key, feature columns, label column."""

    classifier: str
    features: tuple[str, ...]
    label: str


# The feature sets and runs of the experiment.
ALL_SEVEN = tuple(MEASUREMENT_FEATURES)
WEATHER = ("temperature", "humidity", "wind_speed")
POWER = ("power_tenants", "power_maintenance", "power_solar_panels")

FOREST_RUNS = [
    Run("random_forest", ALL_SEVEN, "month"),
    Run("random_forest", WEATHER, "month"),
    Run("random_forest", POWER, "month"),
    Run("random_forest", ALL_SEVEN, "hour"),
    Run("random_forest", POWER, "hour"),
    Run("random_forest", WEATHER, "hour"),
]

WEEKDAY_RUNS = [
    Run("naive_bayes", WEATHER, "weekday"),
    Run("random_forest", WEATHER, "weekday"),
]


def compare_models(*reports: DataFrame) -> DataFrame:
    """Report rows of several models, one table, in the order given."""
    tagged = [r.withColumn("_part", F.lit(i)) for i, r in enumerate(reports)]
    return reduce(DataFrame.unionByName, tagged).orderBy("_part").drop("_part")


def experiment_report(
    df: DataFrame,
    runs: Sequence[Run] = tuple(FOREST_RUNS),
    order: str | Sequence[str] = "frequency",
    split: dict | None = None,
    parallelism: int = 1,
    seed: int = 1,
) -> DataFrame:
    """One report row per run, in run order.

    ``order``: how distances are measured; several give a row per order and
    run, order by order, with a column ``distance``, from the same models.

    The runs are a short driver-side list.  Each is fitted by distributed
    jobs, up to ``parallelism`` at the same time from a thread pool, as
    ``CrossValidator(parallelism=...)`` does; all forests share the cached bins
    and bags of the train part.  All models then score the test part in one scan,
    each into its own columns; one aggregation gives every metric of every
    run, and its row is turned into one row per run.
    """
    split, orders = dict(split or {}), [order] if isinstance(order, str) else list(order)
    unknown = [r.classifier for r in runs if r.classifier not in CLASSIFIER_NAMES]
    if unknown:
        raise ValueError(f"unknown classifier {unknown[0]!r}")
    columns = list(dict.fromkeys(c for r in runs for c in (*r.features, r.label)))
    if split.get("method", "key") == "key":
        columns.append(split.get("key", "time"))
    data = df.select(*dict.fromkeys(columns))
    # one label index per label, shared by the runs on that label
    labels = list(dict.fromkeys(r.label for r in runs))
    index = fit_label_indexes(data, labels)
    classes = dict(zip(labels, map(len, index.labelsArray)))
    train, test = (index.transform(part) for part in split_rows(data, **split))
    forests = [r for r in runs if r.classifier == "random_forest"]
    grown_on = list(dict.fromkeys(c for r in forests for c in r.features))
    bins = binned(train, grown_on, [f"{LABEL_INDEX}_{x}" for x in labels], Settings(seed=seed), row_key(data))

    def fitted(position: int, run: Run) -> Forest | PipelineModel:
        suffix, label = f"_{position}", f"{LABEL_INDEX}_{run.label}"
        if run.classifier == "random_forest":
            return grow(rows, run.features, label, classes[run.label])
        assembler = VectorAssembler(inputCols=list(run.features), outputCol=f"features{suffix}")
        return Pipeline(stages=[assembler, bayes(suffix=suffix).setLabelCol(label)]).fit(train)

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(runs)))) as pool, bins if forests else nullcontext() as rows:
        models = list(pool.map(lambda item: fitted(*item), enumerate(runs)))

    scored_on = dict.fromkeys(c for r in runs for c in (*r.features, f"{LABEL_INDEX}_{r.label}"))
    test = judge_forests(spread(test.select(*scored_on)), {
        f"_{i}": (m, f"{LABEL_INDEX}_{r.label}") for i, (m, r) in enumerate(zip(models, runs)) if isinstance(m, Forest)
    })
    for model in models:
        test = test if isinstance(model, Forest) else model.transform(test)
    aggregates, rows = [], []
    for distance in orders:
        for position, run in enumerate(runs):
            suffix, at = f"_{position}", f"{LABEL_INDEX}_{run.label}"
            label, prediction = _compared(test, distance, at, f"prediction{suffix}")
            cycle = parity_cycle(run.label) if distance == "frequency" else calendar_cycle(run.label)
            judged = isinstance(models[position], Forest)
            prob = F.col(f"true_prob{suffix}") if judged else _true_probability(F.col(at), F.col(f"probability{suffix}"))
            counts, metrics = _metrics(label, prediction, prob, cycle, f"{suffix}_{distance}")
            aggregates += counts
            named = [
                F.lit(CLASSIFIER_NAMES[run.classifier]).alias("classifier"),
                F.lit(" ".join(run.features)).alias("input"),
                F.lit(run.label).alias("label"),
                *metrics,
            ]
            rows.append(F.struct(*named, *([] if isinstance(order, str) else [F.lit(distance).alias("distance")])))
    return test.agg(F.count(F.lit(1)).alias("n_test"), *aggregates).select(F.inline(F.array(*rows)))
