"""Cleaning, calendar labels, split, label index, classifiers, metrics."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import rows_of
from matchday import operators as op
from matchday import schemas
from matchday.operators.evaluate import calendar_number
from matchday.plans import energy as en

NAN = float("nan")


def _measure(spark, rows):
    return spark.createDataFrame([(t, *vals) for t, vals in rows], schemas.MEASUREMENTS)


def test_clean_and_nonnegative(spark):
    df = _measure(
        spark,
        [
            (1, (1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0)),
            (2, (None, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0)),  # null
            (3, (NAN, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0)),  # NaN
            (4, (-1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0)),  # negative
            (5, (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)),  # zero
            (6, (1.0, 2.0, 3.0, 0.0, 0.0, 0.0, None)),  # null outside the weather columns
        ],
    )
    assert [r["time"] for r in op.clean_measurements(df).orderBy("time").collect()] == [1, 4, 5]
    kept = op.nonnegative_rows(df, ["temperature", "humidity", "wind_speed"])
    assert [r["time"] for r in kept.orderBy("time").collect()] == [1, 5, 6]


def test_calendar_labels_zone_and_session_independence(spark):
    df = _measure(spark, [(1704067199, (0.0,) * 7)])  # 2023-12-31 23:59:59 UTC
    fields = ("month", "hour", "weekday")
    assert rows_of(op.calendar_labels(df, fields=fields), *fields) == [(12, 23, "Sunday")]
    assert rows_of(op.calendar_labels(df, zone="Europe/Helsinki", fields=fields), *fields) == [(1, 1, "Monday")]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows_of(op.calendar_labels(df, fields=fields), *fields) == [(12, 23, "Sunday")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_split_by_key_every_fifth_minute(spark):
    df = spark.range(0, 600).select((F.col("id") * 60).alias("time"))
    train, test = op.split_rows(df)
    assert test.count() == 120 and train.count() == 480
    assert test.filter((F.col("time") / 60) % 5 != 0).count() == 0
    flagged = op.with_split(df).groupBy("split").count()
    assert dict(rows_of(flagged)) == {"test": 120, "train": 480}


def test_label_index_frequency_order_with_text_ties(spark):
    months = [1] * 3 + [2] * 5 + [10] * 3 + [12] * 1
    df = spark.createDataFrame([(m,) for m in months], "month int")
    idx = rows_of(op.label_index_map(df, "month"), "month", "label_index", "n")
    # frequency first; ties as text, so "1" < "10"
    assert idx == [(1, 1.0, 3), (2, 0.0, 5), (10, 2.0, 3), (12, 3.0, 1)]


FOREST_CODE = """
import json, sys
from matchday.session import build_session
spark = build_session(sys.argv[1], int(sys.argv[2]))
from matchday.plans import energy
from matchday.sources import fixtures
from pyspark.sql import functions as F
if sys.argv[3] == "split":  # the same rows in other files and another order
    read = fixtures.read_table
    fixtures.read_table = lambda *a: read(*a).repartition(7, "l_partkey")
energy.measurements_view = fixtures.measurements_view
out = {}
for name in ("rf_predictions", "rf_experiments", "model_comparison"):
    rows = getattr(energy, name)(spark, "SF").collect()
    out[name] = sorted(map(str, rows)) if name == "rf_predictions" else list(map(str, rows))
print("ROWS" + json.dumps(out))
"""


def test_forests_are_the_same_on_any_cores_and_input_layout():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    results = []
    for master, partitions, layout in (("local[2]", "3", "whole"), ("local[4]", "8", "split")):
        run = subprocess.run(
            [sys.executable, "-c", FOREST_CODE.replace("SF", SF_SMALL), master, partitions, layout],
            cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=600,
        )
        assert run.returncode == 0, run.stderr[-2000:]
        results.append(json.loads(run.stdout.rpartition("ROWS")[2]))
    assert results[0] == results[1]


def test_forest_separates_a_separable_label(spark):
    rows = [(60 * i, float(100 * (i % 4)), float(i % 4), 1.0, f"c{i % 4}") for i in range(800)]
    df = spark.createDataFrame(rows, "time long, f1 double, f2 double, f3 double, label string")
    preds = op.random_forest_job(df, ["f1", "f2"], "label")
    m = op.evaluate_predictions(preds, cycle=24).first()
    assert (m["n_test"], m["correct"], m["avg_prob"]) == (160, 100.0, 1.0)


def test_calendar_order_refuses_labels_without_a_place(spark):
    df = spark.createDataFrame([("Mon",), ("Tue",), ("Wed",)], "label string")
    indexed = StringIndexer(inputCol="label", outputCol="label_index").fit(df).transform(df)
    preds = indexed.withColumn("prediction", F.lit(0.0)).withColumn(
        "probability", array_to_vector(F.array(F.lit(0.5), F.lit(0.3), F.lit(0.2)))
    )
    with pytest.raises(ValueError, match="Mon"):
        op.evaluate_predictions(preds, cycle=7, order="calendar")
    numbers = spark.createDataFrame([("Monday",), ("7",), ("other",), (None,)], "t string")
    assert [r[0] for r in numbers.select(calendar_number(F.col("t"))).collect()] == [0, 7, None, None]


def test_wrap_occurs_in_the_cyclic_query(spark):
    rows = {(r["label"], r["distance"]): r for r in en.cyclic_accuracy(spark, SF_SMALL).collect()}
    assert len(rows) == 6 and {r["cycle"] for r in rows.values()} == {12, 24, 7}
    data = en.calendar_labels(spark, SF_SMALL)
    indexed = op.fit_label_index(data, "month").transform(data)
    moved = F.pmod(F.col("label_index") + F.pmod(F.expr("time div 60"), F.lit(7)) - 3, F.lit(12))
    assert indexed.filter(F.abs(moved - F.col("label_index")) == 11).count() > 0


def _preds(spark, rows, size=12):
    return spark.createDataFrame(
        [(float(l), float(p), Vectors.dense([1.0 / size] * size)) for l, p in rows],
        ["label_index", "prediction", "probability"],
    )


def test_evaluate_predictions_cyclic(spark):
    preds = _preds(spark, [(0, 0), (0, 1), (0, 11), (0, 2), (0, 10), (5, 8)])
    m = op.evaluate_predictions(preds, cycle=12).first()
    assert (m["n_test"], m["correct"], m["within_one"], m["within_two"], m["avg_prob"]) == (6, 16.67, 50.0, 83.33, 0.0833)
    assert m["correct"] <= m["within_one"] <= m["within_two"]


def test_evaluate_label_beyond_model_classes_and_empty(spark):
    preds = spark.createDataFrame(
        [(3.0, 0.0, Vectors.dense([0.5, 0.3, 0.2])), (0.0, 0.0, Vectors.dense([0.5, 0.3, 0.2]))],
        ["label_index", "prediction", "probability"],
    )
    assert op.evaluate_predictions(preds, cycle=24).first()["avg_prob"] == 0.25  # (0 + 0.5) / 2
    empty = preds.limit(0)
    m = op.evaluate_predictions(empty, cycle=24).first()
    assert m["n_test"] == 0 and m["correct"] is None and m["avg_prob"] is None


def test_calendar_order_differs_from_index_order(spark):
    # frequency order: 2 (most), then 1, 10, 12 -> index 0..3
    months = [2] * 4 + [1] * 3 + [10] * 2 + [12]
    df = spark.createDataFrame([(m,) for m in months], "month int")
    indexed = StringIndexer(inputCol="month", outputCol="label_index").fit(df).transform(df)
    # month 1 (index 1) predicted as index 3 (month 12): index distance 2, calendar distance 1 (wrap)
    preds = indexed.filter(F.col("month") == 1).limit(1).select(
        "month", "label_index", F.lit(3.0).alias("prediction"), F.lit(None).cast("string").alias("p")
    )
    preds = preds.withColumn("probability", F.array(F.lit(0.25), F.lit(0.25), F.lit(0.25), F.lit(0.25)))
    preds = preds.withColumn("probability", array_to_vector("probability"))
    freq = op.evaluate_predictions(preds, cycle=12, order="frequency").first()
    cal = op.evaluate_predictions(preds, cycle=12, order="calendar").first()
    assert (freq["within_one"], freq["within_two"]) == (0.0, 100.0)
    assert (cal["within_one"], cal["within_two"]) == (100.0, 100.0)


def test_naive_bayes_report_repeatable(spark):
    a = [tuple(r) for r in en.nb_report(spark, SF_SMALL).collect()]
    b = [tuple(r) for r in en.nb_report(spark, SF_SMALL).collect()]
    assert a == b and len(a) == 1
    assert a[0][:3] == ("NaiveBayes", "temperature humidity wind_speed", "weekday")


@pytest.mark.parametrize("seed", [1])
def test_random_forest_rows_ranges_and_repeatability(spark, seed):
    data = en.month_hour_data(spark, SF_SMALL)
    preds = op.random_forest_job(data, ["temperature", "humidity", "wind_speed"], "month", seed=seed)
    _, test = op.split_rows(data)
    assert preds.count() == test.count()
    r1 = op.model_report(preds, "random_forest", ["temperature", "humidity", "wind_speed"], "month").first()
    preds2 = op.random_forest_job(data, ["temperature", "humidity", "wind_speed"], "month", seed=seed)
    r2 = op.model_report(preds2, "random_forest", ["temperature", "humidity", "wind_speed"], "month").first()
    assert tuple(r1) == tuple(r2)
    assert 0 <= r1["correct"] <= r1["within_one"] <= r1["within_two"] <= 100
    assert 0 < r1["avg_prob"] < 1


def test_experiment_reports(spark):
    report = en.model_comparison(spark, SF_SMALL)
    rows = report.collect()
    assert [r["classifier"] for r in rows] == ["NaiveBayes", "RandomForest"]
    assert report.schema.simpleString() == schemas.MODEL_REPORT.simpleString()
    rf = en.rf_experiments(spark, SF_SMALL).collect()
    assert [(r["label"], r["input"].count(" ") + 1) for r in rf] == [
        ("month", 7), ("month", 3), ("month", 3), ("hour", 7), ("hour", 3), ("hour", 3)
    ]


def test_random_split_method(spark):
    df = spark.range(0, 2001).select((F.col("id") * 60).alias("time"))
    train, test = op.split_rows(df, method="random", weights=(0.8, 0.2), seed=1)
    assert (train.count(), test.count()) == (1600, 401) and train.columns == ["time"]
    assert train.join(test, "time").count() == 0


def test_read_measurements_reader(spark, tmp_path):
    from matchday.sources import read_measurements

    df = _measure(spark, [(1, (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0))])
    df.select(*reversed(df.columns)).write.parquet(str(tmp_path / "m"))
    back = read_measurements(spark, str(tmp_path / "m"))
    assert back.columns == schemas.MEASUREMENTS.fieldNames()
    assert tuple(back.first()) == (1, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)


def test_label_missing_from_training_counts_zero_probability(spark):
    # 'c' is the rarest label (highest index) and appears only in test minutes
    rows = []
    for i in range(40):
        label = "a" if i % 3 else "b"
        minute = i if i % 5 else i + 1  # keep a and b mostly in training minutes
        rows.append((minute * 60, float(i % 4), float(i % 3), 1.0, label))
    rows += [(m * 60, 1.0, 1.0, 1.0, "c") for m in (0, 5, 10)]  # minute % 5 == 0: test only
    df = spark.createDataFrame(rows, "time long, f1 double, f2 double, f3 double, label string")
    feats = ["f1", "f2", "f3"]
    for job in (op.naive_bayes_job, op.random_forest_job):
        preds = job(df, feats, "label")
        c_rows = preds.filter(F.col("label") == "c")
        assert c_rows.count() == 3
        m = op.evaluate_predictions(c_rows, cycle=24).first()
        assert m["avg_prob"] == 0.0  # never seen in training: no probability
        assert op.evaluate_predictions(preds, cycle=24).first()["n_test"] == preds.count()


def test_compare_models_keeps_given_order(spark):
    a = spark.createDataFrame([("RandomForest", 1.0)], "classifier string, correct double")
    b = spark.createDataFrame([("NaiveBayes", 2.0)], "classifier string, correct double")
    assert [r["classifier"] for r in op.compare_models(b, a).collect()] == ["NaiveBayes", "RandomForest"]
    assert [r["classifier"] for r in op.compare_models(a, b).collect()] == ["RandomForest", "NaiveBayes"]
