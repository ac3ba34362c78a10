import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def usable(row, size):
    vec_id, x, label = row[:3]
    return vec_id is not None and label is not None and x is not None and len(x) == size and all(
        v is not None and math.isfinite(v) for v in x
    )


def brute(items, size, every=100):
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * v) for v in x]) for i, x, lab in items if usable((i, x, lab), size)]
    out = Counter()
    for a, label, x in rows:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, lab) for i, lab, y in rows if i != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out.update((a, pid, r, n, -p, -s) for r, (s, n, _) in enumerate(fits, 1))
    return out


def found(df):
    return Counter(tuple(r) for r in negatives.report(df).collect())


def sample(n, size=6, seed=1, clusters=0):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, size)) * 0.4
    if clusters:
        x = r.standard_normal((clusters, size))[r.integers(0, clusters, n)] + 0.05 * x
    return [(int(i), [float(v) for v in row], int(r.integers(0, 4))) for i, row in enumerate(x)]


AWKWARD = [
    (None, [0.1] * 6, 1), (100_000, None, 1), (100_100, [0.1] * 6, None), (100_200, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1),
    (100_300, [float("nan")] * 6, 2), (100_400, [float("inf")] * 6, 2), (100_500, [0.5] * 5, 2), (100_600, [], 2),
    (100_700, [0.0] * 6, 2), (100_800, [-3.0] * 6, 3),
]


@pytest.mark.parametrize("items", [sample(900), sample(700, clusters=5, seed=2), sample(400) + AWKWARD, sample(3), []])
def test_equals_brute_force(spark, items):
    assert found(spark.createDataFrame(items, SCHEMA)) == brute(items, 6)


def test_many_small_blocks_and_columns(spark, monkeypatch):
    """Several blocks, columns and chunks of zone maps; few are read."""
    settings = negatives.Settings(block=16, column=3, chunk=4)
    items = sample(600, clusters=12, seed=5)
    df = spark.createDataFrame([(i, x, (lab + 1) % 10 if i % 7 == 0 else lab) for i, x, lab in items], SCHEMA)
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, settings=settings)
    assert Counter(tuple(r) for r in got.collect()) == brute(items, 6)


def test_zone_maps_spare_blocks(spark):
    """On clustered vectors a window meets few of the blocks."""
    items = sample(2000, clusters=20, seed=6)
    df = spark.createDataFrame(items, SCHEMA)
    settings = negatives.Settings(block=32)
    used = negatives._used(df, F.col("vec_id") % 100 == 0, "vec_id", "label", "embedding", 6, 256)
    blocks = negatives._packed(negatives._ordered(used, 6, settings)).collect()
    lows, highs = (np.array([np.frombuffer(b[k]) for b in blocks]) for k in ("lows", "highs"))
    anchors = np.array([[math.floor(256 * v) for v in x] for i, x, _ in items if i % 100 == 0], float)
    least, most = negatives.bounds(anchors, lows, highs)
    whole = [np.frombuffer(b["vectors"]).reshape(-1, 6) for b in blocks]
    for k, x in enumerate(whole):
        score = anchors @ x.T
        assert (score.min(1) >= least[:, k]).all() and (score.max(1) <= most[:, k]).all()
    best = np.partition(anchors @ np.vstack(whole).T, -30, axis=1)[:, -30]
    assert (most >= best[:, None]).mean() < 0.5


def test_equal_vectors_and_hot_labels(spark):
    """Ties over more rows than a block holds go by id."""
    items = [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(0, 1500)]
    items += [(i, [0.25, 0.25, 0.1, 0.0, 0.0, 0.0], 5) for i in range(2000, 2400)]
    settings = negatives.Settings(block=64, column=2)
    df = spark.createDataFrame([(i, x, (lab + 1) % 10 if i % 7 == 0 else lab) for i, x, lab in items], SCHEMA)
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, settings=settings)
    assert Counter(tuple(r) for r in got.collect()) == brute(items, 6)


def test_long_vectors_and_integers_beyond_doubles(spark):
    r = np.random.default_rng(9)
    items = [(i, [float(v) for v in r.standard_normal(6) * 3e5], i % 3) for i in range(300)]
    assert found(spark.createDataFrame(items, SCHEMA)) == brute(items, 6)


def test_repeated_ids_and_clashing_columns(spark):
    items = sample(300)
    clash = spark.createDataFrame(items + items[:40], SCHEMA).withColumns(
        {n: F.lit("own") for n in ("anchor_id", "rank", "block", "place", "score", "column", "key", "position")}
    )
    assert found(clash) == brute(items, 6)
    assert found(spark.createDataFrame([r for r in items if r[0] % 100], SCHEMA)) == Counter()
