"""Forests: brute force in plain Python, bags, bins, degenerate tables."""

import hashlib
import math
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from matchday.operators import forest
from matchday.operators.forest import VOTE, Settings


def rows_of(n, seed, classes=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.randint(0, 40), r.randint(0, 5), r.random()
        label = (a > 17) + (b > 2 and c > 0.4)
        out.append((i, float(a), float(b), c, label if r.random() < 0.9 else r.randrange(classes)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int")


class Plain:
    """The same forest without Spark."""

    def __init__(self, rows, settings, classes=3):
        self.s, self.classes = settings, classes
        xs = [r[1:4] for r in rows]
        self.ends = [(min(x[f] for x in xs), max(x[f] for x in xs)) for f in range(3)]
        self.below = []
        for f in range(3):
            counts = [0] * forest.CELLS
            for x in xs:
                counts[self.cell(f, x[f])] += 1
            sums = [0, *accumulate(counts)]
            self.below.append([s * settings.bins // len(rows) for s in sums])
        bins = [[self.bin(f, x[f]) for f in range(3)] for x in xs]
        self.trees = []
        for t in range(settings.trees):
            weights = [self.weight(str(r[0]), t) for r in rows]
            held = [(b, r[4], w) for b, r, w in zip(bins, rows, weights) if w]
            tree = {}
            self.grow(tree, t, 1, 0, held)
            self.trees.append(tree)

    def cell(self, f, x):
        low, high = self.ends[f]
        return max(0, min(forest.CELLS - 1, math.floor((x - low) / (high - low) * float(forest.CELLS)))) if high > low else 0

    def bin(self, f, x):
        return self.below[f][self.cell(f, x)]

    def weight(self, key, t):
        if not self.s.bagged:
            return 1
        drawn = int(hashlib.md5(f"{key}:{self.s.seed}:{t // 8}".encode()).hexdigest()[4 * (t % 8) : 4 * (t % 8) + 4], 16)
        limits = [int(x * 65536) for x in accumulate(math.exp(-1) / math.factorial(k) for k in range(8))]
        return sum(drawn >= x for x in limits)

    def sums(self, held):
        out = [0] * self.classes
        for _, y, w in held:
            out[y] += w
        return out

    def grow(self, tree, t, node, level, held):
        whole, best = self.sums(held), None
        n = sum(whole)
        if level < self.s.depth:
            looked = sorted(range(3), key=lambda f: hashlib.md5(f"{self.s.seed}:{t}:{node}:{f}".encode()).hexdigest())
            for f in sorted(looked[: self.s.looked_at(3)]):
                for cut in sorted({b[f] for b, _, _ in held}):
                    left = self.sums([h for h in held if h[0][f] <= cut])
                    nl = sum(left)
                    if nl < n:
                        score = sum(x * x for x in left) / nl + sum((x - y) ** 2 for x, y in zip(whole, left)) / (n - nl)
                        if score > sum(x * x for x in whole) / n and (best is None or score > best[0]):
                            best = (score, f, cut)
        if best is None:
            tree[node] = ("leaf", [w * VOTE // n for w in whole])
            return
        _, f, cut = best
        tree[node] = ("cut", f, cut)
        self.grow(tree, t, 2 * node, level + 1, [h for h in held if h[0][f] <= cut])
        self.grow(tree, t, 2 * node + 1, level + 1, [h for h in held if h[0][f] > cut])

    def predict(self, x):
        votes = [0] * self.classes
        for tree in self.trees:
            node = 1
            while tree[node][0] == "cut":
                _, f, cut = tree[node]
                node = 2 * node + (self.bin(f, x[f]) > cut)
            votes = [a + b for a, b in zip(votes, tree[node][1])]
        return votes.index(max(votes)), [v / sum(votes) for v in votes]


@pytest.mark.parametrize("settings", [
    Settings(), Settings(trees=1, depth=3, subset=3, bagged=False), Settings(trees=11, depth=2, bins=5, seed=9),
])
def test_forest_equals_plain_python(spark, settings):
    train, test = rows_of(400, 1), rows_of(200, 2)
    model = forest.fit_forest(frame(spark, train).repartition(5), ["a", "b", "c"], "label", 3, settings, F.col("id").cast("string"))
    got = {r["id"]: r for r in forest.apply_forest(frame(spark, test), model).collect()}
    plain = Plain(train, settings)
    for row in test:
        best, chances = plain.predict(row[1:4])
        assert got[row[0]]["prediction"] == best
        assert list(got[row[0]]["probability"]) == pytest.approx(chances, abs=1e-12)


def test_bags_are_poisson(spark):
    df = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    weights = forest.with_bags(df, F.col("k"), Settings(trees=9), "b").select(F.posexplode("b").alias("t", "w"))
    by_tree = weights.groupBy("t").agg(F.avg("w").alias("m"), F.variance("w").alias("v"), F.avg((F.col("w") == 0).cast("int")).alias("z"))
    for r in by_tree.collect():
        assert abs(r["m"] - 1) < 0.03 and abs(r["v"] - 1) < 0.05 and abs(r["z"] - math.exp(-1)) < 0.02


def test_degenerate_tables(spark):
    same = [(i, 1.0, 1.0, 1.0, i % 2) for i in range(20)]
    model = forest.fit_forest(frame(spark, same), ["a", "b"], "label", 2, Settings(bagged=False))
    assert not any(model.cuts)
    assert forest.apply_forest(frame(spark, same), model).select("prediction").distinct().collect() == [(0.0,)]
    empty = forest.fit_forest(frame(spark, []), ["a"], "label", 2)
    assert forest.apply_forest(frame(spark, same[:1]), empty).first()["prediction"] == 0.0
    odd = [(0, None, 1.0, 1.0, 0), (1, 5.0, 1.0, 1.0, 1), (2, 9.0, None, 1.0, None), (3, None, 2.0, 1.0, 0)]
    model = forest.fit_forest(frame(spark, odd), ["a"], "label", 2, Settings(trees=1, bagged=False))
    found = {r["id"]: r["prediction"] for r in forest.apply_forest(frame(spark, odd), model).collect()}
    assert found[0] == 0.0 and found[1] == 1.0 and found[3] == 0.0


def test_weights_of_squares_beyond_longs(spark):
    """Sums whose squares no long holds are compared exactly."""
    big = 3 * 10**12
    sums = spark.createDataFrame(
        [(0, 1, 0, 0, 0, big), (0, 1, 0, 0, 1, 1), (0, 1, 0, 1, 0, big), (0, 1, 0, 1, 1, 2), (0, 1, 0, 2, 1, big)],
        "tree int, node int, feature int, bin int, label int, w long",
    )
    assert [tuple(r) for r in forest.best_cuts(sums).collect()] == [(0, 1, 0, 1)]


def test_rows_alike_in_bins_and_label_are_added_up(spark, monkeypatch):
    """Levels pass over combinations of bins and label, not over all rows, and
    the forest is the one of the rows themselves."""
    data = frame(spark, rows_of(400, 3) * 20 + [(1, 2.0, 3.0, 0.5, None)]).repartition(5)
    settings = Settings(trees=17, depth=3, bins=4)
    with forest.binned(data, ["a", "b", "c"], ["label"], settings, F.col("id").cast("string")) as binned:
        with forest._gathered(binned, [0, 2], "label", 3) as counted:
            assert counted.rows.count() <= 4 * 4 * 3
        added = forest.grow(binned, ["a", "c"], "label", 3)
        monkeypatch.setattr(forest, "GATHERED", 0)
        with forest._gathered(binned, [0, 2], "label", 3) as counted:
            assert counted.rows.count() == 400 * 20
        monkeypatch.setattr(forest, "COUNTED", 100)
        assert forest.grow(binned, ["a", "c"], "label", 3) == added
        assert forest.grow(binned, ["a", "b", "c"], "label", 3).cuts[0]


def test_judged_rows_equal_scored_ones(spark):
    """Odd values as in SQL; labels without a class have no probability; other
    columns, with what is known of them, stay as they are."""
    odd = [None, float("nan"), float("inf"), float("-inf"), -1e300, 1e300, 17.0]
    model = forest.fit_forest(frame(spark, rows_of(300, 4)), ["a", "b", "c"], "label", 3, Settings(trees=3))
    rows = [(i, x, 2.0, y, t) for i, (x, y, t) in enumerate((x, y, t) for x in odd for y in odd for t in (0.0, 2.0, 3.0, None))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, t double")
    df = df.withColumn("t", F.col("t").alias("t", metadata={"known": 1}))
    cells = df.select("id", *(forest._cell(f, lo, hi).alias(f) for f, lo, hi in zip("abc", model.lows, model.highs)))
    cells = {r["id"]: [table[r[f]] for f, table in zip("abc", model.bin_of)] for r in cells.collect()}
    scored = {r["id"]: r for r in forest.apply_forest(df, model, "_x").collect()}
    judged = forest.judge_forests(df, {"_0": (model, "t"), "_1": (model, "t")})
    assert judged.schema["t"].metadata == {"known": 1} and judged.columns[:5] == df.columns
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan
    for r in judged.collect():
        votes = [0] * 3
        for cuts, leaves in zip(model.cuts, model.votes):
            node = 1
            while node in cuts:
                node = 2 * node + (cells[r["id"]][cuts[node][0]] > cuts[node][1])
            votes = [a + b for a, b in zip(votes, leaves.get(node, [0] * 3))]
        own = scored[r["id"]]
        assert r["prediction_0"] == r["prediction_1"] == own["prediction_x"] == votes.index(max(votes))
        assert list(own["probability_x"]) == [v / sum(votes) for v in votes]
        known = r["t"] is not None and r["t"] < 3
        assert r["true_prob_0"] == r["true_prob_1"] == (own["probability_x"][int(r["t"])] if known else 0.0)
