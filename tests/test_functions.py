"""Column expressions: exact rounding and cyclic distance against plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from conftest import SF_CHECK
from matchday.functions import cyclic_within, half_up_ratio
from matchday.plans import football as fb


def _expected(num, den, digits, scale):
    q = Decimal(num * scale) / Decimal(den)
    return float(q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def test_half_up_ratio_matches_decimal(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(0, 10**6), rng.randrange(1, 10**4)) for _ in range(3000)]
    # exact ties: x/8, x/16, x/32, x/40, x/200 land on ...5 in the next digit
    pairs += [(k, d) for d in (8, 16, 32, 40, 200, 400, 1000) for k in range(0, 3 * d)]
    df = spark.createDataFrame(pairs, "num long, den long")
    out = df.select(
        "num",
        "den",
        half_up_ratio("num", "den", 2, 100).alias("pct"),
        half_up_ratio("num", "den", 2).alias("r2"),
        half_up_ratio("num", "den", 0).alias("r0"),
    ).collect()
    for r in out:
        assert r["pct"] == _expected(r["num"], r["den"], 2, 100), r
        assert r["r2"] == _expected(r["num"], r["den"], 2, 1), r
        assert r["r0"] == _expected(r["num"], r["den"], 0, 1), r


def test_half_up_ratio_zero_denominator_is_null(spark):
    row = spark.createDataFrame([(3, 0)], "num long, den long").select(half_up_ratio("num", "den").alias("r")).first()
    assert row["r"] is None


def test_cyclic_within(spark):
    cycle = 24
    rows = [(float(a), float(b)) for a in range(cycle) for b in range(cycle)]
    df = spark.createDataFrame(rows, "l double, p double")
    out = df.select(
        "l", "p",
        cyclic_within(F.col("l"), F.col("p"), cycle, 1).alias("one"),
        cyclic_within(F.col("l"), F.col("p"), cycle, 2).alias("two"),
    ).collect()
    for r in out:
        d = abs(r["l"] - r["p"])
        assert r["one"] == (d <= 1 or d == cycle - 1)
        assert r["two"] == (d <= 2 or d >= cycle - 2)


def test_plus_minus_of_a_goal_sums_to_zero_with_equal_sides(spark):
    """Both fixture sides field 11 starters and substitute in the same minutes,
    so every goal adds as many +1 as -1 -- except in matches where the away
    line-up is missing (match number % 97 == 5)."""
    goals = fb.goal_minutes(spark, SF_CHECK)
    pres = fb.player_presence(spark, SF_CHECK)
    per_goal = (
        goals.join(pres, "match_id")
        .filter(F.col("goal_minute").between(F.col("start_minute"), F.col("end_minute")))
        .groupBy("match_id", "goal_minute", "scoring_team")
        .agg(F.sum(F.when(F.col("scoring_team") == F.col("player_team"), 1).otherwise(-1)).alias("s"))
    )
    assert per_goal.filter((F.col("match_id") % 97 != 5) & (F.col("s") != 0)).count() == 0
    assert per_goal.filter(F.col("match_id") % 97 == 5).count() > 0
