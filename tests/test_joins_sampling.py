"""Skewed and interval joins, exact splits, indexes of many labels."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchday import operators as op
from matchday.plans import football


def test_hot_keys_are_found(spark):
    rows = [(7, "x")] * 400 + [(None, None)] * 300 + [(i, "y") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, s string").repartition(5)
    hot = op.hot_keys(df, ["k", "s"], 0.1)
    want = {r[0] for r in df.filter("s = 'x' or k is null").select(F.xxhash64("k", "s")).distinct().collect()}
    assert set(hot) == want
    assert op.hot_keys(df.limit(0), ["k"]) == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_skew_join_equals_a_join(spark, how):
    r = random.Random(1)
    left = [(r.choice([1, 1, 1, 1, None, None, r.randint(2, 50)]), i) for i in range(2000)]
    right = [(k, 10 * k + j) for k in range(1, 40) for j in range(k % 3)] + [(1, -1), (1, -2), (None, 5)]
    a, b = spark.createDataFrame(left, "k long, a long"), spark.createDataFrame(right, "k long, b long")
    got, want = op.skew_join(a, b, ["k"], how), a.join(b, "k", how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        op.skew_join(a, b, ["k"], "full")


def test_no_task_of_a_skew_join_has_a_whole_key(spark):
    a = spark.range(20_000).select(F.lit(1).alias("k"), "id", F.lit("own").alias("_salt"))
    b = spark.createDataFrame([(1, "one"), (2, "two")], "k int, b string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = op.skew_join(a, b, ["k"], salts=64)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 5 * sorted(sizes)[len(sizes) // 2]
    assert joined.columns == ["k", "id", "_salt", "b"] and joined.select("_salt").distinct().collect() == [("own",)]


@pytest.mark.parametrize("cell", [1, 10, 3600])
def test_interval_join_equals_brute_force(spark, cell):
    r = random.Random(cell)
    points = [(r.choice([r.randint(-500, 500), 77, None]), i) for i in range(600)]
    intervals = [(s, s + r.choice([0, 1, 9, 10, 11, 250, 2000]), i) for i, s in enumerate(r.choices(range(-600, 600), k=120))]
    intervals += [(5, 4, 900), (None, 4, 901), (4, None, 902)]
    p, v = spark.createDataFrame(points, "t long, p long"), spark.createDataFrame(intervals, "s long, e long, v long")
    got = Counter((x["p"], x["v"]) for x in op.interval_join(p, v, "t", "s", "e", cell).collect())
    want = Counter((q, w) for t, q in points if t is not None for s, e, w in intervals if None not in (s, e) and s <= t <= e)
    assert got == want
    assert op.interval_join(p, v.limit(0), "t", "s", "e", cell).collect() == []
    assert op.interval_join(p.limit(0), v, "t", "s", "e", cell).collect() == []


@pytest.mark.parametrize("spans", [(0, 1, 14, 15, 16, 17, 31, 63), (0, 127, 255, 256, 4095, 4096, 4097, 9000)])
def test_merged_interval_join_equals_brute_force(spark, spans):
    """Aggregates of whole cells, with nulls, repeated rows and times below 0."""
    r = random.Random(len(spans) + spans[-1])
    points = [(r.choice("ab"), r.choice([r.randint(-9000, 9000), 77, None]), i) for i in range(900)]
    intervals = [(r.choice("ab"), s, s + r.choice(spans), i) for i, s in enumerate(r.choices(range(-9000, 9000), k=150))]
    intervals += [("a", 64, 127, 500), ("b", -64, -1, 501), ("a", 5, 4, 900), ("a", None, 4, 901), ("a", 4, None, 902), ("c", 0, 9, 903)]
    p, v = spark.createDataFrame(points, "k string, t long, p long"), spark.createDataFrame(intervals, "k string, s int, e int, v long")
    merged = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("p"), F.max("p").alias("m")]
    for on in ([], ["k"]):
        want = {}
        for k, s, e, w in intervals:
            found = [q for j, t, q in points if None not in (t, s, e) and s <= t <= e and (not on or j == k)]
            if found:
                want[w] = (2 * len(found), 2 * sum(found), max(found))
        held = op.interval_join(p if on else p.drop("k"), v.union(v), "t", "s", "e", on=on, merged=merged, share=0.2, salts=4)
        got = held.groupBy("v").agg(F.sum("n"), F.sum("p"), F.max("m")).collect()
        assert {x[0]: tuple(x)[1:] for x in got} == want
    assert op.interval_join(p.limit(0), v, "t", "s", "e", on=["k"], merged=merged).collect() == []
    assert op.interval_join(p, v.limit(0), "t", "s", "e", on=["k"], merged=merged).collect() == []


def test_merged_interval_join_makes_few_rows_of_many_points(spark):
    """At most two runs of 15 cells a level, however many points there are."""
    merged = [F.count(F.lit(1)).alias("n")]
    v = spark.createDataFrame([(7 * i, 7 * i + 4999, i) for i in range(50)], "s long, e long, v long")
    for copies in (1, 8):
        p = spark.range(6000 * copies).select(F.expr(f"id div {copies}").alias("t"))
        held = op.interval_join(p, v, "t", "s", "e", merged=merged)
        rows, pairs = held.agg(F.count(F.lit(1)), F.sum("n")).first()
        assert pairs == 50 * 5000 * copies and rows <= 50 * 2 * 15 * 4


def test_period_measurements_do_not_make_every_pair(spark, tmp_path):
    from matchday.plans import energy
    from matchday.sources.tables import read_table

    again, seen, join = spark.range(16).withColumnRenamed("id", "i"), [], op.interval_join
    for name, keys in (("lineitem", ("l_orderkey", "l_partkey")), ("orders", ("o_orderkey",))):
        table = read_table(spark, "/root/testdata/sf0.001", name)
        ends = table.agg(*(F.max(k).alias(k) for k in keys)).first()
        moved = table.crossJoin(again).withColumns({k: F.col(k) + F.col("i") * (ends[k] + 1) for k in keys}).drop("i")
        moved.write.parquet(f"{tmp_path}/{name}.parquet")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(energy.op, "interval_join", lambda *a, **k: seen.append(join(*a, **k)) or seen[0])
        pairs = energy.period_measurements(spark, str(tmp_path)).agg(F.sum("n")).first()[0]
    assert seen[0].count() < pairs / 2


def test_interval_join_with_an_equality_too(spark):
    p = spark.createDataFrame([("a", 5), ("b", 5)], "k string, t long")
    v = spark.createDataFrame([("a", 0, 9), ("c", 0, 9)], "k string, s long, e long")
    assert [tuple(x) for x in op.interval_join(p, v, "t", "s", "e", on=["k"]).collect()] == [("a", 5, 0, 9)]


@pytest.mark.parametrize("share", [0.0, 0.25, 0.8, 1.0])
def test_split_is_exact_and_goes_by_hash(spark, share):
    rows = [(i, "x" * (i % 5)) for i in range(1003)]
    df = spark.createDataFrame(rows, "i long, s string").repartition(7)
    got = {r["i"]: r["split"] for r in op.with_random_split(df, share, 3).collect()}
    order = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|{r[1]}:3".encode()).hexdigest())
    assert got == {r[0]: "train" if n < int(share * 1003) else "test" for n, r in enumerate(order)}


def test_split_of_repeated_rows_and_of_none(spark):
    df = spark.createDataFrame([(1, "own")] * 900 + [(2, "own")] * 101, "x long, _digest string").repartition(6)
    out = op.with_random_split(df, 0.5)
    assert out.columns == ["x", "_digest", "split"]
    assert dict(out.groupBy("split").count().collect()) == {"train": 500, "test": 501}
    assert op.with_random_split(df.limit(0)).collect() == []


def test_index_of_many_labels_with_a_hot_one(spark):
    r = random.Random(2)
    labels = ["hot"] * 700 + [None] * 50 + [f"l{r.randint(0, 400)}" for _ in range(900)]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(labels)], "label string, i long").repartition(6)
    counts = Counter(x for x in labels if x is not None)
    want = {x: float(n) for n, x in enumerate(sorted(counts, key=lambda x: (-counts[x], x)))}
    got = op.with_label_index(df, "label").collect()
    assert len(got) == len(labels) and all(r["label_index"] == want.get(r["label"]) for r in got)
    indexed = op.fit_label_index(df.filter("label is not null"), "label")
    assert list(indexed.labels) == sorted(want, key=want.get)


def test_presence_from_flat_tables_with_a_hot_match(spark):
    """A third of all line-up rows in one match, as no sheet would have."""
    base = "/root/testdata/sf0.001"
    flat = football.presence_from_flat(spark, base)
    assert Counter(map(tuple, flat.collect())) == Counter(map(tuple, football.player_presence(spark, base).collect()))
    lineups, subs = football.lineup_rows(spark, base), football.substitution_rows(spark, base)
    one = lineups.limit(1).withColumn("player_id", F.lit(-5).cast(lineups.schema["player_id"].dataType))
    hot = lineups.unionByName(one.crossJoin(spark.range(3000)).drop("id"))
    got = op.presence_from_flat(hot, subs, share=0.05, salts=16)
    assert got.filter("player_id = -5").count() == 3000 and got.filter("player_id <> -5").count() == flat.count()
