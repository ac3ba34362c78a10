import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import clashing, docs, rows

from matchday.llm import mixing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 400), st.integers(1, 30), min_size=1, max_size=30), st.floats(0, 1))
def test_fit_comes_as_near_as_it_can(histogram, share):
    sizes = np.array(sorted(histogram))
    counts = np.array([histogram[n] for n in sizes])
    budget = round(share * int(sizes @ counts))
    taken = mixing.fit(sizes, counts, budget)
    assert (taken >= 0).all() and (taken <= counts).all()
    reach = {0}
    for n, c in zip(sizes.tolist(), counts.tolist()):
        reach = {r + n * k for r in reach for k in range(c + 1)} if len(reach) * c < 20_000 else None
        if reach is None:
            return
    best = min(abs(r - budget) for r in reach)
    assert abs(int(sizes @ taken) - budget) == best


def test_long_documents_take_part():
    """Sources of few long documents: the best of all subsets."""
    r = np.random.default_rng(1)
    for _ in range(300):
        lengths = r.integers(33_000, 200_000, 8)
        sizes, counts = np.unique(lengths, return_counts=True)
        budget = int(r.integers(1, lengths.sum()))
        taken = mixing.fit(sizes, counts, budget)
        sums = np.array([0])
        for n in lengths:
            sums = np.concatenate([sums, sums + n])
        assert abs(int(sizes @ taken) - budget) == np.abs(sums - budget).min()
    sizes, counts = np.array([40_000, 45_000, 52_000]), np.array([3, 4, 5])
    assert abs(int(sizes @ mixing.fit(sizes, counts, 200_000)) - 200_000) == 1_000


@pytest.mark.parametrize("n", [300, 3_000, 30_000])
def test_many_long_documents_reach_the_word(n):
    lengths = np.random.default_rng(n).integers(33_000, 2_000_000, n)
    sizes, counts = np.unique(lengths, return_counts=True)
    budget = int(0.37 * lengths.sum())
    assert int(sizes @ mixing.fit(sizes, counts, budget)) == budget


def test_fit_with_long_documents():
    sizes, counts = np.array([3, 5_000, 900_000]), np.array([1000, 50, 4])
    for budget in (17, 5_003, 250_000, 999_999, 2_000_000, 3_600_000):
        assert abs(int(sizes @ mixing.fit(sizes, counts, budget)) - budget) <= 0.001 * budget + 3
    alone = np.array([900_000]), np.array([1])
    assert mixing.fit(*alone, 800_000) == [1] and mixing.fit(*alone, 100_000) == [0]


def test_targets_share_what_is_above_the_cap():
    goals = mixing.targets([("b", 10), ("a", 1000), (None, 10), ("c", 1000)])
    assert goals["b"] == 30 and goals[None] == pytest.approx((2020 - 30) / 5) or goals[None] == 30
    assert sum(goals.values()) == pytest.approx(2020)
    assert all(goals[s] <= 3 * n + 1e-9 for s, n in [("b", 10), ("a", 1000), (None, 10), ("c", 1000)])
    # a and c share the rest by their weights 1 and 3
    assert goals["c"] == pytest.approx(3 * goals["a"])


def test_report(spark):
    table = clashing(docs(spark))
    found = mixing.report(table).collect()
    assert len(found) == len(rows())
    words = {d: len(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t, *_ in rows() if d is not None}
    sums, goals = {}, {}
    for r in found:
        if r["doc_id"] is not None:
            assert r["size"] == words[r["doc_id"]]
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        sums[r["target"]] = sums.get(r["target"], 0) + r["taken"]
    for goal, taken in sums.items():
        assert abs(goal - taken) <= max(3, 0.03 * goal)  # one text is most of its source
    again = mixing.report(table).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_hot_size_is_ranked_in_cells(spark):
    items = [(i, "one two three", None, "s0", 0) for i in range(500)] + [(1000 + i, "x " * i, None, "s1", 0) for i in range(40)]
    table = docs(spark, items)
    found = mixing.mix(table, per_cell=16)
    taken = {r["source_size"]: r["t"] for r in found.groupBy("source_size").agg({"target": "max"}).withColumnRenamed("max(target)", "t").collect()}
    sums = {r["source_size"]: r["s"] for r in found.selectExpr("source_size", "size * copies s").groupBy("source_size").sum("s").withColumnRenamed("sum(s)", "s").collect()}
    for size, goal in taken.items():
        assert abs(sums[size] - goal) <= 3


def test_repeat_gives_rows_as_often_as_taken(spark):
    table = clashing(docs(spark, rows() + [(200, "same words here", "en", "s1", 1)] * 5))
    out = mixing.repeat(table)
    assert out.columns == table.columns
    want = mixing.mix(table).groupBy().sum("copies").first()[0]
    assert out.count() == want


def test_repeat_keeps_columns_by_value(spark):
    from pyspark.sql import functions as F

    scratch = ("__id", "__key", "__copy", "_id", "_key", "_copies", "_rows", "_copy", "_text")
    items = [(1, "a b c", "en", "s", 1), (1, "a b c", "fr", "s", 2), (None, "d e", "en", "s", 3), (0, "d e", "en", "s", 4)]
    table = docs(spark, items).withColumns({n: F.concat(F.lit(f"{n} "), F.col("n_chars")) for n in scratch})
    out = mixing.repeat(table)
    assert out.columns == table.columns
    for r in out.collect():
        assert all(r[n] == f"{n} {r['n_chars']}" for n in scratch)
        assert (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) in items


def test_empty_table_and_no_words(spark):
    assert mixing.report(docs(spark, [])).collect() == []
    found = mixing.report(docs(spark, [(1, None, None, "a", 0), (2, "", None, None, 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in found] == [(0, 0.0, 0)] * 2


def test_too_many_sources_is_an_error(spark):
    with pytest.raises(ValueError):
        mixing.mix(docs(spark), max_sources=2)
