"""Mixing sources to target weights by subset sums.

Documents are counted by source and exact size.  For each source, its target
is met by whole copies of everything and, for the rest of the budget, by a
number of documents per size: first the same share of every size, then long
documents while they fit, then a bounded knapsack (dynamic programming over
sums, as bit sets) for what is left.  Which documents of a size are taken is
seeded: those with the smallest hash of id and seed.

The plan of a source depends on its counts by size alone, so it is made in one
task per source from a table that has at most one row for each size.

Texts of any length count whole; a long document is one number here.  Columns
other than id, text and source play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.columns import free_names
from matchday.llm.common import rank_in_cells, ship, written

#: Least sums that the knapsack is solved over, and the bits that its sets may
#: take in all: a bound on work and memory, not on sizes.  Up to it, the whole
#: budget is one knapsack and the result the best there is; beyond it, there are
#: so many documents that a window of twice the longest one reaches any sum.
KNAPSACK, BITS = 1 << 14, 1 << 30


def words(text: Column) -> Column:
    """Number of maximal runs without ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], cap: float = 3.0, cycle: tuple[int, ...] = (1, 2, 3)) -> dict:
    """Target of each source, given (source, size) in any order.

    Sources by code point, null last, weigh ``cycle`` repeating.  They share
    the sum of all sizes by weight; none gets more than ``cap`` times its
    size, and what is above is shared again by weight until none is above.
    """
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: cycle[i % len(cycle)] for i, (s, _) in enumerate(ordered)}
    most = {s: cap * n for s, n in ordered}
    left, free, out = float(sum(n for _, n in ordered)), list(weight), {}
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > most[s]]
        if not above:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: most[s] for s in above}
        left -= sum(most[s] for s in above)
        free = [s for s in free if s not in out]
    return out


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to
    ``budget`` or as near as the method finds; at most ``counts`` of each.

    The better of filling the budget and of leaving out the rest: a document
    longer than the budget can only be met from above.
    """
    total = int(sizes @ counts)
    if budget <= 0 or total == 0:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    ways = [_fill(sizes, counts, budget), counts - _fill(sizes, counts, total - budget)]
    return min(ways, key=lambda taken: abs(int(sizes @ taken) - budget))


def _fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    longest = int(sizes.max(initial=1))
    steps = sum(int(c).bit_length() for c, n in zip(counts, sizes) if n > 0)
    if (budget + longest) * steps <= BITS:
        return _knapsack(sizes, counts, np.zeros_like(counts), budget, budget + longest)
    total, window = int(sizes @ counts), max(KNAPSACK, 2 * longest)
    taken = (counts * (budget / total)).astype(np.int64)
    left = budget - int(sizes @ taken)
    for i in np.argsort(-sizes, kind="stable"):  # long documents while they fit
        if left < window:
            break
        if 0 < sizes[i] <= left:
            more = min(int(counts[i] - taken[i]), (left - window) // int(sizes[i]) + 1)
            more = max(0, min(more, left // int(sizes[i])))
            taken[i] += more
            left -= more * int(sizes[i])
    return _knapsack(sizes, counts, taken, left, left + window)


def _knapsack(sizes: np.ndarray, counts: np.ndarray, taken: np.ndarray, left: int, goal: int) -> np.ndarray:
    """``taken`` and, of the rest, what adds up to ``left`` or as near as sums
    up to ``goal`` come; bit k of a set is on if the sum k can be reached."""
    taken = taken.copy()
    mask = (1 << (goal + 1)) - 1
    reach, steps = [1], []
    # sizes in no order: should the bits run out, long and short have taken part
    for i in np.random.default_rng(len(sizes)).permutation(len(sizes)):
        room, size, times = int(counts[i] - taken[i]), int(sizes[i]), 1
        while room > 0 and 0 < size * times <= goal:
            times = min(times, room)
            reach.append((reach[-1] | reach[-1] << (size * times)) & mask)
            steps.append((i, times))
            room, times = room - times, times * 2
        if reach[-1] >> max(left, 0) & 1 or len(reach) * goal > 2 * BITS:
            break
    below = (reach[-1] & ((1 << (max(left, 0) + 1)) - 1)).bit_length() - 1
    over = reach[-1] >> (max(left, 0) + 1)
    at = below
    if over:
        above = left + (over & -over).bit_length()
        at = above if above - left < left - below else below
    for k in range(len(steps) - 1, -1, -1):
        if not reach[k] >> at & 1:
            i, times = steps[k]
            taken[i] += times
            at -= times * int(sizes[i])
    return taken


def _plan(goals: dict[str | None, float]) -> Callable[[pa.Table], pa.Table]:
    def plan(rows: pa.Table) -> pa.Table:
        size, count = rows.column("size").to_numpy(), rows.column("n").to_numpy()
        goal = goals[rows.column("source")[0].as_py()]
        total = int(size @ count)
        whole = min(3, int(goal // total)) if total else 0
        extra = fit(size.astype(np.int64), count.astype(np.int64), round(goal - whole * total))
        return pa.table({
            "source": rows.column("source"), "size": rows.column("size"), "n": rows.column("n"),
            "whole": pa.array(np.full(len(size), whole), pa.int64()), "extra": pa.array(extra, pa.int64()),
        })

    return plan


def mix(docs: DataFrame, seed: int = 7, cap: int = 3, max_sources: int = 100_000, per_cell: int = 1000) -> DataFrame:
    """How often the mix takes each row of ``docs`` (doc_id, text, source).

    Output, a row for each: doc_id, text_key (64-bit hash of the text), size,
    source_size, target (words of its source), copies (0 to ``cap``).

    Null and empty texts have size 0.  Repeated rows count each.  Rows without
    a source form a source of their own, the last.  An empty table gives an
    empty result.  More than ``max_sources`` sources is an error.
    """
    spark = ship(docs.sparkSession)
    sized = written(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "source", words(F.col("text")).alias("size")), "sized"
    )
    counts = written(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sums = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("size")).limit(max_sources + 1).collect()
    if len(sums) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    goals = targets([(r["source"], r["size"]) for r in sums], float(cap))
    plan = counts.groupBy("source").applyInArrow(_plan(goals), "source string, size long, n long, whole long, extra long")
    known = spark.createDataFrame(
        [(r["source"], r["size"], goals[r["source"]]) for r in sums], "source string, source_size long, target double"
    )
    plan = plan.alias("p").join(known.alias("k"), F.col("p.source").eqNullSafe(F.col("k.source"))).select(
        "p.*", "k.source_size", "k.target"
    )
    plan = written(plan, "plan").withColumnsRenamed({"source": "__source", "size": "__size"})
    planned = sized.join(plan, (F.col("size") == F.col("__size")) & F.col("source").eqNullSafe(F.col("__source")))
    # only sizes of which some but not all are taken need an order
    some = F.col("extra").between(1, F.col("n") - 1)
    taken = planned.filter(~some).withColumn("copies", F.col("whole") + (F.col("extra") > 0).cast("long"))
    draw = planned.filter(some).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text_key"))
    ranked = rank_in_cells(
        draw, ["source", "size"], [F.col("draw"), F.col("doc_id")], F.col("draw"), F.ceil(F.col("n") / per_cell).cast("long")
    ).withColumn("copies", F.col("whole") + (F.col("rank") < F.col("extra")).cast("long"))
    columns = ["doc_id", "text_key", "size", "source_size", "target", "copies"]
    return taken.select(*columns).unionByName(ranked.select(*columns))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (size times copies)."""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken)


def repeat(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows that it
    doesn't take go.  Rows that repeat id and text come, all together, as
    often as the mix takes them; what does not divide goes to the least one
    in its other columns.  Columns keep their values, whatever their names."""
    identity, key, copies, many, copy = free_names(docs, "_id", "_key", "_copies", "_rows", "_copy")
    totals = mix(docs).groupBy("doc_id", "text_key").agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(many))
    totals = written(totals.filter(F.col(copies) > 0), "copies").withColumnsRenamed({"doc_id": identity, "text_key": key})
    text = free_names(docs, "_text")[0]
    keyed = docs.withColumn(text, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(identity)) & (F.col(text) == F.col(key))

    def times(rows: DataFrame, n: str) -> DataFrame:
        return rows.withColumn(copy, F.explode(F.expr(f"sequence(1, {n})"))).select(*docs.columns)

    out = times(keyed.join(totals.filter(F.col(copies) >= F.col(many)), same), f"int(`{copies}` div `{many}`)")
    odd = totals.filter(F.col(copies) % F.col(many) > 0)
    if not odd.isEmpty():
        # of rows that repeat id and text, the least in its other columns
        order = [F.col(c) for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
        first = Window.partitionBy("doc_id", text).orderBy(*order)
        one = keyed.join(odd, same).withColumn(copy, F.row_number().over(first)).filter(F.col(copy) == 1)
        out = out.unionByName(times(one, f"int(`{copies}` % `{many}`)"))
    return out
