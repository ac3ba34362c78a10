"""Joins that hold up where one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import free_names, int_div

#: Share of the rows from which a key is hot.
HOT_SHARE = 0.01


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys (columns ``on``) with at least ``share`` of the rows.

    A sketch of frequent items counts them in one pass, in bounded memory on
    every task.  At most ``1 / share`` numbers come back; a key near the share
    may be among them or not, which no result depends on.  Null keys count
    like any other.
    """
    found = min(int(1 / share) + 1, 1024)
    sketch = F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {found}, {16 * found})")
    row = df.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(x["item"] for x in row["top"] or [] if x["count"] >= share * row["n"])


def skew_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", share: float = HOT_SHARE, salts: int | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join of a large ``left`` with keys of any frequency.

    Rows of a hot key (see ``hot_keys``) are dealt into ``salts`` parts (the
    session's shuffle partitions, if not given) by a hash of the columns
    ``spread`` (all, if not given), and the rows of ``right`` with such a key
    are replicated to every part; all other rows stay as they are.  So a hot
    key, null among them, is joined by as many tasks as it has parts, and each
    pair is made once.  Rows of ``left`` that are equal in ``spread`` stay
    together.

    ``how`` is ``left`` or ``inner``; keys are equal as in any join, nulls
    match nothing.  Output: the columns of ``left``, then those of ``right``
    but for ``on``, as of ``left.join(right, on, how)``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"only left and inner joins can replicate the right side, not {how!r}")
    on = list(on)
    hot = hot_keys(left, on, share)
    if not hot:
        return left.join(right, on, how)
    parts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = free_names(left, free_names(right, "_salt")[0])[0]
    is_hot = F.xxhash64(*on).isin(hot)
    row = F.pmod(F.xxhash64(F.lit(29), *(spread or left.columns)), F.lit(parts)).cast("int")
    dealt = left.withColumn(salt, F.when(is_hot, row).otherwise(F.lit(0)))
    everywhere = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(right.withColumn(salt, F.explode(everywhere)), [*on, salt], how).drop(salt)


def _cell(at: Column, width: Column) -> Column:
    """Number of the cell that a point lies in, also for points below 0."""
    return int_div(at - F.pmod(at, width), width)


def interval_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, cell: int = 3600, on: Sequence[str] = (),
    share: float = HOT_SHARE, salts: int | None = None, spread: Sequence[str] | None = None, merged: Sequence[Column] = (),
) -> DataFrame:
    """Every point with every interval, closed at both ends, that holds it.

    No equality is needed (``on`` may add some).  An interval belongs to the
    level whose cells, ``cell`` units wide and twice as wide at each level
    above, are longer than it, and lies in one or two cells of that level: long
    intervals stay coarse.  A point lies in one cell of each level in use (a
    few numbers, read first).  Both meet on level and cell, so each pair is
    made once, and a cell with many points is split (see ``skew_join``).

    ``at``, ``start`` and ``end`` are whole numbers.  Nulls match nothing, nor
    do intervals that end before they start.  Output: the columns of
    ``points``, then those of ``intervals`` but for ``on``; other names that
    both have are an error of the caller, as in any join.

    The pairs grow with points times intervals.  Where they are only to be
    aggregated, ``merged`` (named aggregates over the points) keeps them from
    being made: see ``_merged_join``.
    """
    if merged:
        return _merged_join(points, intervals, at, start, end, on, share, salts, spread, merged)
    level, number = free_names(points, *free_names(intervals, "_level", "_cell"))
    length = F.col(end) - F.col(start)
    over = int_div(length, F.lit(cell))
    leveled = intervals.filter(F.col(end) >= F.col(start)).withColumn(
        level, F.when(over > 0, F.length(F.bin(over))).otherwise(F.lit(0))
    )
    used = sorted(r[0] for r in leveled.select(level).distinct().collect())  # 64 at most
    if not used:
        used = [0]

    def width(of: str) -> Column:
        return F.lit(cell).cast("long") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col(of))

    first, last = _cell(F.col(start), width(level)), _cell(F.col(end), width(level))
    covered = leveled.withColumn(number, F.explode(F.sequence(first, last)))
    placed = points.filter(F.col(at).isNotNull()).withColumn(level, F.explode(F.array(*map(F.lit, used))))
    placed = placed.withColumn(number, _cell(F.col(at), width(level)))
    joined = skew_join(placed, covered, [*on, level, number], "inner", share, salts, [*spread, level] if spread else None)
    return joined.filter(F.col(at).between(F.col(start), F.col(end))).drop(level, number)


#: Bits of a child's number in its parent's cell: a parent has 16 children.
FAN_BITS = 4


def _merged_join(
    points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, on: Sequence[str], share: float, salts: int | None,
    spread: Sequence[str] | None, merged: Sequence[Column],
) -> DataFrame:
    """Every interval with the aggregates of cells that together hold each of
    its points once.

    Cells are 1 unit wide, and 16 times as wide at each level above.  Points
    are aggregated by cell, once a level.  An interval is cut into the largest
    cells that lie whole in it: at each level at most two runs of children,
    each of one parent, which is what both sides meet on.  So an interval gives
    a few rows that depend on its length alone, and a parent gives 16 at most,
    however many points it has.

    Output: ``on``, the names of ``merged``, then the columns of ``intervals``
    but for ``on``.  Aggregates of the output that merge those of cells (sums
    of counts and sums, greatest and least values) are those of the pairs.
    """
    level, parent, child, first, last, runs = free_names(
        points, *free_names(intervals, "_level", "_parent", "_child", "_first", "_last", "_runs")
    )
    on, names = list(on), intervals.columns
    held = intervals.filter(F.col(end) >= F.col(start))
    longest = held.agg(F.max(F.col(end).cast("long") - F.col(start).cast("long"))).first()[0]
    levels = max(((longest or 0) + 1).bit_length() - 1, 0) // FAN_BITS + 1

    def shifted(x: Column, to: Column) -> Column:
        return F.call_function("shiftright", x, (to * FAN_BITS).cast("int"))  # rounds down, also below 0

    # whole cells of a level: from first to before last
    length = F.col(end).cast("long") - F.col(start).cast("long") + 1
    own = F.floor((F.length(F.bin(length)) - 1) / FAN_BITS).cast("int")
    each = held.withColumn(level, F.explode(F.sequence(F.lit(0), own)))
    up = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col(level) * FAN_BITS).cast("int")) - 1
    each = each.withColumns({
        first: shifted(F.col(start).cast("long") + up, F.col(level)), last: shifted(F.col(end).cast("long") + 1, F.col(level))
    }).filter(F.col(first) < F.col(last))
    # those of them that no whole cell of the next level holds
    one, fan = F.lit(1), 1 << FAN_BITS
    above, below = shifted(F.col(first) + (fan - 1), one), shifted(F.col(last), one)
    run = lambda p, a, b: F.struct(p.alias(parent), a.alias(first), b.alias(last))
    two = F.array(run(above - 1, F.col(first), above * fan), run(below, below * fan, F.col(last)))
    cut = F.when(above <= below, two).otherwise(F.array(run(below, F.col(first), F.col(last))))
    parts = each.select(*names, level, cut.alias(runs)).select(*names, level, F.inline(runs)).filter(F.col(first) < F.col(last))

    placed = points.filter(F.col(at).isNotNull()).withColumn(level, F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    placed = placed.withColumn(child, shifted(F.col(at).cast("long"), F.col(level)))
    cells = placed.groupBy(*on, level, child).agg(*merged).withColumn(parent, shifted(F.col(child), one))
    made = [c for c in cells.columns if c not in (*on, level, child, parent)]
    joined = skew_join(parts, cells, [*on, level, parent], "inner", share, salts, spread)
    inside = (F.col(child) >= F.col(first)) & (F.col(child) < F.col(last))
    return joined.filter(inside).select(*on, *made, *(c for c in names if c not in on))
