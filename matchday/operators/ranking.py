"""Positions over one global order, without a window in one task.

Rows are dealt to range partitions and sorted inside them; a row's position is
the number of rows in the partitions before its own, plus its place there.
What the driver sees is one number per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import free_names
from matchday.session import stored

#: ``monotonically_increasing_id`` holds the place in a partition in its low bits.
_PLACE_BITS = 33


def _by_partition(df: DataFrame, name: str) -> tuple[DataFrame, str, str]:
    """``df`` stored with each row's partition and place in it."""
    part, place = free_names(df, "_part", "_place")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return stored(df.withColumns({part: F.spark_partition_id(), place: at}), name), part, place


def _counts(kept: DataFrame, part: str) -> list[int]:
    """Rows of each partition (one number a partition, on the driver)."""
    found = {r[0]: r[1] for r in kept.groupBy(part).count().collect()}
    return [found.get(i, 0) for i in range(max(found, default=-1) + 1)]


def _looked_up(numbers: Sequence[int], part: str) -> Column:
    """The number of a row's partition."""
    return F.element_at(F.expr(f"array({', '.join(f'{n}L' for n in numbers) or '0L'})"), F.col(part) + 1)


def numbered(df: DataFrame, name: str = "position") -> DataFrame:
    """Append gapless numbers from 0, in the order of the partitions.

    The order is that of one stored run: it does not change afterwards, and
    means nothing where ``df`` has no order of its own.  A column that bears
    ``name`` is replaced.
    """
    kept, part, place = _by_partition(df, "numbered")
    starts = list(accumulate(_counts(kept, part), initial=0))
    own = [c for c in df.columns if c.lower() != name.lower()]
    return kept.select(*own, (F.col(place) + _looked_up(starts, part)).alias(name))


def global_positions(df: DataFrame, order: Sequence[Column | str], name: str = "position", partitions: int | None = None) -> DataFrame:
    """Append each row's position, from 1, in one order of all rows.

    ``order`` should be total: rows that it does not tell apart get different
    positions in an order that is fixed once, by the stored run.  Rows are
    sorted in ``partitions`` range partitions (the session's number, if not
    given), never in one task; an empty table gives an empty result.  A column
    that bears ``name`` is replaced; ``order`` may use it.
    """
    spread = df.repartitionByRange(*([partitions] if partitions else []), *order)
    scratch = free_names(df, name)[0]
    ranked = numbered(spread.sortWithinPartitions(*order), scratch)
    ranked = ranked.withColumn(scratch, F.col(scratch) + 1)
    return ranked.withColumn(name, F.col(scratch)).drop(scratch) if scratch != name else ranked


def group_positions(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """Append each row's position, from 1, among the rows that are equal in
    ``groups`` (nulls are equal), whatever share of all rows one group holds.

    One sort by groups and order deals a large group to many partitions.  The
    first place of each group in each partition, and what the group has in
    partitions before it, form a table of at most partitions + groups rows,
    which is joined on both: no task receives one whole group.
    """
    spread = df.repartitionByRange(*([partitions] if partitions else []), *groups, *order)
    kept, part, place = _by_partition(spread.sortWithinPartitions(*groups, *order), "grouped")
    first, size, carried = free_names(kept, "_first", "_size", "_carried")
    held = kept.groupBy(part, *groups).agg(F.min(place).alias(first), F.count(F.lit(1)).alias(size))
    # only a partition's first group has rows in earlier partitions
    held = stored(held, "held")
    sizes = _counts(kept, part)
    opening = {r[part]: r for r in held.filter(F.col(first) == 0).collect()}
    closing = {r[part]: r for r in held.filter(F.col(first) + F.col(size) == _looked_up(sizes, part)).collect()}
    before, open_key, open_rows = [], None, 0
    for i, rows in enumerate(sizes):
        if not rows:
            before.append(0)
            continue
        key = [repr(opening[i][g]) for g in groups]  # as text: NaN equals NaN
        before.append(open_rows if key == open_key else 0)
        last = closing[i]
        whole = last[size] == rows
        open_rows = (before[-1] if whole else 0) + last[size]
        open_key = [repr(last[g]) for g in groups]
    starts = held.select(
        part, *groups, F.col(first), F.when(F.col(first) == 0, _looked_up(before, part)).otherwise(F.lit(0)).alias(carried)
    )
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (part, *groups)]
    position = F.col(f"a.{place}") - F.col(f"b.{first}") + F.col(f"b.{carried}") + 1
    joined = kept.alias("a").join(starts.alias("b"), same)
    own = [c for c in df.columns if c.lower() != name.lower()]
    return joined.select(*(F.col(f"a.{c}") for c in own), position.alias(name))
