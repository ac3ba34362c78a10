"""Random splits of an exact share, without sorting."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import free_names
from matchday.operators.forest import row_key
from matchday.operators.ranking import numbered

#: Hex digits that one histogram refines; hashes that are listed instead.
DIGITS, LISTED = 3, 4096


def _cut(hashes: DataFrame, name: str, wanted: int) -> tuple[str, int, int]:
    """The hash that the ``wanted`` smallest rows end at, how many of the rows
    with this very hash are among them, and how many there are.

    Each histogram (at most 16 ** DIGITS counts) tells in which cell the
    order statistic lies, and the next one refines this cell alone."""
    prefix, left = "", wanted
    while True:
        inside = hashes.filter(F.col(name).startswith(prefix)) if prefix else hashes
        cells = sorted(tuple(r) for r in inside.groupBy(F.substring(name, len(prefix) + 1, DIGITS).alias("c")).count().collect())
        for cell, count in cells:
            if left <= count:
                break
            left -= count
        prefix += cell
        if count <= LISTED or len(prefix) == 32:
            break
    rows = sorted(tuple(r) for r in hashes.filter(F.col(name).startswith(prefix)).groupBy(name).count().collect())
    for digest, count in rows:
        if left <= count:
            return digest, left, count
        left -= count
    raise AssertionError("the counts changed between two passes")


def with_random_split(df: DataFrame, share: float = 0.8, seed: int = 1, key: Column | None = None, name: str = "split") -> DataFrame:
    """Append ``name``, 'train' for floor(share x rows) rows and 'test' for the
    others, by the order of an md5 of each row's key and the seed.

    ``key``: a text (all columns joined, if not given).  The same rows are
    train rows on any cluster and in any layout.  Of rows with equal keys at
    the very end of the share, some are chosen once, by a stored number, so
    the share is exact.  Few passes over the hashes, none of them a sort.  An
    empty table gives an empty result; a column named ``name`` is replaced.
    """
    key = row_key(df) if key is None else key
    digest, place = free_names(df, "_digest", "_place")
    hashed = df.withColumn(digest, F.md5(F.concat_ws(":", key, F.lit(str(seed)))))
    total = df.count()
    wanted = int(Fraction(str(share)) * total)
    parts = lambda train: F.when(train, F.lit("train")).otherwise(F.lit("test"))
    if not 0 < wanted < total:
        return df.withColumn(name, parts(F.lit(wanted > 0)))
    last, taken, held = _cut(hashed.select(digest), digest, wanted)
    if taken == held:
        return hashed.withColumn(name, parts(F.col(digest) <= last)).drop(digest)
    clear = hashed.filter(F.col(digest) != last).withColumn(name, parts(F.col(digest) < last)).drop(digest)
    edge = numbered(hashed.filter(F.col(digest) == last).drop(digest), place)
    edge = edge.withColumn(name, parts(F.col(place) < taken)).drop(place)
    return clear.unionByName(edge)
