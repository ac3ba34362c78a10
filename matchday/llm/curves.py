"""Approximate nearest neighbours on shifted space-filling curves.

Each of several curves projects the vectors on a few random orthonormal axes,
cuts every axis into cells of about equal numbers of vectors, shifted by a
random part of a cell, and orders the cells along a Hilbert curve.  What is
near in space is likely to be near on some of the curves.

Spark ranges every curve by its keys into blocks of equally many vectors (from
approximate quantiles, one small list a curve).  A query meets the vectors of
its own block and both neighbours on every curve, is scored exactly against
them, and the windows' best are merged by query.  A block is dealt into parts
of bounded size, and the queries that meet it into columns of bounded size;
each pair of a part and a column is a group of rows.

Large inner products come from near directions and from long vectors.  So the
curves order directions (vectors over their lengths), and one order more goes
by falling length: every query enters it at its start.

The window is a share of all vectors, because the share decides recall where
the data have little structure.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import ship, written
from matchday.llm.topk import dimension, floats, second_moments, usable


@dataclass(frozen=True)
class Settings:
    """``share`` of all vectors in a window of three blocks, but at least
    ``least`` vectors; up to that many vectors the search is exact.  ``rows``
    and ``queries``: of a group, about.  ``longest``: share of the vectors, the
    longest ones, that every query meets."""

    curves: int = 32
    axes: int = 8
    bits: int = 4
    share: float = 0.025
    least: int = 1024
    rows: int = 4096
    queries: int = 2048
    longest: float = 0.05
    seed: int = 11

    def blocks(self, n: int) -> int:
        """Blocks of a curve over n vectors."""
        window = max(self.least, self.share * n)
        return 1 if n <= self.least else max(3, round(3 * n / window))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of cells (rows of coordinates below
    2**bits), by Gray code and the inverse rotations of each level."""
    x = cells.T.astype(np.uint32).copy()
    axes = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint32(level - 1)
        for i in range(axes):
            on = (x[i] & level) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap if i else 0
        level >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip, level = np.zeros_like(x[0]), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0).astype(np.uint32)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> bit & 1)
    return key


@dataclass(frozen=True)
class Curves:
    """Projections of all curves, fitted to the moments of the vectors."""

    axes: list[np.ndarray]
    centres: list[np.ndarray]
    scales: list[np.ndarray]
    shifts: list[np.ndarray]
    factors: list[int]
    bits: int

    @staticmethod
    def fit(moments: np.ndarray, settings: Settings) -> Curves:
        """From the second moments of (direction, 1)."""
        size, n = len(moments) - 1, moments[-1, -1]
        mean = moments[-1, :-1] / n
        spread = moments[:-1, :-1] / n - np.outer(mean, mean)
        rng = np.random.default_rng(settings.seed)
        axes = [np.linalg.qr(rng.standard_normal((size, size)))[0][:, : settings.axes] for _ in range(settings.curves)]
        return Curves(
            axes,
            [mean @ a for a in axes],
            [np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", a, spread, a), 1e-12)) for a in axes],
            [rng.random(a.shape[1]) for a in axes],
            [int(x) | 1 for x in rng.integers(1 << 62, 1 << 63, len(axes))],
            settings.bits,
        )

    def keys(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A row of keys for each curve; equal positions are told apart by a
        hash of the id, another on each curve, so that near copies fill as many
        blocks as they need and meet others of them on every curve."""
        out = np.empty((len(self.axes), len(vectors)), np.int64)
        turned = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        for t, (axes, centre, scale, shift) in enumerate(zip(self.axes, self.centres, self.scales, self.shifts)):
            noise = (ids.astype(np.uint64) ^ np.uint64(t)) * np.uint64(self.factors[t]) >> np.uint64(44)
            z = np.clip((turned @ axes - centre) / scale, -30, 30)
            share = 1 / (1 + np.exp(-1.702 * z))  # about the normal distribution function
            cells = np.floor(share * ((1 << self.bits) - 1) + shift).astype(np.uint32)
            out[t] = hilbert_keys(np.minimum(cells, (1 << self.bits) - 1), self.bits) << 20 | noise.astype(np.int64)
        return out


def _by_length(vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A row of keys that fall with the length; equal lengths (up to 32 bits
    of a double, whose bits are ordered as it is) go by a hash of the id."""
    bits = np.linalg.norm(vectors, axis=1).view(np.int64) >> 20 << 20
    noise = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)
    return -(bits | noise.astype(np.int64))[None, :]


def _prepared(vectors: DataFrame, query: Column, identity: str, column: str, size: int) -> DataFrame:
    """vec_id, query, vector: as bytes of its own element type."""
    single = "float" if vectors.schema[column].dataType.elementType.typeName() == "float" else "double"
    used = usable(vectors.filter(F.col(identity).isNotNull()), column, size)
    used = used.filter(F.exists(column, lambda x: x != 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.float32 if single == "float" else np.float64
        for batch in batches:
            if batch.num_rows:
                x = floats(batch.column(2)).astype(kind) + kind(0)  # one zero
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(map(bytes, x), pa.binary())], ["vec_id", "query", "vector"]
                )

    plain = used.select(F.col(identity).cast("long").alias("vec_id"), query.alias("query"), column)
    return plain.mapInArrow(run, "vec_id long, query boolean, vector binary")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of bytes as doubles."""
    data = b"".join(column.to_pylist())
    kind = np.float32 if len(data) == 4 * size * len(column) else np.float64
    return np.frombuffer(data, kind).reshape(len(column), size).astype(np.float64)


def nearest(
    vectors: DataFrame, query: Column, k: int, identity: str = "vec_id", column: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """About the k rows with the largest inner products for each query row.

    Output: query_id, rank (from 1), vec_id, score (double); a query is no
    candidate of its own; ties go to the smaller id.  Every found score is
    exact; what may be missing is a candidate.

    Vectors that are null, zero, of another than the most frequent length, or
    have null or non-finite components take no part, nor do null ids.  Of
    equal vectors, the k + 1 smallest ids are candidates: the others cannot be
    among the k best of any query.  A repeated id counts once, with
    its first vector.  Other columns play no part, whatever their names.  An
    empty table gives an empty result.
    """
    spark = ship(vectors.sparkSession)
    schema = "query_id long, rank int, vec_id long, score double"
    size = dimension(vectors, column)
    if not size:
        return spark.createDataFrame([], schema)
    prepared = _prepared(vectors, query, identity, column, size).groupBy("vec_id").agg(
        F.min(F.struct("vector", "query")).alias("first")
    )
    prepared = written(prepared.select("vec_id", "first.vector", "first.query"), "vectors")
    copies = Window.partitionBy("vector").orderBy("vec_id")
    candidates = written(
        prepared.select("vec_id", "vector").withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"),
        "candidates",
    )
    asked = written(prepared.filter("query").groupBy("vector").agg(F.min("vec_id").alias("vec_id")), "queries")
    n = candidates.count()
    if not n:
        return spark.createDataFrame([], schema)
    blocks = settings.blocks(n)
    parts = -(-n // (blocks * settings.rows))

    own = F.transform(column, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(own, F.lit(0.0), lambda a, x: a + x * x))
    one = usable(vectors, column, size).select(own.alias("v"), norm.alias("n")).filter("n > 0")
    one = one.select(F.concat(F.transform("v", lambda x: x / F.col("n")), F.array(F.lit(1.0))).alias("v"))
    curves = spark.sparkContext.broadcast(Curves.fit(second_moments(one, "v", size + 1), settings))

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, ids = _matrix(batch.column("vector"), size), batch.column("vec_id").to_numpy()
                keys = np.vstack([curves.value.keys(x, ids), _by_length(x, ids)])
                of = np.repeat(np.arange(len(keys), dtype=np.int32), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(keys.ravel())], ["curve", "key"])

    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    quantiles = candidates.mapInArrow(keyed, "curve int, key long").groupBy("curve").agg(
        F.percentile_approx("key", shares, 20 * blocks).alias("bounds")
    )
    found = {r["curve"]: r["bounds"] for r in quantiles.collect()}  # curves x blocks numbers
    bounds = spark.sparkContext.broadcast(
        np.array([found[t] if blocks > 1 else [] for t in range(settings.curves + 1)], np.int64).reshape(settings.curves + 1, blocks - 1)
    )
    first = min(blocks, max(3, math.ceil(settings.longest * blocks)))  # blocks of the longest vectors
    columns = max(1, -(-3 * asked.count() // (blocks * settings.queries)))
    every = max(1, -(-columns * blocks // 3))  # columns where every query comes

    def deal(searching: bool):
        """Rows for every group a vector is in: candidates in their own block,
        queries in it and its neighbours, there with every part."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    batch = whole.slice(at, 1024)
                    ids = batch.column("vec_id").to_numpy()
                    x = _matrix(batch.column("vector"), size)
                    keys = np.vstack([curves.value.keys(x, ids), _by_length(x, ids)])
                    row = np.arange(len(ids))
                    dealt = (ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)).astype(np.int64)
                    for t, own in enumerate(keys):
                        last = t == settings.curves
                        block = np.searchsorted(bounds.value[t], own, side="right")
                        wide = every if last else columns
                        # a query goes to one column of every part, a vector to one part of every column
                        if searching:
                            near = np.add.outer(block * 0, np.arange(first)) if last else np.add.outer(block, [-1, 0, 1])
                            r, c = np.nonzero((near >= 0) & (near < blocks))
                            r, b = np.repeat(r, parts), np.repeat(near[r, c], parts)
                            part = np.tile(np.arange(parts), len(r) // parts) * wide + dealt[r] % wide
                        else:
                            kept = row[block < first] if last else row
                            r, b = np.repeat(kept, wide), np.repeat(block[kept], wide)
                            part = dealt[r] % parts * wide + np.tile(np.arange(wide), len(kept))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(r), t, np.int32)), pa.array(b.astype(np.int32)), pa.array(part.astype(np.int32)),
                                pa.array(np.full(len(r), searching)), pa.array(ids[r]), batch.column("vector").take(pa.array(r)),
                            ],
                            ["curve", "block", "part", "searching", "vec_id", "vector"],
                        )

        return run

    def compare(rows: pa.Table) -> pa.Table:
        searching = rows.column("searching").combine_chunks()
        asking = rows.filter(searching).combine_chunks()
        there = rows.filter(pc.invert(searching)).combine_chunks()
        out = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        if asking.num_rows and there.num_rows:
            a, b = _matrix(asking.column("vector").chunk(0), size), _matrix(there.column("vector").chunk(0), size)
            a_ids, b_ids = asking.column("vec_id").to_numpy(), there.column("vec_id").to_numpy()
            made = []
            for at in range(0, len(a), 1024):
                score = a[at : at + 1024] @ b.T
                if len(b) > k + 1:
                    least = np.partition(score, len(b) - k - 1, axis=1)[:, -k - 1 :].min(1)
                    # above the rounding error of sums in another order
                    margin = 1e-12 * np.linalg.norm(a[at : at + 1024], axis=1) * np.linalg.norm(b, axis=1).max()
                    q, v = np.nonzero(score >= (least - margin)[:, None])
                else:
                    q, v = (x.ravel() for x in np.indices(score.shape))
                # sums in one order for any group: equal pairs get equal scores
                exact = np.einsum("ij,ij->i", a[q + at], b[v])
                order = np.lexsort((b_ids[v], -exact, q))
                q, v, exact = q[order], v[order], exact[order]
                top = np.arange(len(q)) - np.searchsorted(q, q) <= k
                made.append((a_ids[q[top] + at], b_ids[v[top]], exact[top]))
            out = [np.concatenate(x) for x in zip(*made)]
        return pa.table(dict(zip(("asked", "vec_id", "score"), out)))

    groups = "curve int, block int, part int, searching boolean, vec_id long, vector binary"
    dealt = candidates.mapInArrow(deal(False), groups).union(asked.select("vec_id", "vector").mapInArrow(deal(True), groups))
    scored = dealt.groupBy("curve", "block", "part").applyInArrow(compare, "asked long, vec_id long, score double")
    merged = scored.groupBy("asked", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    merged = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")
    # answers of equal query vectors are the same but for their own ids
    queries = prepared.filter("query").select(F.col("vec_id").alias("query_id"), "vector")
    answers = queries.join(asked.select("vector", F.col("vec_id").alias("asked")), "vector").select("query_id", "asked").join(merged, "asked")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = answers.filter("query_id <> vec_id").withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
