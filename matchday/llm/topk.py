"""Exact top-k inner products with norm and residual bounds.

Vectors are rotated by the eigenvectors of their second-moment matrix (the
right singular vectors of the table), so that the first coordinates hold most
of every inner product, and sorted by length, longest first, into blocks.
Query vectors form blocks too.  Each pair of blocks is one group of rows:

* the block with the longest vectors is searched first for every query, which
  gives each query a score that its k-th best has at least;
* in every other block, runs of vectors whose length times the query's length
  cannot reach that score are passed, and so are vectors whose partial sum over
  the first coordinates plus the product of the residual lengths (the most, by
  Cauchy and Schwarz, that the rest can add) cannot;
* what is left is scored exactly, on the integers.

Bounds are in double precision with a margin above its rounding error, and a
vector is passed only if it is strictly below, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.common import ship, written

#: Vectors and queries of a block; vectors of a run, at first and at most; share
#: of the second moment that the coordinates of the partial sum hold; pairs
#: that are scored at a time.
BLOCK, QUERIES, FIRST, RUN, HEAD, PAIRS = 8192, 2048, 64, 1024, 0.8, 1 << 15


def floats(vector: pa.Array) -> np.ndarray:
    """The rows of an array of equally long lists, as doubles."""
    flat = vector.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(vector), -1) if len(vector) else np.empty((0, 0))


def dimension(vectors: DataFrame, column: str) -> int:
    """The most frequent length (ties: the longest); 0 for an empty table."""
    sizes = vectors.groupBy(F.size(column).alias("n")).count().filter("n > 0")
    found = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return found["n"] if found else 0


def usable(vectors: DataFrame, column: str, size: int) -> DataFrame:
    """The rows whose vector has ``size`` finite components."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter((F.size(column) == size) & ~F.coalesce(bad, F.lit(True)))


def second_moments(vectors: DataFrame, column: str, size: int) -> np.ndarray:
    """Sum of outer products; one partial matrix a task, summed in Spark."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                x = floats(batch.column(0))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["at", "value"])

    summed = vectors.select(column).mapInArrow(partial, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    out = np.zeros(size * size)
    for row in summed.collect():
        out[row["at"]] = row["value"]
    return out.reshape(size, size)


def _search(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray,
    rotation: np.ndarray, head: int, k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, vector id, score) of at most k vectors a query that can
    be among its k best; vectors come longest first.

    ``least``: a score that each query's k-th best is known to reach.
    """
    exact = max(np.abs(vectors).max(initial=0), 1) * max(np.abs(queries).max(initial=0), 1) * vectors.shape[1] < 2**52
    kind = np.float64 if exact else np.int64
    turned, asked = vectors @ rotation, queries @ rotation
    lengths, asked_lengths = np.linalg.norm(turned, axis=1), np.linalg.norm(asked, axis=1)
    rest, asked_rest = np.linalg.norm(turned[:, head:], axis=1), np.linalg.norm(asked[:, head:], axis=1)
    margin = 1e-9 * (1 + asked_lengths * lengths.max(initial=0))
    best_scores = np.full((len(queries), k), np.iinfo(np.int64).min, np.int64)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max, np.int64)
    floor = least.astype(float).copy()
    at, run = 0, FIRST
    while at < len(vectors):
        part = slice(at, at + run)
        open_ = np.flatnonzero(asked_lengths * lengths[at] + margin >= floor)
        if not len(open_):
            break  # the vectors to come are no longer
        bound = asked[open_, :head] @ turned[part, :head].T
        bound += np.multiply.outer(asked_rest[open_], rest[part])
        q, v = np.nonzero(bound + margin[open_, None] >= floor[open_, None])
        q, v = open_[q], v + at
        at, run = at + run, min(RUN, run * 2)
        keep = query_ids[q] != ids[v]
        q, v = q[keep], v[keep]
        if not len(q):
            continue
        score = np.concatenate([
            np.einsum("ij,ij->i", queries[q[i : i + PAIRS]].astype(kind), vectors[v[i : i + PAIRS]].astype(kind))
            for i in range(0, len(q), PAIRS)
        ]).astype(np.int64)
        order = np.lexsort((ids[v], -score, q))
        q, v, score = q[order], v[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < k
        found, where = np.unique(q[top], return_inverse=True)
        new_scores = np.full((len(found), k), np.iinfo(np.int64).min, np.int64)
        new_ids = np.full((len(found), k), np.iinfo(np.int64).max, np.int64)
        new_scores[where, place[top]], new_ids[where, place[top]] = score[top], ids[v[top]]
        scores = np.hstack([best_scores[found], new_scores])
        known = np.hstack([best_ids[found], new_ids])
        order = np.lexsort((known, ~scores))[:, :k]  # ~x = -x - 1: highest first, for any long
        best_scores[found] = np.take_along_axis(scores, order, 1)
        best_ids[found] = np.take_along_axis(known, order, 1)
        reached = best_scores[found, -1]
        floor[found] = np.maximum(floor[found], np.where(reached == np.iinfo(np.int64).min, -np.inf, reached.astype(float)))
    q, place = np.nonzero(best_ids != np.iinfo(np.int64).max)
    return q, best_ids[q, place], best_scores[q, place]


def top_k(
    vectors: DataFrame, query: Column, k: int, identity: str = "vec_id", column: str = "embedding", block: int = BLOCK, queries: int = QUERIES
) -> DataFrame:
    """The k rows with the highest inner products for each query row.

    Components become floor(256 x).  ``query`` says which rows are queries; a
    query is no candidate of its own.  Output: query_id, rank (from 1),
    vec_id, score (long); fewer rows where there are fewer candidates; ties
    go to the smaller id.

    Null vectors, vectors with null or non-finite components and vectors of
    another than the most frequent length take no part; nor do rows with a
    null id.  Repeated ids are candidates each, but never of a query with
    that id, and a repeated query id is answered once, for its first vector.
    Scores must fit a long.  An empty table gives an empty result.
    """
    spark = ship(vectors.sparkSession)
    schema = "query_id long, rank int, vec_id long, score long"
    size = dimension(vectors, column)
    if not size:
        return spark.createDataFrame([], schema)
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    used = usable(vectors.filter(F.col(identity).isNotNull()), column, size).select(
        F.col(identity).cast("long").alias("vec_id"), whole.alias("vector"), query.alias("query")
    )
    moments, axes = np.linalg.eigh(second_moments(used, "vector", size))
    moments, rotation = np.maximum(moments[::-1], 0), axes[:, ::-1].copy()
    head = min(size, 1 + int(np.searchsorted(np.cumsum(moments), HEAD * moments.sum())))
    sent = spark.sparkContext.broadcast(rotation)

    # blocks by length: range partitions hold ever shorter vectors
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    total = used.count()
    parts = max(1, -(-total // block))
    ordered = used.withColumn("length", length).repartitionByRange(parts, F.desc("length"), "vec_id")
    ordered = written(
        ordered.sortWithinPartitions(F.desc("length"), "vec_id").withColumn("block", F.spark_partition_id()), "by-length"
    )
    asked = ordered.filter("query").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    count = asked.count()
    if not count:
        return spark.createDataFrame([], schema)
    columns = max(1, -(-count // queries))
    asked = written(
        asked.select(
            F.col("vec_id").alias("query_id"),
            F.col("vector").alias("asked"),
            F.pmod(F.xxhash64("vec_id"), F.lit(columns)).cast("int").alias("column"),
        ),
        "queries",
    )

    def search(blocks: DataFrame, asked: DataFrame) -> DataFrame:
        """Every block against every column of queries, a group each."""
        last = blocks.agg(F.max("block"), F.min("block")).first()
        if last[0] is None:
            return spark.createDataFrame([], "query_id long, vec_id long, score long")
        left = blocks.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
        right = asked.withColumn("block", F.explode(F.sequence(F.lit(last[1]), F.lit(last[0]))))

        def compare(key, rows: pa.Table, wanted: pa.Table) -> pa.Table:
            if not rows.num_rows or not wanted.num_rows:
                return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
            ids = rows.column("vec_id").to_numpy()
            order = np.lexsort((ids, -rows.column("length").to_numpy()))
            query_ids = wanted.column("query_id").to_numpy()
            q, v, score = _search(
                floats(rows.column("vector").combine_chunks())[order], ids[order],
                floats(wanted.column("asked").combine_chunks()), query_ids,
                wanted.column("least").to_numpy(), sent.value, head, k,
            )
            return pa.table({"query_id": query_ids[q], "vec_id": v, "score": score})

        return (
            left.groupBy("block", "column").cogroup(right.groupBy("block", "column"))
            .applyInArrow(compare, "query_id long, vec_id long, score long")
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    unknown = F.lit(float("-inf"))
    first = ordered.filter("block = 0").select("block", "vec_id", "vector", "length")
    found = written(search(first, asked.withColumn("least", unknown)), "first")
    reached = ranked(found).filter(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
    others = ordered.filter("block > 0").select("block", "vec_id", "vector", "length")
    bounded = asked.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", unknown))
    found = found.union(search(others, bounded))
    return ranked(found).select("query_id", "rank", "vec_id", "score")
