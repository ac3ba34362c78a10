"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are ordered along a Hilbert curve over their main directions and cut
into blocks of equally many, one Parquet row each: ids, labels, vectors and,
in columns of their own, the least and the greatest value of every dimension
(the zone map).  Anchors are dealt, in the same order, into columns.

What an anchor looks for is a window of scores: any score for its positives,
and the part of the scale that a positive allows for its negatives.  Interval
arithmetic over a zone map bounds the inner products of an anchor with a
block, and only blocks whose bounds meet a window are read for it.  Two passes:
an anchor's own block comes first, whose k best in a window raise the window's
lower end; then all others that still meet it.

Only zone maps (a thousandth of the vectors) are set against all anchors, in
chunks; vectors travel to the anchors that chose their block.  Bounds have a
margin above rounding errors and scores are integers, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.columns import int_div
from matchday.llm.common import ship, written
from matchday.llm.curves import hilbert_keys
from matchday.llm.topk import dimension, floats, second_moments, usable
from matchday.operators.ranking import global_positions

LOWEST, HIGHEST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Settings:
    """Vectors of a block, anchors of a column, zone maps of a chunk, and the
    directions and bits of each that the Hilbert curve orders."""

    block: int = 1024
    column: int = 512
    chunk: int = 256
    axes: int = 12
    bits: int = 5


def _used(vectors: DataFrame, anchor: Column, identity: str, label: str, column: str, size: int, scale: int) -> DataFrame:
    """vec_id, label, vector (whole numbers as doubles), anchor: a row an id."""
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    kept = usable(vectors.filter(F.col(identity).isNotNull() & F.col(label).isNotNull()), column, size)
    rows = kept.select(
        F.col(identity).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), whole.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    first = F.min(F.struct("label", "vector", "anchor")).alias("first")
    return rows.groupBy("vec_id").agg(first).select("vec_id", "first.*")


def _ordered(used: DataFrame, size: int, settings: Settings) -> DataFrame:
    """``used`` with its block along the Hilbert curve."""
    one = used.select(F.concat("vector", F.array(F.lit(1.0))).alias("v"))
    moments = second_moments(one, "v", size + 1)
    n = max(moments[-1, -1], 1.0)
    mean = moments[-1, :-1] / n
    spread, turned = np.linalg.eigh(moments[:-1, :-1] / n - np.outer(mean, mean))
    axes = turned[:, ::-1][:, : settings.axes]
    scales = np.sqrt(np.maximum(spread[::-1][: settings.axes], 1e-12))
    top = (1 << settings.bits) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = np.clip((floats(batch.column("vector")) - mean) @ axes / scales, -30, 30)
                cells = np.minimum(np.floor((top + 1) / (1 + np.exp(-1.702 * z))), top).astype(np.uint32)
                yield batch.append_column("key", pa.array(hilbert_keys(cells, settings.bits)))

    keyed = used.mapInArrow(run, "vec_id long, label long, vector array<double>, anchor boolean, key long")
    placed = global_positions(keyed, ["key", "vec_id"], "place")
    return placed.withColumn("block", int_div(F.col("place") - 1, F.lit(settings.block))).drop("key")


def _doubles(column) -> np.ndarray:
    """The rows of a column of equally long lists of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return floats(column)


def _packed(ordered: DataFrame) -> DataFrame:
    """A row for each block: block, ids, labels, vectors, lows, highs."""

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("vec_id").combine_chunks()
        x = _doubles(rows.column("vector"))
        return pa.table({
            "block": rows.column("block")[:1],
            "ids": pa.array([rows.column("vec_id").to_numpy().tobytes()], pa.binary()),
            "labels": pa.array([rows.column("label").to_numpy().tobytes()], pa.binary()),
            "vectors": pa.array([x.tobytes()], pa.binary()),
            "lows": pa.array([x.min(0).tobytes()], pa.binary()),
            "highs": pa.array([x.max(0).tobytes()], pa.binary()),
        })

    kind = "block long, ids binary, labels binary, vectors binary, lows binary, highs binary"
    return ordered.select("block", "vec_id", "label", "vector").groupBy("block").applyInArrow(pack, kind)


def _columns(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """A row for each column of anchors that have windows, sorted by id."""
    own = windows.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("no", "low", "high"))).alias("windows"))
    held = anchors.join(own, "anchor_id")
    return held.groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("anchor_id", "label", "block", "vector", "windows"))).alias("anchors")
    )


def bounds(anchors: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor (rows) with any vector
    between ``lows`` and ``highs`` of each block (columns), with a margin."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    margin = 1e-9 * (1 + np.abs(anchors) @ np.maximum(np.abs(lows), np.abs(highs)).T)
    return up @ lows.T + down @ highs.T - margin, up @ highs.T + down @ lows.T + margin


def _unpacked(value: list[dict]) -> tuple[np.ndarray, ...]:
    """Ids, labels, vectors and windows (low, high, number; rows of anchors,
    padded with windows that hold nothing) of a column's anchors."""
    most = max(len(a["windows"]) for a in value)
    low, high = np.full((len(value), most), HIGHEST), np.full((len(value), most), LOWEST)
    no = np.zeros((len(value), most), np.int32)
    for i, a in enumerate(value):
        for j, w in enumerate(a["windows"]):
            low[i, j], high[i, j], no[i, j] = w["low"], w["high"], w["no"]
    ids, labels = (np.array([a[k] for a in value], np.int64) for k in ("anchor_id", "label"))
    return ids, labels, np.array([a["vector"] for a in value], float), low, high, no


def _chosen(columns: DataFrame, zones: DataFrame, chunks: int) -> DataFrame:
    """(block, column, who): the anchors, by their number in the column, one
    of whose windows meets the bounds of a block that is not their own."""
    pairs = columns.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(zones, "chunk")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = batch.column("anchors")[row].as_py()
                ids, _, x, low, high, _ = _unpacked(value)
                zone = batch.column("zones")[row].as_py()
                blocks = np.array([z["block"] for z in zone])
                least, most = bounds(x, *(np.frombuffer(b"".join(z[k] for z in zone)).reshape(len(zone), -1) for k in ("lows", "highs")))
                meets = np.zeros(least.shape, bool)
                for j in range(low.shape[1]):
                    meets |= (most >= low[:, j, None]) & (least <= high[:, j, None]) & (low[:, j, None] <= high[:, j, None])
                meets &= np.array([a["block"] for a in value])[:, None] != blocks
                who = [np.flatnonzero(m).astype(np.int32) for m in meets.T]
                some = [k for k, w in enumerate(who) if len(w)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[some]), pa.array([batch.column("column")[row].as_py()] * len(some), pa.int64()),
                     pa.array([who[k] for k in some], pa.list_(pa.int32()))],
                    ["block", "column", "who"],
                )

    kind = "block long, column long, who array<int>"
    return pairs.select("column", "anchors", "zones").mapInArrow(run, kind)


def _scored(chosen: DataFrame, columns: DataFrame, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor_id, no, vec_id, score): at most k a window from each block."""
    asked = chosen.join(columns, "column").select("block", F.transform("who", lambda i: F.col("anchors")[i]).alias("anchors"))
    pairs = asked.join(blocks.select("block", "ids", "labels", "vectors"), "block")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a_ids, a_labels, a, low, high, no = _unpacked(batch.column("anchors")[row].as_py())
                ids, labels = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in ("ids", "labels"))
                b = np.frombuffer(batch.column("vectors")[row].as_buffer()).reshape(len(ids), -1)
                exact = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * a.shape[1] < 2**52
                score = (a @ b.T).astype(np.int64) if exact else a.astype(np.int64) @ b.astype(np.int64).T
                fits = (a_labels[:, None] == labels) == same
                fits &= a_ids[:, None] != ids
                for j in range(low.shape[1]):
                    inside = fits & (score >= low[:, j, None]) & (score <= high[:, j, None])
                    held = np.where(inside, score, LOWEST)
                    if len(ids) > k:
                        inside &= held >= np.partition(held, len(ids) - k, axis=1)[:, len(ids) - k, None]
                    q, v = np.nonzero(inside)
                    order = np.lexsort((ids[v], -score[q, v], q))
                    q, v = q[order], v[order]
                    top = np.arange(len(q)) - np.searchsorted(q, q) < k
                    q, v = q[top], v[top]
                    if len(q):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a_ids[q]), pa.array(no[q, j]), pa.array(ids[v]), pa.array(score[q, v])],
                            ["anchor_id", "no", "vec_id", "score"],
                        )

    return pairs.select("anchors", "ids", "labels", "vectors").mapInArrow(run, "anchor_id long, no int, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of every window, with their ranks."""
    order = Window.partitionBy("anchor_id", "no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(anchors: DataFrame, windows: DataFrame, blocks: DataFrame, zones: DataFrame, chunks: int, k: int, same: bool) -> DataFrame:
    """anchor_id, no, vec_id, score, rank: the k best in every window
    (anchor_id, no, low, high) among the rows of the same, or of another, label."""
    columns = written(_columns(anchors, windows), "columns")
    own = columns.select("column", F.posexplode("anchors").alias("at", "anchor"))
    own = own.groupBy(F.col("anchor.block").alias("block"), "column").agg(F.sort_array(F.collect_list("at")).alias("who"))
    first = written(_best(_scored(own, columns, blocks, k, same), k), "first").drop("rank")
    # a window with k results takes nothing below the least of them
    reached = first.groupBy("anchor_id", "no").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == k)
    raised = windows.join(reached.drop("n"), ["anchor_id", "no"], "left").select(
        "anchor_id", "no", F.greatest("low", F.coalesce("least", "low")).alias("low"), "high"
    )
    columns = written(_columns(anchors, raised), "columns")
    others = _scored(_chosen(columns, zones, chunks), columns, blocks, k, same)
    return _best(first.unionByName(others), k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    identity: str = "vec_id", label: str = "label", column: str = "embedding", scale: int = 256, settings: Settings = Settings(),
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of another
    label that score between ``least`` and ``most`` percent of the positive.

    Components become floor(``scale`` x); scores are integer inner products
    with the anchor, higher first, ties to the smaller id.  An anchor's
    positives are its first ``positives`` other rows of the same label.

    Output: anchor_id, positive_id, rank (int, from 1), negative_id,
    positive_score, negative_score.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part, nor do vectors of another than the most frequent length.
    Rows that repeat an id are one, with the smallest label and vector.  Equal
    vectors are candidates each.  Positives that score below 0 allow no
    negative.  Labels are whole numbers; scores must be below 2 ** 55.  Other
    columns play no part.  An empty table, or one without anchors, gives an
    empty result.
    """
    spark = ship(vectors.sparkSession)
    nothing = spark.sql(
        "SELECT 0L AS anchor_id, 0L AS positive_id, 0 AS rank, 0L AS negative_id, 0L AS positive_score, 0L AS negative_score LIMIT 0"
    )
    size = dimension(vectors, column)
    if not size:
        return nothing
    ordered = written(_ordered(_used(vectors, anchor, identity, label, column, size, scale), size, settings), "ordered")
    wanted = ordered.filter("anchor")
    if wanted.isEmpty():
        return nothing
    blocks = written(_packed(ordered), "blocks")
    chunk = int_div(F.col("block"), F.lit(settings.chunk)).cast("int").alias("chunk")
    zones = blocks.groupBy(chunk).agg(F.array_sort(F.collect_list(F.struct("block", "lows", "highs"))).alias("zones"))
    zones = written(zones, "zones")
    chunks = zones.agg(F.max("chunk")).first()[0] + 1
    anchors = global_positions(wanted, ["place"], "at").select(
        F.col("vec_id").alias("anchor_id"), "label", "vector", "block",
        int_div(F.col("at") - 1, F.lit(settings.column)).alias("column"),
    )
    anchors = written(anchors, "anchors")
    all_scores = anchors.select("anchor_id", F.lit(0).alias("no"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    own = _search(anchors, all_scores, blocks, zones, chunks, positives, same=True)
    own = written(own.select("anchor_id", F.col("rank").alias("no"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    low = int_div(F.col("positive_score") * least + 99, F.lit(100))
    windows = own.filter("positive_score >= 0").select(
        "anchor_id", "no", low.alias("low"), int_div(F.col("positive_score") * most, F.lit(100)).alias("high")
    )
    windows = written(windows.filter("low <= high"), "windows")
    found = _search(anchors, windows, blocks, zones, chunks, negatives, same=False)
    return found.join(own, ["anchor_id", "no"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def report(vectors: DataFrame) -> DataFrame:
    """Every 100th vector's negatives, where every 7th label is one too high."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)
