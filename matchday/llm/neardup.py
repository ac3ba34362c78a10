"""Near-duplicate groups from SetSketch registers.

1. Every text becomes its set of distinct word shingles, a 128-bit key of that
   set and a SetSketch: ``registers`` exponentially spaced, truncated minima of
   hashed shingles.  Minima over a union are minima of minima, so sketches
   merge, and two registers are equal about as often as the sets are similar.
2. Documents with equal sets form one class, represented by one row.
3. Registers are banded.  Classes that share a band are candidates: each
   member of a bucket with the class of the bucket's smallest id, its centre (a
   star, so a bucket of any size gives one pair a member).  A joint likelihood of
   the register comparisons and the known set sizes drops pairs that cannot
   reach the threshold; the rest are confirmed on full sets.
4. Members of a centre's buckets that are not linked with it may still be
   linked with each other.  Two sets that reach the threshold share one of
   their rarest shingles (the prefix filter: of n shingles in one order, one of
   the first n - ceil(t n) + 1), so members that share none of theirs with
   another are done, in time in proportion to their sets.  The others are
   compared with each other, in blocks bounded by rows and by
   shingles, on full sets; a block yields links that join what it finds
   connected, at most one a member.  So the star loses no link.
5. Links become components.

All of it stays in Spark tables: no pair, link or component reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.columns import free_names
from matchday.llm.common import field, map_text, written


@dataclass(frozen=True)
class Settings:
    """Shingle width in words, similarity in percent, and the sketch.

    With 40 bands of 5 registers, a pair at 80 percent misses every band once
    in ten million.  ``slack`` is the likelihood ratio (twice the difference
    of log likelihoods) up to which a lower estimate is still confirmed:
    20 is 4.5 standard deviations.  ``block`` and ``shingles``: members of a
    block, and shingles of them, about.
    """

    width: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0
    slack: float = 20.0
    block: int = 1024
    shingles: int = 1 << 20
    seed: int = 17

    @property
    def registers(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: bytes | None, width: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text.

    Words are maximal runs without ASCII white space, A-Z lower-cased.  A text
    with fewer words than ``width`` has one shingle, the whole sequence; a
    text without words has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    count = len(words) - span + 1
    mixed = np.full(count, span, np.uint64)
    for k in range(span):
        mixed = (mixed ^ ids[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def registers_of(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    """SetSketch registers (uint16) of a non-empty set of hashes."""
    rng = np.random.default_rng(settings.seed)
    factor = rng.integers(0, 1 << 32, settings.registers, np.uint32) | np.uint32(1)
    offset = rng.integers(0, 1 << 32, settings.registers, np.uint32)
    return _registers(hashes, factor, offset, settings)


def _registers(hashes: np.ndarray, factor: np.ndarray, offset: np.ndarray, settings: Settings) -> np.ndarray:
    low = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(short), 256):
        np.minimum(low, (short[k : k + 256, None] * factor + offset).min(0), out=low)
    smallest = -np.log1p(-(low + 0.5) / 2.0**32) / settings.rate  # of exponential variables
    return np.clip(np.floor(1 - np.log(smallest) / np.log(settings.base)), 0, 65535).astype(np.uint16)


def similarity(higher: np.ndarray, lower: np.ndarray, equal: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int):
    """Maximum-likelihood Jaccard similarity of sets of n and m elements from
    how many registers of the first are higher, lower and equal, and twice the
    log likelihood lost at the threshold (0 where the estimate reaches it,
    infinite where the sizes rule it out).

    ``base`` is so near 1 that the limit 1 is taken, which differs by less
    than 0.1 percent: the three probabilities are u - vJ, v - uJ and J for
    u = n / (n + m), v = 1 - u, and the maximum solves a quadratic.
    """
    u = n / (n + m)
    v = 1 - u
    square = u * v * (higher + lower + equal)
    linear = v * v * higher + u * u * lower + (u * u + v * v) * equal
    most = np.minimum(u / v, v / u)
    best = (linear - np.sqrt(np.maximum(linear**2 - 4 * square * u * v * equal, 0))) / (2 * square)
    best = np.clip(best, 1e-9, most)
    at = percent / 100

    def log_likelihood(j):
        tiny = 1e-12
        return (
            higher * np.log(np.maximum(u - v * j, tiny))
            + lower * np.log(np.maximum(v - u * j, tiny))
            + equal * np.log(j)
        )

    lost = np.where(best >= at, 0.0, 2 * (log_likelihood(best) - log_likelihood(np.minimum(at, most))))
    return best, np.where(100 * np.minimum(n, m) < percent * np.maximum(n, m), np.inf, lost)


def _as_registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)


def sketch(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, text_key, n_shingles, node (128-bit key of the set), sketch;
    node and sketch are null for an empty set."""

    def make():
        rng = np.random.default_rng(settings.seed)
        factor = rng.integers(0, 1 << 32, settings.registers, np.uint32) | np.uint32(1)
        offset = rng.integers(0, 1 << 32, settings.registers, np.uint32)
        words = _WordHashes()

        def compute(part: pa.RecordBatch) -> list:
            sizes, nodes, sketches = [], [], []
            for text in part.column("data").to_pylist():
                found = shingle_hashes(text, settings.width, words)
                sizes.append(len(found))
                nodes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sketches.append(_registers(found, factor, offset, settings).tobytes() if len(found) else None)
            return [sizes, nodes, sketches]

        return compute

    data = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("data"))
    return map_text(
        data, [field("n_shingles", "long"), field("node", "binary"), field("sketch", "binary")], make, "data", drop=["data"]
    )


def _bands(classes: DataFrame, settings: Settings) -> DataFrame:
    """A row (band, id) for each band of each class; ``id``: 64-bit hash of the node."""

    def make():
        def compute(part: pa.RecordBatch) -> list:
            values = _as_registers(part.column("sketch")).astype(np.uint64).reshape(-1, settings.bands, settings.rows)
            keys = np.broadcast_to(np.arange(1, settings.bands + 1, dtype=np.uint64), values.shape[:2]).copy()
            for k in range(settings.rows):
                keys = (keys ^ values[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(31)
            flat = pa.array(keys.view(np.int64).reshape(-1))
            ends = np.arange(0, flat.__len__() + 1, settings.bands, dtype=np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), flat)]

        return compute

    keyed = map_text(
        classes.select(F.xxhash64("node").alias("id"), "sketch"), [field("bands", "array<bigint>")], make, "sketch", drop=["sketch"]
    )
    return keyed.select(F.explode("bands").alias("band"), "id")


def _stars(classes: DataFrame, settings: Settings) -> DataFrame:
    """(u, v, wide): ids of the classes that share a band with its smallest id,
    v, and whether one of these bands has more classes than the two.

    Rows of a band are moved once, as two numbers, and counted and paired where
    they meet.
    """
    banded = _bands(classes, settings).repartition("band")
    buckets = banded.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("centre")).filter("size > 1")
    return (
        banded.join(buckets, "band")
        .filter("id <> centre")
        .groupBy(F.col("id").alias("u"), F.col("centre").alias("v"))
        .agg(F.max(F.col("size") > 2).alias("wide"))
    )


def _likely(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The nodes of pairs of ids (u, v), and whether their sketches leave them
    likely enough."""
    part = _only_wanted(
        classes.select(F.xxhash64("node").alias("key"), "node", "n_shingles", "sketch"),
        pairs.select(F.explode(F.array("u", "v")).alias("text_key")),
    )
    both = pairs.join(part.toDF("u", "node_u", "nu", "su"), "u").join(part.toDF("v", "node_v", "nv", "sv"), "v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _as_registers(batch.column("su")), _as_registers(batch.column("sv"))
                n, m = batch.column("nu").to_numpy(), batch.column("nv").to_numpy()
                _, lost = similarity((a > b).sum(1), (a < b).sum(1), (a == b).sum(1), n, m, settings.percent)
                kept = batch.select(["node_u", "node_v", "wide"]).rename_columns(["u", "v", "wide"])
                yield kept.append_column("likely", pa.array(lost <= settings.slack))

    return both.mapInArrow(run, "u binary, v binary, wide boolean, likely boolean")


def _rivals(members: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The members (node, centre, linked) that may be linked with another of
    their centre, one of the two not ``linked`` with it; with ``n``, the size
    of their sets.

    In each centre, shingles are ordered by how many members have them, after
    those that no such pair shares.  Of n shingles that must share
    ceil(t n), all but the last ceil(t n) - 1 are looked at.

    A shingle of a member is moved as two numbers: the member's (odd if it is
    ``linked``) and a hash of centre and shingle.  Hashes that meet by chance
    only make a shingle more frequent, so no pair is lost.
    """
    members = members.join(sets.select("node", F.size("hashes").alias("n")), "node")
    number = 2 * F.monotonically_increasing_id() + F.col("linked").cast("long")
    # said here, as Spark would say it of some readers of ``each`` only, which then had an exchange each
    members = written(members.withColumn("m", number), "members").filter("m is not null")

    def common(rows: DataFrame) -> DataFrame:
        held = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min(F.col("m") % 2).alias("closed"))
        return held.filter("df > 1 and closed = 0").select("h", "df")

    each = members.join(_held(sets, members), "node").select("m", "centre", F.explode("hashes").alias("h"))
    each = each.select("m", F.xxhash64("centre", "h").alias("h")).repartition("h")
    # moved row by row: lists made before would be of one shingle or two, and longer only where partitions are few
    own = each.join(common(each), "h").repartition("m")
    own = own.groupBy("m").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("shared"))
    must = F.ceil(F.col("n") * settings.percent / 100).cast("int")
    first = F.greatest(F.size("shared") - must + 1, F.lit(0))
    looked = own.join(members.select("m", "n"), "m").select("m", F.explode(F.slice("shared", F.lit(1), first)).alias("s"))
    looked = looked.select("m", F.col("s.h").alias("h")).repartition("h")
    met = looked.join(common(looked), "h").select("m").distinct()
    return members.join(met, "m").select("node", "centre", "linked", "n")


def _links_within(groups: DataFrame, settings: Settings) -> DataFrame:
    """Links (u, v) that connect what is linked within a group.

    Rows with ``linked`` are connected already.  Each of the others is
    compared with all rows at once, by marking its hashes among theirs.
    """

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        hashes = rows.column("hashes").chunk(0)
        starts = hashes.offsets.to_numpy()[:-1] - hashes.offsets[0].as_py()
        sizes = np.diff(hashes.offsets.to_numpy())
        codes = np.unique(hashes.flatten().to_numpy(), return_inverse=True)[1]
        marks = np.zeros(codes.max() + 1, np.int32)
        group = np.where(rows.column("linked").to_numpy(zero_copy_only=False), -1, np.arange(len(sizes)))
        left, right = [], []
        for i in np.flatnonzero(group >= 0):
            own = codes[starts[i] : starts[i] + sizes[i]]
            marks[own] = 1
            shared = np.add.reduceat(marks[codes], starts).astype(np.int64)
            marks[own] = 0
            alike = 100 * shared >= settings.percent * (sizes + sizes[i] - shared)
            for j in np.flatnonzero(alike):
                if group[j] != group[i]:
                    left.append(i), right.append(j)
                    group[group == group[j]] = group[i]
        node = rows.column("node").chunk(0)
        return pa.table({"u": node.take(pa.array(left, pa.int64())), "v": node.take(pa.array(right, pa.int64()))})

    return groups.groupBy("centre", "lo", "hi").applyInArrow(compare, "u binary, v binary")


#: Bits of the filter of wanted texts (4 MB), in bitmaps of 32,768 bits each.
FILTER_BITS = 1 << 25


def _only_wanted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``texts`` (with their hash, ``key``) that may be among ``wanted``
    (by ``text_key``): all that are, and a few of the others, so that a join to
    come does not move the texts of all documents.

    A bit set of the hashes, of a fixed size, is made by Spark's bitmap
    aggregates and broadcast.
    """

    def place(of: str) -> tuple:
        at = F.pmod(F.col(of), F.lit(FILTER_BITS)) + 1
        return F.bitmap_bucket_number(at), F.bitmap_bit_position(at)

    bucket, bit = place("text_key")
    bitmaps = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bitmap"))
    bucket, bit = place("key")
    own = texts.withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(bitmaps), "_bucket")
    held = F.conv(F.hex(F.expr("substring(_bitmap, CAST(_bit div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), F.pmod("_bit", F.lit(8)).cast("int"))
    return own.filter(held.bitwiseAND(mask) != 0).select(*texts.columns)


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, settings: Settings) -> DataFrame:
    """(node, hashes) of the full shingle sets of some classes, from the text
    of the document that stands for the class."""
    # ids and texts that meet by chance are dropped with their sets: those have another node
    row = F.xxhash64("first_doc", "text_key").alias("text_key")
    wanted = classes.join(nodes, "node").select(row, F.col("node").alias("wanted"))
    texts = docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("key"), F.col("text").cast("binary").alias("data"))
    chosen = _only_wanted(texts, wanted).join(wanted, F.col("key") == F.col("text_key"))
    # repeated rows have met in this join
    chosen = chosen.select("key", "wanted", "data").distinct().drop("key")

    def make():
        words = _WordHashes()

        def compute(part: pa.RecordBatch) -> list:
            sets = [shingle_hashes(x, settings.width, words) for x in part.column("data").to_pylist()]
            nodes = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).astype(np.uint64).view(np.int64)
            return [nodes, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

        return compute

    made = map_text(chosen, [field("node", "binary"), field("hashes", "array<bigint>")], make, "data", drop=["data"])
    return made.filter("node = wanted").select("node", "hashes")


def _held(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets that may be of ``nodes``: a join to come does not move the others."""
    keyed = sets.withColumn("key", F.xxhash64("node"))
    return _only_wanted(keyed, nodes.select(F.xxhash64("node").alias("text_key"))).drop("key")


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    both = pairs.join(sets.toDF("u", "su"), "u").join(sets.toDF("v", "sv"), "v")
    shared = F.size(F.array_intersect("su", "sv"))
    return (
        both.select("u", "v", (F.size("su") + F.size("sv")).alias("total"), shared.alias("shared"))
        .filter(100 * F.col("shared") >= settings.percent * (F.col("total") - F.col("shared")))
        .select("u", "v")
    )


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) for every node of undirected links (u, v): the smallest
    node that it is connected with.

    Alternating large and small stars: each round links every node to the
    smallest of its neighbours, in tables, until each node has one link and
    leads to a node without any.  The number of rounds grows with the
    logarithm of the longest chain.
    """
    links = links.filter("u <> v").select("u", "v")
    there = F.struct("u", "v")
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    while True:
        # both directions of one evaluation: links may come from groups whose
        # choice of links differs when they are computed again
        both = written(links.select(F.inline(F.array(there, back))), name)
        lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(lowest, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large, name)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(lowest).distinct(), name)
        ends = links.select(F.col("v").alias("u")).distinct()
        many = links.groupBy("u").count().filter("count > 1").select("u")
        if many.union(links.join(ends, "u", "left_semi").select("u")).isEmpty():
            return links.toDF("node", "root").union(ends.select("u", "u"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text).

    Output: doc_id, n_shingles, component_id (smallest doc_id reachable over
    links, itself included), kept (doc_id = component_id), root (key of the
    component, null for an empty set), text_key (64-bit hash of the text).

    Null, empty and blank texts have an empty set and are linked with nothing.
    A very long text is one set of hashes (8 bytes a distinct shingle).  Other
    columns, whatever their names, play no part.  Repeated rows are linked like any equal texts and all returned.  A null
    doc_id is linked by its text and never the smallest unless alone.
    """
    sketched = written(sketch(docs, settings), "sketches")
    classes = written(
        sketched.filter("node is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("ref"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
        .select("node", F.col("ref.doc_id").alias("first_doc"), "ref.text_key", "n_shingles", "sketch"),
        "classes",
    )
    stars = written(_stars(classes, settings), "stars")
    pairs = written(_likely(stars, classes, settings).filter("likely or wide"), "pairs")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = written(_sets(docs, classes, nodes, settings), "sets")
    links = written(_confirmed(pairs.filter("likely").select("u", "v"), sets, settings), "confirmed")

    # centres with members that are not linked with them
    wide = pairs.filter("wide").join(links.withColumn("linked", F.lit(True)), ["u", "v"], "left").select(
        F.col("u").alias("node"), F.col("v").alias("centre"), F.coalesce("linked", F.lit(False)).alias("linked")
    )
    wide = written(wide, "wide")
    opened = wide.groupBy("centre").agg(F.min("linked").alias("closed")).filter("not closed").select("centre")
    members = wide.join(opened, "centre").select("node", "centre", "linked").union(
        opened.select(F.col("centre").alias("node"), "centre", F.lit(True).alias("linked"))
    )
    rivals = written(_rivals(members, sets, settings), "rivals")
    opened = rivals.groupBy("centre").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("size") / settings.block), F.ceil(F.col("all") / settings.shingles)).cast("int")
    dealt = (
        rivals.join(opened, "centre")
        .withColumn("block", F.pmod(F.xxhash64("node", "centre"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("node", "centre", "linked", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        .join(_held(sets, rivals), "node")
    )
    roots = components(links.union(_links_within(dealt, settings)))

    found = classes.select("node", "first_doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = found.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    grouped = found.select("node", "root").join(lowest, "root")
    out = sketched.select("doc_id", "text_key", "n_shingles", "node").join(grouped, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "root",
        "text_key",
    )


def first_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, with its columns.

    The row with the smallest doc_id stays; of rows that repeat id and text,
    the least in its other columns.  Rows with an empty set (null, empty and
    blank texts) are linked with nothing and all stay.  Columns keep their
    values, whatever their names.
    """
    # rows of equal id and text have equal sets, hence one group
    identity, key, row = free_names(docs, "_id", "_key", "_row")
    groups = written(
        near_duplicates(docs, settings).filter("root is not null").select("root", "doc_id", "text_key", "component_id"), "groups"
    )
    rank = F.struct(
        F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), 0).otherwise(1), F.col("doc_id").isNull(), "doc_id", "text_key"
    )
    first = groups.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_key"), rank).alias("first")).select("first.*")
    first = first.distinct().toDF(identity, row)
    blank = F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\f\r", "     ")) == ""
    keyed = docs.withColumn(key, F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col(identity)) & (F.col(key) == F.col(row))
    chosen = keyed.filter(~blank).join(first, same).drop(row)
    # of rows that repeat id and text, one: the least in all its columns that can be compared
    order = [F.col(c) for c in docs.columns if not isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType))]
    one = Window.partitionBy("doc_id", key).orderBy(*order)
    chosen = chosen.withColumn(row, F.row_number().over(one)).filter(F.col(row) == 1)
    return chosen.select(*docs.columns).unionByName(docs.filter(blank))
