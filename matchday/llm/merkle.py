"""Merkle manifest of a dataset by content-addressed descent.

Every row is a leaf, the digest of its fields.  Per group (language), leaves
in order of their ids are folded: every ``ARITY`` consecutive nodes become the
digest of their digests until one is left, the group's subroot; subroots are
folded likewise to the root.

The tree is stored as records from a digest to what it was made of.  A record
holds a segment, ``HEIGHT`` levels below its digest, so that few joins reach a
leaf.  Leaf requests descend from the root by the digits of their ranks: at
each segment the digit selects a node of its lowest level, the nodes that were
not selected on the way are collected, and the segments' paths, reversed, are
the proof.  Requests that share leading digits descend as one, so a step joins
a record with at most ``ARITY ** HEIGHT`` requests and no record is hot; a
group that holds most rows is many segments, like any other.

All of it is Spark SQL: sha2 over strings, arrays folded by ``transform``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import int_div
from matchday.llm.common import written
from matchday.operators.ranking import group_positions

ARITY, HEIGHT = 2, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    """Lowercase hex sha256 of a string's UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the byte length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of a row's encoded fields."""
    return digest(F.concat(*map(encoded, fields)))


def _folded(nodes: Column) -> Column:
    """The level above: every ``ARITY`` consecutive nodes become one."""
    runs = F.sequence(F.lit(0), int_div(F.size(nodes) - 1, F.lit(ARITY)).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * ARITY + 1, F.lit(ARITY)), "")))


def _segments(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Segments over the nodes (``keys``, rank, n, node) of one level.

    Output: ``keys``, rank, n (nodes of the level above), node (the segment's
    digest), levels (arrays of nodes, lowest first, its top left out).
    """
    width = ARITY**HEIGHT
    held = nodes.groupBy(*keys, int_div(F.col("rank"), F.lit(width)).alias("above")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "node"))), lambda x: x["node"]).alias("level"),
        F.first("n").alias("n"),
    )
    # levels until the group has one node: all of them where it fits a segment
    held = held.withColumn("levels", F.array().cast("array<array<string>>"))
    for k in range(HEIGHT):
        more = F.col("n") > ARITY**k
        held = held.withColumns({
            "levels": F.when(more, F.concat("levels", F.array("level"))).otherwise(F.col("levels")),
            "level": F.when(more, _folded(F.col("level"))).otherwise(F.col("level")),
        })
    above = F.ceil(F.col("n") / width).cast("long")
    return held.select(*keys, F.col("above").alias("rank"), above.alias("n"), F.col("level")[0].alias("node"), "levels")


def _fold_all(nodes: DataFrame, keys: list[str], most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(segments of every step, lowest first; what remains of each group:
    ``keys``, node and how many steps it took).  ``most``: nodes of the
    largest group."""
    steps, done = [], []
    while True:
        done.append(nodes.filter("n = 1").select(*keys, "node", F.lit(len(steps)).alias("steps")))
        if most <= 1:
            return steps, reduce(DataFrame.unionByName, done)
        nodes = written(_segments(nodes.filter("n > 1"), keys), name)
        steps.append(nodes)
        most = -(-most // ARITY**HEIGHT)


def _records(steps: list[DataFrame]) -> DataFrame:
    """digest -> levels; equal content is stored once."""
    parts = [step.select("node", "levels") for step in steps]
    return written(reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.first("levels").alias("levels")), "records")


def _descend(requests: DataFrame, keys: list[str], top: DataFrame, records: DataFrame | None, steps: int) -> DataFrame:
    """Requests (``keys``, rank, more columns) with the columns of ``top``:
    ``node`` becomes the request's own, and ``path`` gets the nodes that were
    not selected, from the lowest up, as (left, right) joined digests.

    ``top``: what remains of each group, with its steps, the path above it
    and columns that are handed down.
    """
    width = ARITY**HEIGHT
    carried = [c for c in top.columns if c not in keys]
    at = top.withColumn("prefix", F.lit(0).cast("long"))
    for k in reversed(range(steps)):
        # requests that lead to one node of this step's lowest level are one
        prefix = F.floor(F.col("rank") / width**k).cast("long")
        asked = requests if k == 0 else requests.select(*keys, prefix.alias("rank")).distinct()
        asked = asked.withColumn("__parent", int_div(F.col("rank"), F.lit(width)))
        own = [c for c in asked.columns if c != "__parent"]
        here = at.filter(F.col("steps") > k).join(records, "node")
        here = here.withColumnsRenamed({c: f"__{c}" for c in here.columns})
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
        joined = asked.join(here, [*same, F.col("__parent") == F.col("__prefix")])
        digit = F.pmod(F.col("rank"), F.lit(width)).cast("int")

        def passed(level: Column, i: Column) -> Column:
            place = F.floor(digit / F.pow(F.lit(ARITY), i)).cast("int")
            first = place - F.pmod(place, F.lit(ARITY))
            left = F.slice(level, first + 1, place - first)
            right = F.slice(level, place + 2, F.lit(ARITY - 1) - (place - first))
            return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))

        new = {"node": F.col("__levels")[0][digit], "path": F.concat(F.transform("__levels", passed), F.col("__path"))}
        joined = joined.select(*own, *(new.get(c, F.col(f"__{c}")).alias(c) for c in carried))
        waiting = at.filter(F.col("steps") <= k)  # groups of fewer steps
        if k:
            at = written(joined.withColumnRenamed("rank", "prefix").unionByName(waiting), "descent")
        else:
            at = joined
    # groups whose one leaf is what remains
    single = top.filter("steps = 0").withColumnsRenamed({c: f"__{c}" for c in keys})
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    lone = requests.join(single, same).select(*requests.columns, *carried)
    return at.unionByName(lone) if steps else lone


def _climbed(leaf: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its path."""
    return F.aggregate(path, leaf, lambda node, p: digest(F.concat(p["left"], node, p["right"])))


def manifest(rows: DataFrame, fields: Sequence[str], group: str, identity: str, tampered: Column | None = None) -> DataFrame:
    """A proof for each row of a table and what it proves.

    ``fields``: columns that a leaf is the digest of.  ``tampered``: the leaf
    that is presented instead of a row's own, null where its own is.

    Output: ``identity``, leaf, subroot, root, path (from the leaf up, arrays
    of the joined digests left and right of it), folded_root (from what is
    presented), verified.

    Rows are in order of ``identity`` (nulls first), equal ones by their leaf,
    so repeated rows are leaves each; a null group is one, the first.  Groups
    go by their UTF-8 bytes.  Null and empty values differ.  A text is hashed
    whole (2 GB at most, as any Spark string).  Other columns, whatever their
    names, play no part.  An empty table gives an empty result.
    """
    own = leaf_digest([F.col(c) for c in fields])
    leaves = rows.select(
        F.col(identity).alias("id"), F.col(group).cast("string").alias("grp"), own.alias("leaf"),
        (F.lit(None).cast("string") if tampered is None else tampered).alias("shown"),
    )
    ranked = group_positions(leaves, ["grp"], ["id", "leaf"], "rank").withColumn("rank", F.col("rank") - 1)
    ranked = written(ranked, "leaves")
    counts = written(ranked.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "groups")
    largest, groups = counts.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = ranked.alias("a").join(counts.alias("b"), F.col("a.grp").eqNullSafe(F.col("b.grp")))
    lower, subroots = _fold_all(nodes.select("a.grp", "a.rank", "b.n", F.col("a.leaf").alias("node")), ["grp"], largest or 0, "segments")
    # the tree of the groups, one of a single group
    placed = subroots.withColumn("one", F.lit(0)).withColumnRenamed("steps", "below")
    placed = group_positions(placed, ["one"], ["grp"], "rank").withColumn("rank", F.col("rank") - 1)
    placed = written(placed.withColumn("n", F.lit(groups)), "subroots")
    upper, roots = _fold_all(placed.select("one", "rank", "n", "node"), ["one"], groups, "tops")
    records = _records([*lower, *upper]) if lower or upper else None
    none = F.array().cast("array<struct<left:string,right:string>>")
    roots = roots.withColumns({"path": none, "root": F.col("node")})
    tops = _descend(placed.select("one", "rank", "grp", "below"), ["one"], roots, records, len(upper))
    tops = written(tops.select("grp", "node", "path", "root", F.col("node").alias("subroot"), F.col("below").alias("steps")), "subroots")
    found = _descend(ranked, ["grp"], tops, records, len(lower))
    folded = _climbed(F.coalesce("shown", "leaf"), F.col("path"))
    out = found.select(F.col("id").alias(identity), "leaf", "subroot", "root", "path", folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def report(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, a seventh of them tampered with.

    Where 7 divides the crc32 of the decimal doc_id, the leaf that is shown is
    that of n_chars + 1.  Output: doc_id, leaf, subroot, root, proof_sha256
    (digest of the joined path), folded_root, verified.
    """
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    other = leaf_digest([more if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    proved = manifest(docs, FIELDS, "lang", "doc_id", F.when(hit, other))
    joined = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    return proved.select("doc_id", "leaf", "subroot", "root", digest(joined).alias("proof_sha256"), "folded_root", "verified")
