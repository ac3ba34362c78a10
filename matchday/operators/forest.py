"""A random forest that is a function of its rows, stated in relations.

Every choice is made from counts or from hashes, so neither cores, nor files,
nor the order of rows can change a forest, and SQL can restate it:

* *Bins.*  One histogram of equal cells between the least and the greatest
  value of each feature gives the quantiles that cut it into bins.
* *Bags.*  How often a tree takes a row is Poisson distributed, read off an md5
  of the row's key and the seed.
* *Splits.*  Level by level, for all trees at once: weights are summed by
  (tree, node, feature, bin, label), running sums over bins give what lies left
  and right of each cut, and the cut with the least Gini impurity wins.  Each
  node looks at the features with the smallest hashes of its own.

Bins, bags, counts and votes are numpy over whole columns of a batch: as
expressions, thousands of nodes a row, they took ten times as long.  A level is
one pass over the cached bins of the train rows, which are added up by bins and
label first where these have few combinations.  Each task counts its rows into
one table; sums and cuts are SQL.
What the driver sees is bounded by the model: one cut a node, one weight a
leaf and label, and the cells of the histograms.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchday.functions.columns import free_names

CELLS = 4096
#: Fixed-point unit of a tree's vote, which is spread over the labels of a leaf.
VOTE = 1 << 40
#: Combinations of bins and label up to which rows are added up before a forest is grown.
GATHERED = 1 << 20
#: Bits of a bin and of a weight (8 at most) in the longs that hold them.
BIN_BITS, WEIGHT_BITS = 7, 4
#: Rows that a task counts at once.
COUNTED = 1 << 17


@dataclass(frozen=True)
class Settings:
    """Trees, levels of cuts, bins of a feature (126 at most); features that a node looks
    at (0: the square root of all, rounded up); whether trees are bagged."""

    trees: int = 8
    depth: int = 5
    bins: int = 32
    subset: int = 0
    bagged: bool = True
    seed: int = 1

    def looked_at(self, features: int) -> int:
        return min(features, self.subset or math.ceil(math.sqrt(features)))


def poisson_limits(digits: int = 4) -> list[int]:
    """Hash values (of so many hex digits) below which a row is taken at most
    0, 1, 2 ... times by a tree: the Poisson distribution with mean 1."""
    shares = accumulate(math.exp(-1) / math.factorial(k) for k in range(8))
    return [int(s * 16**digits) for s in shares]


def row_key(df: DataFrame) -> Column:
    """A row's text: its columns joined, nulls left out."""
    return F.concat_ws("|", *(F.col(c).cast("string") for c in df.columns))


def _appended(
    df: DataFrame, made: Sequence[tuple[dict[str, str], Callable[[pa.RecordBatch], list[pa.Array]]]], drop: Sequence[str] = (),
) -> DataFrame:
    """``df`` without ``drop``, and columns (new names and their types) that
    functions of a batch make.

    The tasks get numbers and arrays, nothing that they would import this
    package for.
    """
    kept = [c for c in df.columns if c not in drop]
    fields = [T.StructField(name, T._parse_datatype_string(kind)) for types, _ in made for name, kind in types.items()]
    makers, names = [of for _, of in made], [*kept, *(f.name for f in fields)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(x for of in makers for x in of(batch))], names)

    out = df.mapInArrow(run, T.StructType([*(df.schema[c] for c in kept), *fields]))
    known = {c: df.schema[c].metadata for c in kept}
    return out.select(*(F.col(f"`{c}`").alias(c, metadata=known[c]) if known[c] else f"`{c}`" for c in kept), *(f"`{f.name}`" for f in fields))


def _lists(numbers: Callable[[pa.RecordBatch], np.ndarray]) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """Rows of numbers as one column of arrays."""

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = np.ascontiguousarray(numbers(batch))
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1]))
        return [pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))]

    return of


def _longs(numbers: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """Rows of small numbers as longs that hold 63 // bits of them each: columns
    that Spark caches and passes on at a small part of the cost of arrays."""
    held = 63 // bits

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = numbers(batch).astype(np.int64)
        parts = (rows[:, k : k + held] for k in range(0, rows.shape[1], held))
        return [pa.array((x << (bits * np.arange(x.shape[1]))).sum(1)) for x in parts]

    return of


def _places(name: str, bits: int, count: int) -> list[tuple[str, int]]:
    """The column and the first bit of each of ``count`` numbers of ``_longs``."""
    return [(f"{name}{i // (63 // bits)}", bits * (i % (63 // bits))) for i in range(count)]


def _with_digests(df: DataFrame, key: Column, settings: Settings) -> tuple[DataFrame, list[str]]:
    """``df`` with the md5s, of 16 bytes, that 8 trees each draw from."""
    digests = free_names(df, *(f"_digest{k}" for k in range(-(-settings.trees // 8) if settings.bagged else 0)))
    return df.withColumns({
        d: F.unhex(F.md5(F.concat_ws(":", key, F.lit(str(settings.seed)), F.lit(str(k))))) for k, d in enumerate(digests)
    }) if digests else df, digests


def _weights(digests: Sequence[str], settings: Settings) -> Callable[[pa.RecordBatch], np.ndarray]:
    """How often each tree takes the rows of a batch: two bytes a tree, each digest's in turn."""
    limits, trees = np.array(poisson_limits()), settings.trees

    def of(batch: pa.RecordBatch) -> np.ndarray:
        if not digests:
            return np.ones((batch.num_rows, trees), np.int8)
        parts = [np.frombuffer(b"".join(batch.column(d).to_pylist()), ">u2").reshape(-1, 8) for d in digests]
        return np.searchsorted(limits, np.concatenate(parts, axis=1)[:, :trees], side="right").astype(np.int8)

    return of


def _binning(names: Sequence[str], lows: Sequence[float], highs: Sequence[float], bin_of: Sequence[Sequence[int]]) -> Callable[[pa.RecordBatch], np.ndarray]:
    """The bins of the columns ``names`` (doubles) of a batch: as ``_cell``, then a lookup."""
    cells, tables = CELLS, [np.array(table, np.int8) for table in bin_of]

    def of(batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty((batch.num_rows, len(names)), np.int8)
        for i, name in enumerate(names):
            column, low, high = batch.column(name), lows[i], highs[i]
            x = column.to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.zeros(len(x))
            if high > low:
                with np.errstate(all="ignore"):
                    at = np.floor((x - low) / (high - low) * float(cells))
                at = np.clip(np.where(np.isnan(at), 0, at), 0, cells - 1)
                if column.null_count:
                    at[column.is_null().to_numpy(zero_copy_only=False)] = cells - 1
            out[:, i] = tables[i][at.astype(np.int64)]
        return out

    return of


def with_bags(df: DataFrame, key: Column, settings: Settings, name: str) -> DataFrame:
    """Append ``name``, how often each tree takes a row: four hex digits of an
    md5 a tree."""
    hashed, digests = _with_digests(df, key, settings)
    replaced = [c for c in df.columns if c.lower() == name.lower()]
    return _appended(hashed, [({name: "array<tinyint>"}, _lists(_weights(digests, settings)))], [*digests, *replaced])


def features_of(settings: Settings, tree: int, node: int, features: int) -> list[int]:
    """The features that a node looks at: those with the smallest md5."""
    named = lambda f: hashlib.md5(f"{settings.seed}:{tree}:{node}:{f}".encode()).hexdigest()
    return sorted(sorted(range(features), key=named)[: settings.looked_at(features)])


@contextmanager
def persisted(df: DataFrame):
    """Keep ``df`` cached (memory, spilling to disk) for the block.  Lost
    blocks are recomputed from lineage, so losing an executor is harmless."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to as many tasks as there are cores, if it is read from
    fewer files than that; many files are read as they are.  Only for what
    does not depend on the layout of the rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


@dataclass(frozen=True)
class Forest:
    """``cuts``: of each tree, by node (1 is the root, 2n and 2n + 1 are the
    children of n), (feature, last bin on the left).  ``votes``: by node, the
    fixed-point votes of each label where rows end."""

    features: tuple[str, ...]
    classes: int
    lows: tuple[float, ...]
    highs: tuple[float, ...]
    bin_of: tuple[tuple[int, ...], ...]
    cuts: tuple[dict[int, tuple[int, int]], ...]
    votes: tuple[dict[int, tuple[int, ...]], ...]
    depth: int


def _cell(feature: str, low: float, high: float) -> Column:
    """A value's cell between the least and the greatest; nulls in the last."""
    if not high > low:
        return F.lit(0)
    at = F.floor((F.col(feature) - F.lit(low)) / F.lit(high - low) * F.lit(float(CELLS)))
    return F.coalesce(F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), at)), F.lit(0)).cast("int")


def _quantile_bins(train: DataFrame, features: Sequence[str], bins: int) -> tuple[tuple, tuple, tuple]:
    """Least and greatest value of each feature, and the bin of each cell: how
    many of the ``bins`` quantiles the rows before it have passed."""
    ends = train.agg(*(g(f).alias(f"{n}{i}") for i, f in enumerate(features) for n, g in (("a", F.min), ("b", F.max)))).first()
    lows = tuple(float(ends[f"a{i}"] or 0.0) for i in range(len(features)))
    highs = tuple(float(ends[f"b{i}"] or 0.0) for i in range(len(features)))
    cells = F.posexplode(F.array(*[_cell(f, a, b) for f, a, b in zip(features, lows, highs)])).alias("feature", "cell")
    counts = {(r["feature"], r["cell"]): r["count"] for r in train.select(cells).groupBy("feature", "cell").count().collect()}
    tables = []
    for i in range(len(features)):
        sums = list(accumulate(counts.get((i, c), 0) for c in range(CELLS)))
        total, at, out = sums[-1], 0, []
        for below in (0, *sums[:-1]):
            at = below * bins // total if total else 0
            out.append(at)
        tables.append(tuple(out))
    return lows, highs, tuple(tables)


@dataclass(frozen=True)
class Binned:
    """Cached train rows (bins of all features and bag weights by tree in longs,
    a number for each label), and what their bins mean."""

    rows: DataFrame
    features: tuple[str, ...]
    lows: tuple[float, ...]
    highs: tuple[float, ...]
    bin_of: tuple[tuple[int, ...], ...]
    settings: Settings


@contextmanager
def binned(train: DataFrame, features: Sequence[str], labels: Sequence[str], settings: Settings, key: Column):
    """Bins and bags of the train rows, for the forests grown in the block on
    any of the features and labels (columns that number the classes)."""
    lows, highs, bin_of = _quantile_bins(train, features, settings.bins)
    hashed, digests = _with_digests(spread(train), key, settings)
    columns = [f"_feature{i}" for i in range(len(features))]
    kept = hashed.select(
        *(F.col(f).cast("double").alias(c) for f, c in zip(features, columns)), *(F.col(x).cast("int").alias(x) for x in labels), *digests
    )
    bins, weights = _places("_bins", BIN_BITS, len(features)), _places("_weights", WEIGHT_BITS, settings.trees)
    rows = _appended(kept, [
        (dict.fromkeys((c for c, _ in bins), "long"), _longs(_binning(columns, lows, highs, bin_of), BIN_BITS)),
        (dict.fromkeys((c for c, _ in weights), "long"), _longs(_weights(digests, settings), WEIGHT_BITS)),
    ], [*columns, *digests])
    with persisted(rows):
        yield Binned(rows, tuple(features), lows, highs, bin_of, settings)


@dataclass(frozen=True)
class Counted:
    """Rows with a label, and where it, the bins of each feature and the weights
    of each tree are: column, first bit, mask."""

    rows: DataFrame
    label: tuple[str, int, int]
    bins: tuple[tuple[str, int, int], ...]
    weights: tuple[tuple[str, int, int], ...]


def _sums(data: Counted, settings: Settings, classes: int, cuts: list[dict[int, tuple[int, int]]], level: int, open_: dict) -> DataFrame:
    """Weights by (tree, node, feature, bin, label) over the nodes of a level
    that ``open_`` names with the features they look at; or, without any, by
    (tree, node, label) where rows end.

    Every task counts its rows into one table (of a size that the model
    bounds) and gives what is not 0: the partial sums of the shuffle to come.
    """
    width, radix, shown = 1 << (settings.depth + 1), settings.bins + 1, len(data.bins)
    feature, last = np.full((settings.trees, width), -1), np.zeros((settings.trees, width), np.int64)
    for t, of in enumerate(cuts):
        for n, (f, cut) in of.items():
            feature[t, n], last[t, n] = f, cut
    look = np.full((settings.trees, width, settings.looked_at(shown)), -1)
    for (t, n), of in open_.items():
        look[t, n] = of
    steps = max((n.bit_length() for of in cuts for n in of), default=0)
    low = 1 << level if open_ else 0
    shape = (width if not open_ else low, shown, radix, classes) if open_ else (width, classes)

    # the tasks get numbers and arrays, nothing that they would import this package for
    trees, cutting, most = settings.trees, bool(open_), COUNTED
    names = ["tree", "node", *(["feature", "bin"] if open_ else []), "label", "w"]

    label_at, bins_at, weights_at = data.label, data.bins, data.weights

    def numbers(batch: pa.RecordBatch, places: Sequence[tuple[str, int, int]], kind: type) -> np.ndarray:
        out = np.empty((len(places), batch.num_rows), kind)
        for i, (name, shift, mask) in enumerate(places):
            out[i] = (batch.column(name).to_numpy() >> shift) & mask
        return out

    def count(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], totals: list[np.ndarray]) -> None:
        y, bins, weights = (np.concatenate(x, axis=-1) for x in zip(*parts))
        n, b = len(y), bins.reshape(-1)
        for t in range(trees):
            own = np.flatnonzero(weights[t])
            w, label, node = weights[t].take(own).astype(np.float64), y.take(own), np.ones(len(own), np.int64)
            for _ in range(steps):
                f = feature[t].take(node)
                node = np.where(f < 0, node, 2 * node + (b.take(np.maximum(f, 0) * n + own) > last[t].take(node)))
            if not cutting:
                totals[t] += np.bincount(node * classes + label, w, len(totals[t]))
                continue
            here = np.flatnonzero(look[t, :, 0].take(node) >= 0)
            if len(here) < len(own):
                own, w, label, node = own[here], w[here], label[here], node[here]
            first = (node - low) * (shown * radix * classes) + label
            for k in range(look.shape[2]):
                f = look[t, :, k].take(node)
                place = first + (f * radix + b.take(f * n + own)) * classes
                totals[t] += np.bincount(place, w, len(totals[t]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(int(np.prod(shape))) for _ in range(trees)]  # whole numbers
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = numbers(batch, [label_at], np.int64)[0]
            parts.append((y, numbers(batch, bins_at, np.int8), numbers(batch, weights_at, np.int64)))
            held += batch.num_rows
            if held >= most:
                count(parts, totals)
                parts, held = [], 0
        if parts:
            count(parts, totals)
        for t, total in enumerate(totals):
            found = np.flatnonzero(total)
            parts = np.unravel_index(found, shape)
            made = [np.full(len(found), t), parts[0] + low, *parts[1:], total[found]]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in made], names)

    parts = data.rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return parts.repartition("tree", "node", *(["feature"] if open_ else [])).groupBy(*names[:-1]).agg(F.sum("w").alias("w"))


def best_cuts(sums: DataFrame) -> DataFrame:
    """The best cut of every (tree, node) from weights by (tree, node, feature,
    bin, label), where one lowers the Gini impurity.

    With l and r the label weights on either side, the impurity is least where
    sum(l^2) / sum(l) + sum(r^2) / sum(r) is greatest.  Sums of squares come
    from running sums: a label's weight adds the difference of its squares.
    Squares are decimals, exact up to 10^18 rows.  Ties go to the first
    feature, then the first bin.

    Output: tree, node, feature, bin (the last one on the left).
    """
    own, to_here = "PARTITION BY tree, node, feature", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    ran = sums.selectExpr(
        "tree", "node", "feature", "bin", "w",
        f"sum(w) OVER ({own}, label ORDER BY bin {to_here}) AS l",
        f"sum(w) OVER ({own}, label) AS a",
    )
    # with w more, l squared grows by w (2l - w) and r squared shrinks by w (2r + w)
    steps = ran.selectExpr(
        "tree", "node", "feature", "bin", "w",
        "CAST(w AS DECIMAL(19, 0)) * CAST(2 * l - w AS DECIMAL(19, 0)) AS dl",
        "CAST(w AS DECIMAL(19, 0)) * CAST(2 * (a - l) + w AS DECIMAL(19, 0)) AS dr",
    )
    by_bin = steps.groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("n"), F.sum("dl").alias("dl"), F.sum("dr").alias("dr"))
    cut = by_bin.selectExpr(
        "tree", "node", "feature", "bin",
        f"sum(n) OVER ({own} ORDER BY bin {to_here}) AS nl", f"sum(n) OVER ({own}) AS na",
        f"CAST(sum(dl) OVER ({own} ORDER BY bin {to_here}) AS DOUBLE) AS sl",
        f"CAST(sum(dr) OVER ({own}) - sum(dr) OVER ({own} ORDER BY bin {to_here}) AS DOUBLE) AS sr",
        f"CAST(sum(dr) OVER ({own}) AS DOUBLE) AS sa",
    ).filter("nl < na")
    scored = cut.selectExpr("*", "sl / nl + sr / (na - nl) AS score").filter("score > sa / na")
    best = F.expr("max_by(struct(feature, bin), struct(score, -feature, -bin)) AS best")
    return scored.groupBy("tree", "node").agg(best).select("tree", "node", "best.*")


def fit_forest(
    train: DataFrame, features: Sequence[str], label: str, classes: int, settings: Settings = Settings(), key: Column | None = None,
) -> Forest:
    """Grow a forest on the rows of ``train``.

    ``label`` numbers the classes from 0.  ``key``: the text that a row's bag
    weights are hashed from (all columns, if not given); rows with equal keys
    are taken equally often.  Null features count as the greatest; rows with a
    null label are left out of the sums.  Without rows, every vote is 0.
    """
    with binned(train, features, [label], settings, row_key(train) if key is None else key) as data:
        return grow(data, features, label, classes)


@contextmanager
def _gathered(data: Binned, columns: list[int], label: str, classes: int):
    """The rows with a label that a forest is grown on.

    A forest sees no more of a row than these bins and its label, so where
    they have few combinations, rows alike in them are added up, once for all
    levels, and a level costs no more than the combinations.
    """
    radix, places = data.settings.bins + 1, [_places("_bins", BIN_BITS, len(data.features))[c] for c in columns]
    bins, weights = (1 << BIN_BITS) - 1, (1 << WEIGHT_BITS) - 1
    own = _places("_weights", WEIGHT_BITS, data.settings.trees)
    read = lambda c, shift, mask: F.shiftright(c, shift).bitwiseAND(F.lit(mask).cast("long"))
    known = data.rows.filter(F.col(label).isNotNull()).withColumn("label", F.col(label))
    if len(columns) * BIN_BITS > 63 or radix ** len(columns) * classes > GATHERED:
        used, (last, shift) = dict.fromkeys(c for c, _ in (*places, *own)), own[-1]
        at, rows = ("label", 0, -1), known.select(*used, "label")
        if shift + WEIGHT_BITS + classes.bit_length() <= 63:  # a column less to pass on
            at = (last, shift + WEIGHT_BITS, (1 << classes.bit_length()) - 1)
            rows = rows.withColumn(last, F.col(last).bitwiseOR(F.shiftleft(F.col("label").cast("long"), at[1]))).drop("label")
        yield Counted(rows, at, tuple((*p, bins) for p in places), tuple((*p, weights) for p in own))
        return
    code = reduce(Column.bitwiseOR, (F.shiftleft(read(*p, bins), BIN_BITS * i) for i, p in enumerate(places)))
    sums = [F.sum(read(*p, weights)).alias(f"w{t}") for t, p in enumerate(own)]
    with persisted(known.groupBy(code.alias("code"), "label").agg(*sums)) as rows:
        yield Counted(
            rows, ("label", 0, -1), tuple(("code", BIN_BITS * i, bins) for i in range(len(columns))), tuple((f"w{t}", 0, -1) for t in range(len(own)))
        )


def grow(data: Binned, features: Sequence[str], label: str, classes: int) -> Forest:
    """A forest on some of the features of binned rows."""
    columns = [data.features.index(f) for f in features]
    with _gathered(data, columns, label, classes) as counted:
        cuts, votes = _grown(counted, data.settings, classes)
    own = lambda of: tuple(of[c] for c in columns)
    return Forest(tuple(features), classes, own(data.lows), own(data.highs), own(data.bin_of), cuts, votes, data.settings.depth)


def _grown(data: Counted, settings: Settings, classes: int) -> tuple[tuple, tuple]:
    """Cuts and votes of a forest."""
    cuts: list[dict[int, tuple[int, int]]] = [{} for _ in range(settings.trees)]
    for level in range(settings.depth):
        open_ = {
            (t, n): features_of(settings, t, n, len(data.bins))
            for t in range(settings.trees) for n in range(1 << level, 2 << level) if not level or n // 2 in cuts[t]
        }
        if not open_:
            break
        for r in best_cuts(_sums(data, settings, classes, cuts, level, open_)).collect():
            cuts[r["tree"]][r["node"]] = (r["feature"], r["bin"])
    held: list[dict[int, list[int]]] = [{} for _ in range(settings.trees)]
    for r in _sums(data, settings, classes, cuts, settings.depth, {}).collect():
        held[r["tree"]].setdefault(r["node"], [0] * classes)[r["label"]] = r["w"]
    return tuple(cuts), tuple({n: tuple(w * VOTE // sum(ws) for w in ws) for n, ws in of.items()} for of in held)


def _votes(model: Forest, names: Sequence[str]) -> Callable[[pa.RecordBatch], np.ndarray]:
    """The votes of a batch by class: sums over the trees of the leaf that a
    row's bins (of the columns ``names``) lead to."""
    bins_of, trees, depth, width = _binning(names, model.lows, model.highs, model.bin_of), len(model.cuts), model.depth, 1 << (model.depth + 1)
    feature, last = np.full((trees, width), -1), np.zeros((trees, width), np.int64)
    table = np.zeros((trees, width, model.classes), np.int64)
    for t in range(trees):
        for n, (f, cut) in model.cuts[t].items():
            feature[t, n], last[t, n] = f, cut
        for n, votes in model.votes[t].items():
            table[t, n] = votes

    def of(batch: pa.RecordBatch) -> np.ndarray:
        n, rows = batch.num_rows, np.arange(batch.num_rows)
        b = np.ascontiguousarray(bins_of(batch).T).reshape(-1)
        total = np.zeros((n, table.shape[2]), np.int64)
        for t in range(trees):
            node = np.ones(n, np.int64)
            for _ in range(depth):
                f = feature[t].take(node)
                node = np.where(f < 0, node, 2 * node + (b.take(np.maximum(f, 0) * n + rows) > last[t].take(node)))
            total += table[t].take(node, axis=0)
        return total

    return of


def _scored(df: DataFrame, models: Sequence[Forest], made: Callable) -> DataFrame:
    """``df`` with what ``made`` says of each model: types of columns by name,
    and a function of a batch, given a model's number and its ``_votes``."""
    used = list(dict.fromkeys(f for model in models for f in model.features))
    doubles = {f.name for f in df.schema if f.dataType == T.DoubleType()}
    columns = [f if f in doubles else c for f, c in zip(used, free_names(df, *(f"_feature{i}" for i in range(len(used)))))]
    cast = {c: F.col(f).cast("double") for f, c in zip(used, columns) if c != f}
    votes = [_votes(model, [columns[used.index(f)] for f in model.features]) for model in models]
    return _appended(df.withColumns(cast) if cast else df, [made(i, of) for i, of in enumerate(votes)], list(cast))


def apply_forest(df: DataFrame, model: Forest, suffix: str = "") -> DataFrame:
    """Append rawPrediction, probability and prediction, as of a classifier of
    ``pyspark.ml``, their names ending in ``suffix``.

    Votes are whole numbers, so the prediction (the first class with the most
    votes) does not depend on the order of the trees.
    """
    made = [f"{c}{suffix}" for c in ("rawPrediction", "probability", "prediction")]
    df = df.drop(*made)  # replaced
    votes, total = free_names(df, f"_votes{suffix}", f"_total{suffix}")
    scored = _scored(df, [model], lambda _, of: ({votes: "array<long>"}, _lists(of)))
    added = F.aggregate(F.col(votes), F.lit(0).cast("long"), lambda a, x: a + x)
    out = scored.withColumn(total, F.greatest(added, F.lit(1).cast("long")))
    return out.withColumns(dict(zip(made, [
        array_to_vector(F.transform(votes, lambda x: x / F.lit(float(VOTE)))),
        array_to_vector(F.transform(votes, lambda x: x / F.col(total))),
        (F.array_position(F.col(votes), F.array_max(votes)) - 1).cast("double"),
    ]))).drop(votes, total)


def _chosen(votes: Callable[[pa.RecordBatch], np.ndarray], label: str) -> Callable[[pa.RecordBatch], list[pa.Array]]:
    """The first class with the most votes, and the share of the votes that the
    class in the column ``label`` has (0, if there is no such class)."""

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        found, at = votes(batch), batch.column(label).to_numpy(zero_copy_only=False).astype(np.float64)
        known = (at >= 0) & (at < found.shape[1])
        own = found[np.arange(len(found)), np.where(known, at, 0).astype(np.int64)]
        share = np.where(known, own / np.maximum(found.sum(1), 1), 0.0)
        return [pa.array(found.argmax(1).astype(np.float64)), pa.array(share)]

    return of


def judge_forests(df: DataFrame, models: dict[str, tuple[Forest, str]]) -> DataFrame:
    """For each suffix, with a model and the column of its true classes, append
    prediction and true_prob, the probability given to the true class, as of
    ``apply_forest``: all models in one pass, without the vectors between."""
    if not models:
        return df
    named = list(models.items())
    return _scored(df, [model for model, _ in models.values()], lambda i, of: (
        {f"prediction{named[i][0]}": "double", f"true_prob{named[i][0]}": "double"}, _chosen(of, named[i][1][1])
    ))
