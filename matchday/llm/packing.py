"""Best-fit packing by length patterns.

Documents become pieces of at most ``capacity`` tokens; only longer documents
are cut.  The driver sees one number per length: how many pieces have it.  On
that histogram, of bounded size whatever the corpus,

1. patterns of one to three lengths that fill a sequence are enumerated on a
   grid of lengths, and non-negative least squares fits how often each pattern
   must be repeated to use up the histogram;
2. the repeats are rounded down and their grid cells are filled with real
   lengths;
3. what is left, and the room the patterns leave, is packed best fit, longest
   first, many equal lengths at a time.

The result is a list of slots: for a run of pieces of one length, which
sequences they go to and at which offset.  Each piece finds its slot by its
number among the pieces of its length, so no group of pieces is gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.bpe import encoder
from matchday.llm.common import field, map_text, rank_in_cells, ship, written
from matchday.llm.tokens import ids_chunked

CAPACITY = 2048
#: Code points up to which a text is encoded whole.
LONG = 1 << 18


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int | None = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's pieces.

    A document's ids end with the id ``end``; null texts are empty, so they
    have this id alone.  Documents of more than ``capacity`` ids are cut; all
    pieces but the first are full.  A very long text is encoded in chunks, so
    that beside it only its ids (4 bytes each) are held.  Repeated rows have
    pieces each; other columns, whatever their names, play no part.
    """
    last = b"" if end is None else np.array([end], "<u4").tobytes()

    def make():
        own = encoder(tokenizer)

        def compute(part: pa.RecordBatch) -> list:
            out = []
            texts = [t or "" for t in part.column("text").to_pylist()]
            short = own.ids([t if len(t) <= LONG else "" for t in texts])
            for text, ids in zip(texts, short):
                ids = memoryview(b"".join([*ids_chunked(text, own), last]) if len(text) > LONG else ids + last)
                n = len(ids) // 4
                first = n - (n - 1) // capacity * capacity if n else 0
                bounds = [0, *range(first, n + 1, capacity)] if n else []
                out.append([
                    {"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])}
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
                ])
            return [out]

        return compute

    kind = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
    made = map_text(docs.select("doc_id", "text"), [field("pieces", kind)], make, drop=["text"])
    return made.select("doc_id", F.inline("pieces"))


def nonnegative_least_squares(matrix: np.ndarray, goal: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 that minimises |matrix x - goal|, by the active-set method."""
    x, active = np.zeros(matrix.shape[1]), np.zeros(matrix.shape[1], bool)
    enough = 1e-9 * max(1.0, np.abs(matrix.T @ goal).max(initial=0))
    rounds = rounds if len(x) else 0
    for _ in range(rounds):
        slope = matrix.T @ (goal - matrix[:, active] @ x[active])
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= enough:
            break
        active[best] = True
        while active.any():
            own = np.flatnonzero(active)
            found = np.linalg.lstsq(matrix[:, own], goal, rcond=None)[0]
            if (found > 0).all():
                x[own] = found
                break
            low = own[found <= 0]
            step = np.min(x[low] / np.maximum(x[low] - found[found <= 0], 1e-300))
            x[own] += step * (found - x[own])
            x[low[x[low] <= 1e-9]] = 0
            active &= x > 0
        x[~active] = 0
    return x


def _patterns(cells: np.ndarray, full: int) -> list[tuple[int, ...]]:
    """Multisets of one to three occupied cells, largest first, that sum to
    ``full``: repeating them leaves no room, so that least squares, which does
    not know of room, cannot waste any."""
    cells = [int(c) for c in cells]
    known = set(cells)
    out = {(full,)} & {(c,) for c in cells}
    out |= {(a, full - a) for a in cells if full - a in known and 2 * a >= full}
    for i, a in enumerate(cells):
        for b in cells[: i + 1]:
            c = full - a - b
            if 0 <= c <= b and c in known:
                out.add((a, b, c))
    return sorted(out)


def plan(
    histogram: dict[int, int], capacity: int = CAPACITY, cells: int = 64, shares: tuple[float, ...] = (0.9, 0.6, 0.3, 0.0)
) -> list[tuple[int, tuple[int, ...]]]:
    """(how many sequences, lengths in each) that use up the histogram.

    The grid is for the fit alone: a pattern takes real lengths of its cells
    that fill a sequence to the last token.  Of the fitted repeats each share
    of ``shares`` is tried, so that pieces of all lengths are left to fill
    what remains, and the plan of fewest sequences is taken: with the share 0
    among them, never more than best fit alone needs.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    width = max(1, -(-capacity // cells))
    of = lambda n: (n + width // 2) // width  # noqa: E731  a length's cell
    members: dict[int, list[int]] = defaultdict(list)
    for n in sorted(left):
        members[of(n)].append(n)
    if not members:
        return []
    occupied = np.array(sorted(members))
    patterns = _patterns(occupied, of(capacity))
    row = {int(c): i for i, c in enumerate(occupied)}
    matrix = np.zeros((len(occupied), len(patterns)))
    for k, pattern in enumerate(patterns):
        for c in pattern:
            matrix[row[c], k] += 1
    goal = np.array([sum(left[n] for n in members[c]) for c in occupied], float)
    # short pieces can fill what patterns leave, so long ones weigh more
    weight = np.sqrt((occupied + 1) / (occupied.max() + 1))[:, None]
    repeats = nonnegative_least_squares(matrix * weight, goal * weight[:, 0], 3 * len(occupied))
    fitted = [(patterns[k], float(repeats[k])) for k in np.flatnonzero(repeats >= 1)]
    fitted.sort(key=lambda x: (-x[0][0], x[0]))
    plans = (_packed(fitted, share, members, dict(left), capacity) for share in shares)
    return min(plans, key=lambda bins: sum(count for count, _ in bins))


def _packed(fitted, share: float, members, left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """A share of the fitted repeats, and best fit for what is left."""
    bins: list[tuple[int, tuple[int, ...]]] = []
    for pattern, repeats in fitted:
        times = int(repeats * share)
        while times > 0:
            chosen = _real_lengths(pattern, members, left, capacity)
            if not chosen:
                break
            run = min([times, *(left[n] // chosen.count(n) for n in chosen)])
            for n in chosen:
                left[n] -= run
            bins.append((run, chosen))
            times -= run
    return _best_fit(bins, left, capacity)


def _real_lengths(pattern, members, left, capacity) -> tuple[int, ...]:
    """Lengths still left, one of each cell of a pattern but the last, whose
    sum a length still left completes exactly; longest first, () if none."""

    def choose(chosen: tuple[int, ...], cells: tuple[int, ...]) -> tuple[int, ...]:
        if len(cells) == 1:
            rest = capacity - sum(chosen)
            return (*chosen, rest) if left.get(rest, 0) > chosen.count(rest) else ()
        for n in reversed(members[cells[0]]):
            if left[n] > chosen.count(n):
                found = choose((*chosen, n), cells[1:])
                if found:
                    return found
        return ()

    return choose((), pattern)


def _best_fit(bins: list[tuple[int, tuple[int, ...]]], left: dict[int, int], capacity: int):
    """Add the lengths left, longest first, each to the fullest bins it fits."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for count, lengths in bins:
        room[capacity - sum(lengths)].append((count, lengths))
    spaces = sorted(room)
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        count = left[n]
        while count:
            k = bisect_left(spaces, n)
            if k == len(spaces):
                each = min(capacity // n, count)
                opened = count // each
                made = [(opened, (n,) * each)]
                count -= opened * each
            else:
                space = spaces[k]
                total, lengths = room[space].pop()
                if not room[space]:
                    del room[space]
                    spaces.pop(k)
                each = min(space // n, count)
                used = min(total, count // each)
                made = [(used, lengths + (n,) * each), (total - used, lengths)]
                count -= used * each
            for times, lengths in made:
                if times:
                    rest = capacity - sum(lengths)
                    if rest not in room:
                        insort(spaces, rest)
                    room[rest].append((times, lengths))
    return [b for group in room.values() for b in group]


def _slots(bins: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Sorted by (length, first rank): the sequences and offset of each run."""
    rows, first, base = [], defaultdict(int), 0
    for count, lengths in bins:
        offset = 0
        for n in lengths:
            rows.append((n, first[n], base, offset))
            first[n] += count
            offset += n
        base += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3]}


def pack(made: DataFrame, capacity: int = CAPACITY, per_cell: int = 1000) -> DataFrame:
    """Append sequence_id and offset to pieces (a ``length`` and the columns
    that tell them apart).

    Rows of equal length are interchangeable; repeated rows get a place each.
    An empty table gives an empty result; lengths must be 1 to ``capacity``.
    """
    spark = ship(made.sparkSession)
    counted = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).limit(capacity + 1).collect()}
    if any(n is None or not 0 < n <= capacity for n in counted):
        raise ValueError(f"lengths must be 1 to {capacity}")
    slots = spark.sparkContext.broadcast(_slots(plan(counted, capacity)))
    cells = np.ones(capacity + 1, np.int64)
    for n, c in counted.items():
        cells[n] = -(-c // per_cell)
    cells = F.element_at(F.array(*[F.lit(int(c)) for c in cells]), (F.col("length") + 1).cast("int"))
    keys = [c for c in made.columns if c != "length"]
    ranked = rank_in_cells(made, ["length"], [F.col(c) for c in keys], F.xxhash64(*keys), cells, "__rank")

    def place(batches):
        own = slots.value
        # one ordered key for (length, rank): ranks are below 2^48
        key = (own["length"] << 48) + own["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy()
            at = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            kept = [c for c in batch.schema.names if c != "__rank"]
            sequence = own["sequence"][at] + rank - own["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(own["offset"][at])],
                [*kept, "sequence_id", "offset"],
            )

    columns = [c for c in ranked.columns if c != "__rank"]
    schema = ranked.select(*columns).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack whole documents (doc_id, text) into sequences.

    Output: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    return pack(written(pieces(docs, tokenizer, capacity), "pieces"), capacity)
