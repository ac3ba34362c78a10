"""Language identification: multinomial naive Bayes on hashed character n-grams.

Training counts hashed 1-, 2- and 3-grams of lower-cased text per language in
every task, sums them in Spark, and turns the counts into a matrix of log
probabilities (buckets x languages), which is broadcast; its size is bounded
by ``buckets * max_languages`` doubles.  Scoring concatenates a slice of texts
into one array of code points, hashes all grams at once, and sums the matrix
rows of each text's (sparse) grams.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.common import field, map_text, ship, text_slices

ORDERS = (1, 2, 3)
#: Longer texts are hashed in pieces of so many code points.
PIECE = 1 << 18
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """Languages (sorted) and ``weights``: log probabilities per bucket, one
    more row of zeros for gaps between texts, and log priors."""

    languages: list[str]
    weights: np.ndarray
    priors: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.weights) - 1


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, str, int]]:
    """(text number, lower-cased piece, grams may start before) of texts with a
    letter; a piece repeats the first code points of the next one."""
    for i, text in enumerate(texts):
        if text is None or not any(map(str.isalpha, text)):
            continue
        low = f" {text.lower()} "
        if len(low) <= PIECE:
            yield i, low, len(low)
        else:
            for at in range(0, len(low), PIECE):
                yield i, low[at : at + PIECE + max(ORDERS) - 1], PIECE


def _grams(texts: list[str | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For a few pieces at a time: their text numbers, where each starts, and
    the bucket of every gram (a row per order; ``buckets``: no gram)."""
    shift = np.uint32(32 - int(math.log2(buckets)))
    group: list[tuple[int, str, int]] = []

    def hashed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        gap = "\0" * (max(ORDERS) - 1)
        points = np.frombuffer("".join(p + gap for _, p, _ in group).encode("utf-32-le", "surrogatepass"), "<u4")
        starts = np.cumsum([0, *(len(p) + len(gap) for _, p, _ in group)])
        out = np.empty((len(ORDERS), len(points)), np.int64)
        real = points != 0
        for (_, piece, may), start in zip(group, starts):
            real[start + may : start + len(piece)] &= may >= len(piece)
        rolled, inside = np.zeros(len(points), np.uint32), real.copy()
        padded = np.concatenate([points, np.zeros(max(ORDERS), np.uint32)])
        for n in range(1, max(ORDERS) + 1):
            rolled = rolled * np.uint32(0x01000193) + padded[n - 1 : n - 1 + len(points)] + np.uint32(1)
            inside &= padded[n - 1 : n - 1 + len(points)] != 0
            mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n * 0x3C6EF)
            out[n - 1] = np.where(inside, mixed >> shift, buckets)
        return np.array([i for i, _, _ in group]), starts[:-1], out

    size = 0
    for piece in _pieces(texts):
        group.append(piece)
        size += len(piece[1])
        if size >= PIECE:
            yield hashed()
            group, size = [], 0
    if group:
        yield hashed()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", buckets: int = 1 << 14,
          smoothing: float = 0.5, max_languages: int = 256) -> Model:
    """Fit on every row with a language and a letter in its text.

    Rows with null text or language, or without a letter, teach nothing.  An
    empty table gives a model without languages.  More than ``max_languages``
    languages is an error, as the matrix would have no bound.
    """
    ship(docs.sparkSession)
    labelled = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    seen = labelled.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(seen) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if the matrix may be that large")
    languages = sorted(r["lang"] for r in seen)
    number = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), buckets + 2), np.int64)  # the last: texts
        for batch in batches:
            for part in text_slices(batch, "text"):
                of = np.array([number[x] for x in part.column("lang").to_pylist()])
                for texts, starts, grams in _grams(part.column("text").to_pylist(), buckets):
                    rows = np.repeat(of[texts], np.diff([*starts, grams.shape[1]])) * (buckets + 2)
                    for order in grams:
                        totals += np.bincount(rows + order, minlength=totals.size).reshape(totals.shape)
                for i in of[[t is not None and any(map(str.isalpha, t)) for t in part.column("text").to_pylist()]]:
                    totals[i, -1] += 1
        totals[:, buckets] = 0
        at, bucket = np.nonzero(totals)
        for k in range(0, len(at), 1 << 16):
            i, j = at[k : k + (1 << 16)], bucket[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(totals[i, j])], ["lang", "bucket", "n"]
            )

    counted = labelled.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros((buckets + 2, len(languages)))
    if languages:
        found = counted.toArrow()
        sums[found.column("bucket").to_numpy(), found.column("lang").to_numpy()] = found.column("n").to_numpy()
    texts = sums[-1]
    kept = texts > 0
    sums, texts = sums[:buckets, kept], texts[kept]
    weights = np.log((sums + smoothing) / (sums.sum(0) + smoothing * buckets)) if len(texts) else sums
    return Model(
        [x for x, k in zip(languages, kept) if k],
        np.vstack([weights, np.zeros((1, len(texts)))]),
        np.log(texts / texts.sum()) if len(texts) else texts,
    )


def predict(docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score",
            lettered: str | None = None) -> DataFrame:
    """Append the most probable language of every whole text and its posterior.

    Texts that are null or have no letter get ``und`` and score 0, as do all
    texts under a model without languages.  Equal posteriors go to the first
    language by name.  ``lettered`` names a third column, whether the text has a
    letter; that depends on no model, and ``und`` may also be a language that
    was learned.  Columns that already bear these names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value
        names = np.array([*own.languages, UNKNOWN], dtype=object)

        def compute(part: pa.RecordBatch) -> list:
            texts = part.column(text).to_pylist()
            sums = np.zeros((len(texts), len(own.languages)))
            known = np.zeros(len(texts), bool)
            if own.languages:
                for which, starts, grams in _grams(texts, own.buckets):
                    for order in grams:
                        np.add.at(sums, which, np.add.reduceat(own.weights[order], starts, axis=0))
                    known[which] = True
                sums += own.priors
                best = np.where(known, sums.argmax(1), len(own.languages))
                top = sums.max(1, keepdims=True)
                value = np.where(known, 1.0 / np.exp(sums - top).sum(1), 0.0)
            else:
                best, value = np.zeros(len(texts), int), np.zeros(len(texts))
                known[:] = [t is not None and any(map(str.isalpha, t)) for t in texts]
            return [pa.array(names[best], pa.string()), pa.array(value), pa.array(known)]

        return compute

    fields = [field(label, "string"), field(score, "double")]
    return map_text(docs, fields + ([field(lettered, "boolean")] if lettered else []), make, text)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text (null: empty) leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and predict every row.

    Output: doc_id, held_out, lang_pred, score.  Repeated rows are predicted
    alike and each returned.
    """
    model = train(docs.filter(~held_out()))
    flagged = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(flagged, model).select("doc_id", "held_out", "lang_pred", "score")
