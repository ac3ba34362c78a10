"""Token counts of whole texts, huge ones by resynchronised chunks.

A text of more than ``chunk`` code points is cut in chunks that overlap,
each with the offsets where its pieces end.  Two neighbours are spliced at the
first offset in their overlap at which both end a piece, provided that offset
is proven in the earlier chunk.  The proof is by induction: the cut into
pieces runs left to right and never looks back, nor further ahead than a few
code points.  So, from a true boundary on, a chunk's boundaries are those of
the whole text, up to a margin before its end (a contraction or special token
that the end may cut through); and at a common boundary the later chunk joins
the true ones.  If an overlap holds no common boundary (a run of one class
that is longer), the earlier chunk is widened, doubling, until there is one or
the later chunk is swallowed; the width is kept, so that a run of any length
is cut about twice.  Pieces are encoded once, when a splice proves them.

The work space is a chunk or the longest run, not a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.bpe import PieceEncoder, encoder
from matchday.llm.common import field, map_text

CHUNK, OVERLAP = 1 << 14, 256


def spliced(text: str, encoder: PieceEncoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list[str]]:
    """The pieces of one text, cut ``chunk`` code points at a time."""

    def cut(begin: int, end: int) -> tuple[list[str], list[int]]:
        pieces = encoder.cut(text[begin:end])
        return pieces, list(accumulate(map(len, pieces), initial=begin))

    begin, end, wider = 0, min(len(text), chunk), overlap
    pieces, ends = cut(begin, end)  # begin is a true boundary
    while end < len(text):
        later, stop = end - overlap, min(len(text), end + chunk - overlap)
        next_pieces, next_ends = cut(later, stop)
        both = set(next_ends)
        while True:
            common = next((k for k, p in enumerate(ends) if p >= later and p <= end - encoder.margin and p in both), None)
            if common is not None or end >= stop:
                break
            wider *= 2
            end = min(end + wider, len(text))
            pieces, ends = cut(begin, end)
        if common is None:  # the later chunk is swallowed, or nothing is left for it
            continue
        yield pieces[:common]
        begin, wider = ends[common], overlap
        at = next_ends.index(begin)
        pieces, ends, end = next_pieces[at:], next_ends[at:], stop
    yield pieces


def ids_chunked(text: str, encoder: PieceEncoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[bytes]:
    """The ids of one text, some at a time."""
    for pieces in spliced(text, encoder, chunk, overlap):
        yield b"".join(encoder.encode([pieces])[0])


def count_chunked(text: str, encoder: PieceEncoder, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, encoded ``chunk`` code points at a time."""
    return sum(map(len, ids_chunked(text, encoder, chunk, overlap))) // 4  # an id has 4 bytes


def count(docs: DataFrame, tokenizer: str, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Append n_bytes (UTF-8), n_tokens and over_limit to every row.

    The count is that of the tokenizers library for the whole text, without
    added tokens; a special token's string inside a text counts as that token.
    Null and empty texts have none.  Repeated rows are counted alike; columns
    with these names are replaced.
    """

    def make():
        own = encoder(tokenizer)

        def compute(part: pa.RecordBatch) -> list:
            texts = [t or "" for t in part.column("text").to_pylist()]
            short = [t if len(t) <= chunk else "" for t in texts]
            counts = [len(ids) // 4 for ids in own.ids(short)]
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = count_chunked(t, own, chunk, overlap)
            return [counts]

        return compute

    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    counted = map_text(sized.drop("over_limit"), [field("n_tokens", "long")], make)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
