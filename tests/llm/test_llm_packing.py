import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import clashing, docs, rows
from tokenizers import Tokenizer

from matchday.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 256), st.integers(1, 500), min_size=1, max_size=80))
def test_plan_uses_every_piece_once_and_wastes_little(histogram):
    bins = packing.plan(histogram, 256, 32)
    used = Counter()
    for count, lengths in bins:
        assert count > 0 and sum(lengths) <= 256
        for n in lengths:
            used[n] += count
    assert used == Counter(histogram)
    best_fit = sum(c for c, _ in packing._best_fit([], dict(histogram), 256))
    assert sum(c for c, _ in bins) <= best_fit


def test_least_squares_is_nonnegative_and_optimal():
    r = np.random.default_rng(1)
    matrix, true = r.random((20, 12)), np.maximum(r.normal(size=12), 0)
    x = packing.nonnegative_least_squares(matrix, matrix @ true, 100)
    assert (x >= 0).all() and np.allclose(x, true, atol=1e-6)


def check_places(found):
    at = defaultdict(list)
    for r in found:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        places.sort()
        end = 0
        for offset, length in places:
            assert offset == end  # gapless from 0
            end += length
        assert end <= 2048
    return len(at)


def test_pieces_and_places(spark):
    found = packing.pack_documents(clashing(docs(spark)), PATH).collect()
    check_places(found)
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 2048 + 1
        bounds = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want


def test_hot_length_in_cells(spark):
    made = spark.createDataFrame([(i, 0, 0, 7 if i % 3 else 500 + i % 90, 0) for i in range(900)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(made, per_cell=16).collect()
    assert len(found) == 900 and len({r["doc_id"] for r in found}) == 900
    check_places(found)


def test_near_the_least_number_of_sequences(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = packing.pack_documents(table, PATH).collect()
    least = -(-sum(r["length"] for r in found) // 2048)
    assert check_places(found) <= 1.01 * least + 1


def test_empty_table_and_bad_lengths(spark):
    assert packing.pack_documents(docs(spark, []), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0)], "doc_id long, length long"))


def test_long_texts_are_encoded_in_chunks(spark, monkeypatch):
    words = " ".join(f"word{i % 977} ét{i % 31}" for i in range(60_000)) + " " + "x" * 60_000 + " " * 3_000 + "end"
    assert len(words) > packing.LONG
    got = packing.pieces(docs(spark, [(1, words, None, None, None)]), PATH).collect()
    ids = Tokenizer.from_file(PATH).encode(words, add_special_tokens=False).ids + [0]
    first = len(ids) - (len(ids) - 1) // 2048 * 2048
    bounds = [0, *range(first, len(ids) + 1, 2048)]
    want = {(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:]))}
    assert {tuple(r)[1:] for r in got} == want
