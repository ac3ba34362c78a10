import random

import public_tokenizers
import pytest
from llm_samples import clashing, docs, rows
from tokenizers import Tokenizer

from matchday.llm import tokens
from matchday.llm.bpe import PieceEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "l", "é", "ß", "1", "22", "!", "<|endoftext|>", "<|endof", "　", "日本", "\x1c", "🎈", "ſ", "\t", "|>", "²", "٣", " \n ", " ", "\xa0", "\xad"]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(PATH)


def random_texts(count, seed=3):
    r = random.Random(seed)
    for _ in range(count):
        yield "".join(r.choice(BITS) * (1 if r.random() < 0.8 else r.randint(1, 30)) for _ in range(r.randint(0, 120)))


def test_whole_and_chunked_counts_equal_the_library(encoder):
    library = Tokenizer.from_file(PATH)
    for text in random_texts(600):
        ids = library.encode(text, add_special_tokens=False).ids
        assert b"".join(encoder.encode([encoder.cut(text)])[0]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert tokens.count_chunked(text, encoder, 40, 16) == len(ids), repr(text)


def test_overlaps_widen_over_long_runs(encoder):
    library = Tokenizer.from_file(PATH)
    for text in ("a" * 5000, " " * 3000 + "b", "x y " * 100 + "z" * 2000 + " end", "<|endoftext|>" * 300):
        assert tokens.count_chunked(text, encoder, 64, 20) == len(library.encode(text, add_special_tokens=False).ids)


def test_memory_of_pieces_starts_anew(encoder, monkeypatch):
    from matchday.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    own, library = PieceEncoder(PATH), Tokenizer.from_file(PATH)
    for text in random_texts(100, 9):
        assert len(own.ids([text])[0]) == 4 * len(library.encode(text, add_special_tokens=False).ids)


def test_every_text_is_counted(spark):
    library = Tokenizer.from_file(PATH)
    found = tokens.count(clashing(docs(spark)), PATH).collect()
    assert len(found) == len(rows())
    want = {d: t or "" for d, t, *_ in rows() if d is not None}
    for r in found:
        if r["doc_id"] is not None:
            text = want[r["doc_id"]]
            n = len(library.encode(text, add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024)
    assert tokens.count(docs(spark, []), PATH).collect() == []


@pytest.mark.parametrize("run", ["a", " ", "7", "!", "é", "ab "])
def test_long_runs_cost_little_more_than_the_library(encoder, run):
    from time import perf_counter

    text = "some words. " + run * (600_000 // len(run)) + " and an end"
    start = perf_counter()
    want = len(encoder._library.encode(text, add_special_tokens=False).ids)
    library, start = perf_counter() - start, perf_counter()
    assert tokens.count_chunked(text, encoder) == want
    assert perf_counter() - start < 3 * library + 1
    assert all(len(p) <= 256 for p in encoder._known if p not in encoder._ids)
