"""Ids of a byte-level BPE tokenizer file, with a memory of pieces.

Byte-level BPE first cuts a text into pieces (a word with its leading space, a
run of digits, of signs, of white space) and then encodes each piece on its
own.  The same pieces come again and again, so a worker keeps the ids of pieces
that the tokenizers library has encoded and asks it for new ones only.

The cut is made by Python's ``re`` where the characters of a text leave no
room for doubt: ASCII and Latin letters, whose classes are the same in every
Unicode version, without a special token's string.  Any other text is cut by
the library.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Iterable
from functools import cache

# The published pre-tokenization pattern of byte_bpe_50k, with its
# classes of letters, numbers and spaces written out for the range below.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = " \t\n\r"
_PIECE = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
_UNSURE = re.compile("[^ -~\t\n\r¡-¬®-ɏ‐-‧]")
#: Pieces that a worker remembers, about 170 bytes each; it starts anew beyond.
#: Code points of the longest one that it remembers.
REMEMBERED, LONGEST = 400_000, 256


@cache
def encoder(path: str) -> PieceEncoder:
    """The encoder of a worker process, kept for its later tasks: a piece has
    the same ids in all of them."""
    return PieceEncoder(path)


class PieceEncoder:
    """Cuts and encodes texts by one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        if "ByteLevel" not in repr(self._library.pre_tokenizer) or self._library.normalizer is not None:
            raise ValueError("a byte-level tokenizer without a normalizer is needed")
        special = {t.content: i for i, t in self._library.get_added_tokens_decoder().items()}
        self._special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._ids = {w: array("I", [i]).tobytes() for w, i in special.items()}
        self._known = _Memory(self._ids)
        #: Code points of the longest special string.
        self.margin = max([4, *map(len, special)])

    def cut(self, text: str) -> list[str]:
        """The pieces of a text, in order; joined they are the text."""
        if not (self._special and self._special.search(text)):
            return self._cut(text)
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [*self._cut(text[at : m.start()]), m[0]]
            at = m.end()
        return out + self._cut(text[at:])

    def _cut(self, text: str) -> list[str]:
        if not _UNSURE.search(text):
            return _PIECE.findall(text)
        return [text[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def encode(self, cut: Iterable[list[str]]) -> list[list[bytes]]:
        """Ids (little-endian unsigned 32 bits) of each piece of each text."""
        if len(self._known) > REMEMBERED:
            self._known = _Memory(self._ids)
        known, lookup = self._known, self._known.__getitem__
        collecting = gc.isenabled()
        gc.disable()  # many short lists, no cycles: the collector would only search them
        try:
            cut = list(cut)
            found = [list(map(lookup, pieces)) for pieces in cut]
            new, known.new = known.new, []
            for piece, encoded in zip(new, self._library.encode_batch_fast(new, add_special_tokens=False)):
                known[piece] = array("I", encoded.ids).tobytes()
            for pieces, ids in zip(cut, found):
                at = -1
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    ids[at] = known[pieces[at]]
            for piece in new:
                if len(piece) > LONGEST:
                    del known[piece]
            return found
        finally:
            if collecting:
                gc.enable()

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        return list(map(b"".join, self.encode(map(self.cut, texts))))


class _Memory(dict):
    """Ids by piece; a piece that isn't known is noted and its ids are None."""

    def __init__(self, known: dict[str, bytes]) -> None:
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> None:
        self[piece] = None
        self.new.append(piece)
