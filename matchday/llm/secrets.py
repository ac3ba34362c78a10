"""Secret scans: plain patterns, and novelty under a primed zstandard dictionary.

Three base patterns are matched in every whole text.  The method adds what no
pattern names: in a sensitive context (a word such as "key" or "auth" shortly
before), each token that could be a credential is a candidate, whatever its
length.  A secret carries the context on, and so does a candidate to what adjoins
it: all lines of a PEM block and all parts of a JWT are candidates.  zstandard is
primed with a dictionary of identifiers and the text around the candidate; the
bytes that the candidate adds to a compressed frame are its novelty.  Words
and identifiers that the dictionary or the surroundings explain cost few
bytes; a random string costs nearly its entropy and is reported, whatever its
alphabet.  The words of a tokenizer's vocabulary enlarge the dictionary: each one
in a candidate costs no more than its number.

Bytes decide first: a text that holds none of the literals that a pattern
needs, nor a run of 24 hex digits, is passed without running any pattern.
"""

from __future__ import annotations

import base64
import json
import math
import re
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import free_names
from matchday.llm.common import field, map_text

#: Kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "novel")

# The base patterns, ASCII letters only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words after which a token may be a credential.
CONTEXT = ("password", "passwd", "pwd", "passphrase", "secret", "token", "auth", "bearer", "credential")
#: Words that make a context with "key", written as one word or two.
KEYS = ("private", "access", "secret", "signing", "encryption", "api")
#: What may stand before a context word without a gap.
JOINED = ("access", "auth", "refresh", "session", "user", "db", "admin", "root", "api", "client", "app", "my", "id")
#: Whole words, plurals too, or parts of an identifier: not "author",
#: "tokenization" or "secretary".  A part begins with a capital after a small
#: letter, and ends before a capital unless it is in capitals itself.
_SENSITIVE = re.compile(
    rf"(?:(?<![A-Za-z])(?:(?i:{'|'.join(JOINED)}))?|(?<=[a-z])(?=[A-Z]))"
    rf"(?i:(?:{'|'.join(KEYS)})[ _-]?key|{'|'.join(w for w in CONTEXT if w != 'auth')}|auth(?:orization|entication|enticate|orize)?)"
    r"(?:[sS](?![A-Za-z]))?(?![a-z])(?!(?<=[A-Z])[A-Z])",
    re.ASCII,
)
_START = re.compile(r"[A-Za-z0-9+/_=-]{16}")
_REST = re.compile(r"[A-Za-z0-9+/_=-]*")
#: What may stand between a candidate and one that adjoins it (also line breaks
#: written as escapes), and the short last line of a PEM block.
_ADJOINING = re.compile(r"""(?:\\r|[\s.,"'\\|>#]){1,64}(?=[A-Za-z0-9+/_=-]{16})""")
_LAST_LINE = re.compile(r"""(?:\\[nr]|[\s"',\\|>#]){1,64}[A-Za-z0-9+/=]{1,15}(?=(?:\\[nr]|[\s"',\\|>#]){1,64}-----END )""")
#: Code points after a context word or a secret in which a candidate starts,
#: around a piece that prime the compressor, of a piece of a long candidate, and
#: of the shortest candidate.
REACH, AROUND, PIECE, SHORTEST = 64, 512, 512, 16
#: Least share of the bytes of a random string that are novel.
NOVELTY = 0.8

#: Identifiers that surround credentials in code; primes the compressor.
IDENTIFIERS = " ".join(
    """password passwd secret token api_key apikey api-key auth authorization bearer credential private_key
    access_key access_token refresh_token client_id client_secret username user_name host hostname port database
    connection string return function class public private static final const let var import from export default
    undefined null none true false self this config configuration settings environment environ getenv process
    request response header headers content type application json http https localhost server service account
    example placeholder changeme your_password your_token your_api_key insert_here xxxxxxxx 12345678 0123456789
    abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdef deadbeef session cookie signature
    encrypt decrypt hash sha256 md5 base64 encode decode key value name path file directory version""".split()
).encode()

_HEX_MAP = bytes(104 if chr(i) in "0123456789abcdef" else 46 for i in range(256))
_LITERALS, _KEYS = (tuple(w.encode() for w in words) for words in (CONTEXT, KEYS))


_LETTERS = re.compile(r"[A-Za-z]{0,32}\Z")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]+")
#: Alphabets smaller than base 64.
_ALPHABETS = tuple((size, re.compile(f"[{x}]+")) for size, x in ((10, "0-9"), (16, "0-9a-f"), (16, "0-9A-F"), (26, "a-z"), (26, "A-Z")))
#: Least letters of a known word that is a whole part of an identifier, or
#: stands in a part; bytes of a word's number in the vocabulary.
WHOLE, INSIDE, WORD_BYTES = 3, 5, 2
#: Least letters of an unknown word that its letters may explain, and the bits of
#: a letter below which they do (16 random letters take 4.6 to 6.5, words 3 to 4.4).
SPELLED, LIKELY = 6, 4.5
_RECORD = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[A-Za-z]{1,8}[-_]?[0-9]{4,}|[0-9]+(?:[-/_][0-9]+)+[Xx]?")
_CASED = re.compile("[A-Z]?[a-z]+|[A-Z]+")
_SHORT_PART = re.compile(r"[A-Za-z]{0,3}[0-9]{1,8}|[A-Za-z]{1,3}|[0-9]{1,8}[A-Za-z]{1,3}")


@cache
def _vocabulary() -> tuple[frozenset[str], int]:
    """The lower-case ASCII words of a tokenizer's vocabulary, and the length
    of the longest."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    words = (piece.lstrip("\u0120").lower() for piece in pieces)
    known = frozenset(w for w in words if len(w) >= WHOLE and w.isascii() and w.isalpha())
    return known, max(map(len, known))


@cache
def _letters() -> tuple[dict[str, int], dict[str, int], dict[str, int], int]:
    """Counts of letter runs of three, two and one (and their number) in the
    lower-case ASCII words of two vocabularies, one of many languages; ``^``
    stands before and after a word."""
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        pieces = (base64.b64decode(line.split()[0]).decode(errors="replace") for line in file)
        words = {p.strip().lower() for p in pieces}
    words = {w for w in words | _vocabulary()[0] if len(w) >= WHOLE and w.isascii() and w.isalpha()}
    counts: tuple[dict[str, int], ...] = ({}, {}, {})
    for word in words:
        padded = f"^^{word}^"
        for i in range(2, len(padded)):
            for n, held in zip((3, 2, 1), counts):
                run = padded[i + 1 - n : i + 1]
                held[run] = held.get(run, 0) + 1
    heads: dict[str, int] = {}
    for held in counts[:2]:
        for run, n in held.items():
            heads[run[:-1]] = heads.get(run[:-1], 0) + n
    return counts[0] | counts[1], counts[2], heads, sum(counts[2].values())


def letter_bits(word: str) -> float:
    """Bits of a word under a model of letters that is of no one language:
    a mixture of what follows the last two letters, the last one, and any."""
    runs, ones, heads, total = _letters()
    padded, bits = f"^^{word.lower()}", 0.0
    for i in range(2, len(padded)):
        two, one, letter = padded[i - 2 : i], padded[i - 1], padded[i]
        chance = 0.005 + 0.095 * ones.get(letter, 0) / total
        chance += 0.3 * runs.get(one + letter, 0) / max(1, heads.get(one, 0))
        chance += 0.6 * runs.get(two + letter, 0) / max(1, heads.get(two, 0))
        bits -= math.log2(chance)
    return bits


def _words(token: str) -> list[tuple[int, int, float]]:
    """Where the words in a token start and end, and what they cost in bytes:
    known ones their number, others that are spelled like words their letters."""
    known, longest = _vocabulary()
    out = []
    for m in _WORD.finditer(token):
        low, i = m[0].lower(), 0
        if len(low) >= WHOLE and low in known:
            out.append((*m.span(), WORD_BYTES))
            continue
        if len(low) >= SPELLED and (bits := letter_bits(low)) < LIKELY * len(low):
            out.append((*m.span(), bits / 8))
            continue
        while i + INSIDE <= len(low):
            size = next((n for n in range(min(longest, len(low) - i), INSIDE - 1, -1) if low[i : i + n] in known), 0)
            out += [(m.start() + i, m.start() + i + size, WORD_BYTES)] if size else []
            i += size or 1
    return out


def _is_word(part: str) -> bool:
    """Whether a part is a known word or spelled like one, in any language."""
    if not _CASED.fullmatch(part):
        return False
    return part.lower() in _vocabulary()[0] or (len(part) >= SPELLED and letter_bits(part) < LIKELY * len(part))


def _ordinary(token: str) -> bool:
    """Whether a token is a word, a number, a date, a record or UUID, or a path
    of words, short numbers and initials."""
    if _RECORD.fullmatch(token):
        return True
    parts = [p for p in re.split("[/_=+-]+", token) if p]
    return all(_is_word(p) or (len(parts) > 1 and _SHORT_PART.fullmatch(p)) for p in parts)


def _bits(token: str) -> float:
    """Bits of a character of a random string in the alphabet of a token."""
    return next((math.log2(size) for size, alphabet in _ALPHABETS if alphabet.fullmatch(token)), 6)


class _Novelty:
    """Marginal compressed bytes under the identifier dictionary."""

    def __init__(self) -> None:
        shared = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._size = lambda data: len(compressor.compress(data))
        compressor = zstandard.ZstdCompressor(level=9, dict_data=shared, write_content_size=False, write_checksum=False)

    def share(self, candidate: str, around: str) -> float:
        """Bytes that the candidate adds after its surroundings, over the
        bytes of a random base-64 string of its length (0 to about 1.5)."""
        context = around.encode()
        added = self._size(context + candidate.encode()) - self._size(context)
        return max(0.0, added / (0.75 * len(candidate)))

    def unexplained(self, candidate: str, before: str, after: str) -> float:
        """The share over the bytes of a random string in the candidate's own
        alphabet, where each word costs at most what ``_words`` says.  The
        first word may start before the candidate."""
        if _ordinary(candidate):
            return 0.0
        around, expected = before + after, _bits(candidate) / 8 * len(candidate)
        share = self.share(candidate, around) * 0.75 * len(candidate) / expected
        if share < NOVELTY:
            return share
        head = _LETTERS.search(before[-32:])[0]
        words = [(s - len(head), e - len(head), cost) for s, e, cost in _words(head + candidate) if e > len(head)]
        rest, at = "", 0
        for s, e, _ in words:
            rest, at = rest + candidate[at : max(s, 0)], e
        rest += candidate[at:]
        added = 0.75 * len(rest) * self.share(rest, around) if rest else 0
        return min(share, (added + sum(cost for *_, cost in words)) / expected) if words else share


def _may_hold(data: bytes) -> bool:
    """Whether a text can match anything."""
    if b"AKIA" in data or b"h" * 24 in data.translate(_HEX_MAP):
        return True
    low = data.lower()
    return any(word in low for word in _LITERALS) or (b"key" in low and any(word in low for word in _KEYS))


def _measure(text: str, starts: list[int], end: int, novelty: _Novelty) -> tuple[int, float] | None:
    """(start, share) of the secret in a candidate that ends at ``end``, if it
    holds one.  ``starts`` are its own start and the ends of the context words
    in it.  Long candidates are measured in pieces, and one novel piece makes
    the whole candidate, from the start before that piece, a secret."""
    for start, stop in zip(starts, [*starts[1:], end]):
        for a in range(start, min(stop, end - SHORTEST + 1), PIECE):
            b = a + PIECE if end - a - PIECE >= SHORTEST else end
            share = novelty.unexplained(text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND])
            if share >= NOVELTY:
                return start, share
    return None


def _novel(text: str, base: list[tuple[int, int]], novelty: _Novelty) -> Iterator[tuple[int, int, float]]:
    """(start, end, share) of the secrets that no base span covers.

    A candidate is as long as its characters go, except where a base span cuts
    it.  It is in context if it starts within REACH of a context word or of a
    secret in context, or adjoins another candidate in context.
    """
    words = [m.end() for m in _SENSITIVE.finditer(text)]
    word = cut = 0  # the next context word and base span
    at = limit = last = 0  # searched up to, context up to, end of the last candidate
    while True:
        start = -1
        if at < limit and (m := _START.search(text, at, min(len(text), limit + SHORTEST - 1))):
            start = m.start()
        elif last and (m := _ADJOINING.match(text, last)) and m.end() >= at:
            start = m.end()
        if start < 0:
            if word == len(words):
                return
            at, limit, word = max(at, words[word]), max(limit, words[word] + REACH), word + 1
            continue
        while cut < len(base) and base[cut][1] <= start:
            cut += 1
        if cut < len(base) and base[cut][0] <= start:  # a secret already
            at = last = base[cut][1]
            limit = max(limit, at + REACH)
            continue
        after = base[cut][0] if cut < len(base) else len(text)
        end = min(_REST.match(text, start).end(), after)
        starts = [start]
        while word < len(words) and words[word] <= end:
            limit = max(limit, words[word] + REACH)
            starts += [words[word]] if words[word] > start else []
            word += 1
        at = last = end
        if found := _measure(text, starts, end, novelty):
            limit = max(limit, end + REACH)
            line = _LAST_LINE.match(text, end)
            if line and line.end() <= after:
                at = last = end = line.end()
            yield found[0], end, found[1]


def scan(text: str, novelty: _Novelty) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, novelty share) of every span, by start, then kind."""
    base = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    spans = [(s, e, k, novelty.share(text[s:e], text[max(0, s - AROUND) : s])) for s, e, k in base]
    spans += [(s, e, "novel", share) for s, e, share in _novel(text, sorted((s, e) for s, e, _ in base), novelty)]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append ``secrets``, an array of (start, end, kind, novelty), to every row.

    Starts and ends count code points, the end exclusive.  Null and empty
    texts have no spans; repeated rows have the same spans each.  The base
    kinds are leftmost, not overlapping within a kind; a ``novel`` span never
    overlaps a base span.
    """

    def make():
        novelty = _Novelty()

        def compute(part: pa.RecordBatch) -> list:
            out = []
            for data in part.column("__data").to_pylist():
                if not data or not _may_hold(data):
                    out.append([])
                    continue
                found = scan(data.decode(), novelty)
                out.append([{"start": s, "end": e, "kind": k, "novelty": v} for s, e, k, v in found])
            return [out]

        return compute

    kind = "array<struct<start:bigint,end:bigint,kind:string,novelty:double>>"
    held = docs.withColumn("__data", F.col(text).cast("binary"))
    return map_text(held, [field("secrets", kind)], make, "__data", drop=["__data"])


def report(docs: DataFrame) -> DataFrame:
    """Counts, a digest of the base spans and the list of all spans.

    Output: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel.
    """
    found = find(docs.select("doc_id", "text")).drop("text")

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *(count(k) for k in KINDS[:3]),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
        count("novel"),
    )


def redact(docs: DataFrame, mark: str = "[REDACTED]", text: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``.

    Overlapping spans become one mark.  Texts without spans, null texts and
    all other columns stay, whatever their names; ``n_chars``, if there, is
    the new length of the texts that changed.  A text is cut once, in time in
    proportion to its length and spans; repeated rows are cut alike.
    """
    data, new = free_names(docs, "_data", "_new")

    def make():
        novelty = _Novelty()

        def compute(part: pa.RecordBatch) -> list:
            out = []
            for held in part.column(data).to_pylist():
                spans = scan(held.decode(), novelty) if held and _may_hold(held) else []
                out.append(_cut(held.decode(), spans, mark) if spans else None)
            return [out]

        return compute

    held = docs.withColumn(data, F.col(text).cast("binary"))
    found = map_text(held, [field(new, "string")], make, data, drop=[data])
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.coalesce(new, name).alias(name))
        elif name == "n_chars":
            length = F.length(new).cast(docs.schema[name].dataType)
            columns.append(F.when(F.col(new).isNotNull(), length).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return found.select(*columns)


def _cut(text: str, spans: list[tuple[int, int, str, float]], mark: str) -> str:
    """The text with a mark for each run of overlapping spans, which come by start."""
    out, at = [], 0
    for start, end, *_ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
