"""Small tables with every awkward row the operators must define."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "alpha beta gamma delta " * 40_000


def prose(seed: int, words: int, alphabet: str = "etaoin shrdlu") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet.replace(" ", "")) for _ in range(r.randint(2, 9))) for _ in range(words))


def rows(count: int = 40) -> list[tuple]:
    """Plain documents, then nulls in every column, empty, blank and long
    texts, exact and near copies, and repeated rows."""
    out = []
    for i in range(count):
        lang = ("en", "fr")[i % 2]
        text = prose(i, 5 + 7 * (i % 11), "abcdefgh" if lang == "en" else "ijklmnop")
        out.append((i, text, lang, f"s{i % 4}", len(text)))
    near = prose(1000, 200)
    out += [
        (100, None, "en", "s0", None),
        (101, "", "en", "s1", 0),
        (102, " \t\n\x0b\f\r ", None, "s1", 7),
        (103, "123 456 !!!", "en", None, 11),
        (104, LONG, "en", "s2", len(LONG)),
        (105, near, "en", "s0", None),
        (106, near + " one", "en", "s0", None),
        (107, near + " two", None, "s0", None),
        (108, near.upper(), "en", None, None),
        (109, out[3][1], "fr", "s3", 1),
        (110, "a", "en", "s0", 1),
        (110, "a", "en", "s0", 1),
        (None, "no id here at all", "en", "s0", 3),
        (None, None, None, None, None),
    ]
    return out


def docs(spark, items=None):
    return spark.createDataFrame(rows() if items is None else items, DOCS)


def clashing(df):
    """The same table with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["score", "lang_pred", "secrets", "rank", "size", "target", "n_words", "spans", "n_tokens", "n_bytes", "length"]
    return df.withColumns({n: F.lit("own") for n in names})
