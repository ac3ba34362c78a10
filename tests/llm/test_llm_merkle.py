import hashlib
import zlib
from collections import Counter

import pytest
from llm_samples import clashing, docs, rows

from matchday.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc, text, lang, source, n = row
    return digest("".join(map(encoded, (doc, source, lang, n + more if n is not None else None, text))))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        other = at ^ 1
        yield at & 1, level[other] if other < len(level) else ""
        at >>= 1


def brute(items):
    groups = {}
    for row in items:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = Counter()
    for k, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, int(hit))
            for right, other in path:
                node = digest(other + node if right else node + other)
            proof = digest("".join(x for _, x in path))
            out[(row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0])] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in merkle.report(df).collect())


def many(n, langs):
    return [(i, f"text {i}", langs[i * i % len(langs)], None, i) for i in range(n)]


@pytest.mark.parametrize(
    "items",
    [
        rows(),
        rows()[:1],
        [(7, None, None, None, None)],
        [(None, None, None, None, None)] * 3,
        [(5, "same", "en", "s", 1)] * 600,
        many(700, ["a"]),
        many(600, ["a", "b", None, "", "é", "z"]),
        many(257, ["a", "a", "a", "b"]),
        [(i, "x", f"l{i:04}", "s", i) for i in range(300)],  # more groups than a segment holds
    ],
    ids=["sample", "one", "nulls", "repeated nulls", "repeated", "one group", "groups", "edge", "many groups"],
)
def test_equals_brute_force(spark, items):
    assert found(docs(spark, items)) == brute(items)


def test_empty_and_clashing(spark):
    empty = merkle.report(docs(spark, []))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"
    assert found(clashing(docs(spark))) == brute(rows())


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_partitions_do_not_matter(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert found(docs(spark, many(300, ["a", "b"]))) == brute(many(300, ["a", "b"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_segments_of_another_height(spark, monkeypatch):
    """Many steps of descent on few rows."""
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    items = many(150, ["a", "a", "a", "b", None])
    assert found(docs(spark, items)) == brute(items)


def test_long_text(spark):
    items = [(1, "long text " * 400_000, "en", "s", 4_000_000), (2, "", "en", None, 0)]
    assert found(docs(spark, items)) == brute(items)
