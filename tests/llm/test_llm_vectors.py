import numpy as np
import pytest
from pyspark.sql import functions as F

from matchday.llm import curves, topk

ROWS = "vec_id long, embedding array<float>, label int"


def vectors(count=400, size=16, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(count, size)) * r.uniform(0.2, 3, size=(count, 1))
    out = [(i, [float(np.float32(v)) for v in row], i % 7) for i, row in enumerate(x)]
    same = [1.0] * size
    out += [(1000 + i, same, 0) for i in range(60)]  # more copies than any answer holds
    out += [
        (2000, None, 1), (2010, [float("nan")] + [0.0] * (size - 1), 1), (2020, [float("inf")] * size, 1),
        (2030, [None] + [1.0] * (size - 1), 1), (2040, [0.0] * size, 1), (2050, [1.0, 2.0], 1), (2060, [], 1),
        (2070, out[0][1], None), (2070, out[0][1], None), (None, same, 1),
    ]
    return out


def usable(rows, zero):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v):
            if zero or any(v):
                out.setdefault(i, []).append(np.array(v, float))
    return out


def brute(found, every, k, repeat):
    """(query, [(id, score)...]) by the definition; ids once or as often as they occur."""
    out = {}
    for q, (own, *_) in found.items():
        if q % every:
            continue
        scores = [(-float(own @ v), i) for i, vs in found.items() if i != q for v in (vs if repeat else vs[:1])]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


@pytest.mark.parametrize("block", [4096, 50])
def test_top_k_equals_brute_force(spark, block):
    rows = vectors()
    table = spark.createDataFrame(rows, ROWS).withColumns({"rank": F.lit("own"), "score": F.lit(0)})
    found = got(topk.top_k(table, F.col("vec_id") % 5 == 0, 5, block=block, queries=32))
    whole = {i: [np.floor(256 * v) for v in vs] for i, vs in usable(rows, True).items()}
    want = brute(whole, 5, 5, True)
    assert {q: [(i, int(s)) for _, i, s in v] for q, v in found.items()} == {q: [(i, int(s)) for i, s in v] for q, v in want.items()}
    assert all([r for r, *_ in v] == list(range(1, len(v) + 1)) for v in found.values())


def test_top_k_with_large_components(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.integers(-(10**5), 10**5, 8)], 0) for i in range(60)]
    rows = [(i, [x * 30 for x in v], y) for i, v, y in rows]
    found = got(topk.top_k(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 5 == 0, 5))
    ints = {i: [int(np.float32(x)) * 256 for x in v] for i, v, _ in rows}
    for q, v in found.items():
        want = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
        assert [(-s, i) for _, i, s in v] == want


def test_bounds_pass_over_nothing_that_counts():
    r = np.random.default_rng(5)
    x = np.floor(r.normal(size=(3000, 20)) * 100 * np.exp(-np.arange(20) / 4))
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    ids, q = np.arange(3000), x[::100]
    rotation = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    a, v, s = topk._search(x, ids, q, ids[::100], np.full(len(q), -np.inf), rotation, 5, 4)
    for i in range(len(q)):
        want = sorted((-int(q[i] @ x[j]), j) for j in range(3000) if j != 100 * i)[:4]
        assert sorted(zip((-s[a == i]).tolist(), v[a == i].tolist())) == want


def test_curve_search_is_exact_where_the_window_holds_all(spark):
    rows = vectors()
    table = spark.createDataFrame(rows, ROWS).withColumns({"rank": F.lit("own"), "score": F.lit(0)})
    found = got(curves.nearest(table, F.col("vec_id") % 5 == 0, 20))
    want = brute(usable(rows, False), 5, 20, False)
    assert found.keys() == want.keys()
    for q, v in found.items():
        assert [i for _, i, _ in v] == [i for i, _ in want[q]]
        assert np.allclose([s for *_, s in v], [s for _, s in want[q]], rtol=1e-12)


def test_curve_search_recall_in_windows(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    settings = curves.Settings(share=0.2, least=64, rows=128)
    found = got(curves.nearest(table, F.col("vec_id") % 20 == 0, 20, settings=settings))
    data = table.select("vec_id", "embedding").collect()
    want = brute({r[0]: [np.array(r[1], float)] for r in data}, 20, 20, False)
    hits = sum(len({i for _, i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, v in found.items() for _, i, s in v if (q, i) in exact)


@pytest.mark.parametrize("spread", [0.0, 0.7])
def test_recall_under_the_registered_settings(spark, tmp_path, spread):
    """60,000 vectors, of one length and of lognormal lengths."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    r = np.random.default_rng(8)
    x = r.normal(size=(60_000, 64))
    x *= np.exp(spread * r.normal(size=(60_000, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    ids = np.arange(len(x))
    pq.write_table(pa.table({"vec_id": ids, "embedding": list(x)}), tmp_path / "x.parquet", row_group_size=8000)
    table = spark.read.parquet(str(tmp_path / "x.parquet"))
    found = got(curves.nearest(table, F.col("vec_id") % 250 == 0, 20))
    hits = 0
    for q, v in found.items():
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        hits += len({i for _, i, _ in v} & set(np.argsort(-score)[:20].tolist()))
    print("recall", spread, hits / (20 * len(found)))
    assert len(found) == 240 and hits >= 0.9 * 20 * len(found)


def test_queries_and_candidates_are_dealt_into_groups_of_bounded_size(spark):
    """Many small columns and parts give the same answers."""
    rows = vectors()
    table = spark.createDataFrame(rows, ROWS)
    small = curves.Settings(rows=16, queries=4)
    for settings in (small, curves.Settings(rows=16, queries=4, least=64, share=0.5)):
        found = got(curves.nearest(table, F.col("vec_id") % 5 == 0, 20, settings=settings))
        whole = curves.Settings(least=settings.least, share=settings.share)
        assert found == got(curves.nearest(table, F.col("vec_id") % 5 == 0, 20, settings=whole))


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = curves.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_empty_and_tiny_tables(spark):
    empty, one = spark.createDataFrame([], ROWS), spark.createDataFrame([(0, [1.0, 2.0], 1)], ROWS)
    for search in (lambda t: topk.top_k(t, F.col("vec_id") % 5 == 0, 5), lambda t: curves.nearest(t, F.col("vec_id") % 5 == 0, 5)):
        assert search(empty).collect() == [] and search(one).collect() == []
        two = one.union(spark.createDataFrame([(1, [1.0, 1.0], 1)], ROWS))
        assert [(r["query_id"], r["rank"], r["vec_id"]) for r in search(two).collect()] == [(0, 1, 1)]
        assert search(spark.createDataFrame([(0, None, 1)], ROWS)).collect() == []
