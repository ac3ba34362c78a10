import random

import numpy as np
import pytest
from llm_samples import clashing, docs, prose, rows
from pyspark.sql import functions as F

from matchday.llm import neardup
from matchday.llm.neardup import Settings


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(items, width, percent):
    sets = [shingles(t, width) for _, t, *_ in items]
    group = list(range(len(items)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, *_) in enumerate(items):
        r = root(i)
        lowest[r] = min((x for x in (lowest.get(r), doc_id) if x is not None), default=None)
    return [(d, len(s), lowest[root(i)], d == lowest[root(i)]) for i, ((d, *_), s) in enumerate(zip(items, sets))]


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(prose(seed * 997 + k, 1) if r.random() < share else w for k, w in enumerate(text.split()))


def key(row):
    return tuple((x is None, x or 0) for x in row)


def check(spark, items, settings):
    found = neardup.near_duplicates(docs(spark, items), settings)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()]
    assert sorted(got, key=key) == sorted(brute(items, settings.width, settings.percent), key=key)


@pytest.mark.parametrize("width", [2, 5])
def test_awkward_rows_equal_brute_force(spark, width):
    check(spark, rows(), Settings(width=width))


def test_group_of_near_copies_of_varied_distance_equals_brute_force(spark):
    base = prose(5, 150)
    items = [(i, edited(base, 0.002 * (i % 60), i), "en", "s", 0) for i in range(240)]
    random.Random(1).shuffle(items)
    check(spark, [(k, t, *rest) for k, (_, t, *rest) in enumerate(items)], Settings(width=2, block=16))


def test_chain_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    items = [(50 - k, " ".join(words[3 * k : 3 * k + 100]), "en", "s", 0) for k in range(40)]
    check(spark, items, Settings(width=2))


def test_empty_table(spark):
    assert neardup.near_duplicates(docs(spark, [])).collect() == []


def test_registers_merge_and_estimate():
    settings = Settings()
    r = np.random.default_rng(0)
    a = np.unique(r.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.concatenate([a[:900], r.integers(0, 1 << 63, 100).astype(np.uint64)])
    x, y = neardup.registers_of(a, settings), neardup.registers_of(b, settings)
    both = neardup.registers_of(np.unique(np.concatenate([a, b])), settings)
    assert (np.maximum(x, y) == both).all()
    ones = lambda n: np.array([float(n)])
    best, lost = neardup.similarity(ones((x > y).sum()), ones((x < y).sum()), ones((x == y).sum()), ones(1000), ones(1000), 80)
    assert abs(best[0] - 900 / 1100) < 0.12 and lost[0] < settings.slack
    far = neardup.registers_of(r.integers(0, 1 << 63, 1000).astype(np.uint64), settings)
    _, lost = neardup.similarity(ones((x > far).sum()), ones((x < far).sum()), ones((x == far).sum()), ones(1000), ones(1000), 80)
    assert lost[0] > settings.slack


def test_components_of_a_long_path(spark):
    order = list(range(300))
    random.Random(2).shuffle(order)
    name = lambda i: order[i].to_bytes(2, "big")
    links = spark.createDataFrame([(name(i), name(i + 1)) for i in range(299)], "u binary, v binary")
    found = neardup.components(links).distinct().collect()
    assert len(found) == 300 and {bytes(r["root"]) for r in found} == {(0).to_bytes(2, "big")}


def test_components_evaluate_their_links_once(spark):
    from pyspark.sql import functions as F

    # another random spanning tree at every evaluation, always of all 200 nodes
    node = lambda c: F.lpad(c.cast("string"), 4, "0").cast("binary")
    links = spark.range(1, 200).select(
        node(F.col("id")).alias("u"), node(F.floor(F.rand() * F.col("id"))).alias("v")
    )
    found = neardup.components(links).distinct().collect()
    assert len(found) == 200 and {bytes(r["root"]) for r in found} == {b"0000"}


def test_first_of_each_group_stays(spark):
    table = clashing(docs(spark))
    kept = neardup.first_of_each(table, Settings(width=5))
    assert kept.columns == table.columns
    ids = sorted((r["doc_id"] for r in kept.collect() if r["doc_id"] is not None))
    assert ids.count(110) == 1 and 105 in ids
    assert not {106, 107, 108, 109} & set(ids)
    assert {100, 101, 102} <= set(ids)  # empty sets are linked with nothing
    assert sum(r["doc_id"] is None for r in kept.collect()) == 2


def test_first_of_each_keeps_columns_by_value(spark):
    from pyspark.sql import functions as F

    scratch = ("__id", "__key", "__row", "_id", "_key", "_row", "root", "text_key", "component_id")
    table = docs(spark).withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id")) for n in scratch})
    out = neardup.first_of_each(table)
    assert out.columns == table.columns
    whole = {repr(r) for r in table.collect()}
    kept = out.collect()
    assert kept and all(repr(r) in whole for r in kept)


def test_first_of_each_tells_a_null_id_from_0(spark):
    items = [(None, "some words that stand here", "en", "s", 1), (0, "other words that are not like them", "en", "s", 2)]
    assert neardup.first_of_each(docs(spark, items)).count() == 2


def shared_words(n, seed=3, share=2 / 3, words=60):
    """Texts of which a share is the same in all and the rest their own."""
    r = random.Random(seed)
    same = [f"same{i}" for i in range(round(words * share))]
    return [(i, " ".join(same + [f"own{i}x{j}x{r.random()}" for j in range(words - len(same))]), "en", "s", 1) for i in range(n)]


def test_members_that_share_no_rare_shingle_are_not_compared(spark):
    items = shared_words(300)
    near = items[17][1].split()
    items += [(1000, " ".join(near[:-1] + ["else"]), "en", "s", 1)]  # linked with one of them, not with their centre
    table = docs(spark, items)
    settings = Settings(width=1, bands=40, rows=2)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(table, settings).collect()}
    assert got == {**{i: i for i in range(300)}, 1000: 17}
    nodes = spark.createDataFrame(
        [(bytes([i]), b"c", i == 0, list(range(40)) + [1000 * i + j for j in range(20)]) for i in range(100)],
        "node binary, centre binary, linked boolean, hashes array<long>",
    )
    assert neardup._rivals(nodes.drop("hashes"), nodes.select("node", "hashes"), Settings()).count() == 0


def test_rivals_hold_every_pair_that_reaches_the_threshold(spark):
    r = random.Random(6)
    base = [r.sample(range(400), 60) for _ in range(12)]
    sets = []
    for i in range(150):
        own = set(r.choice(base))
        for _ in range(r.randint(0, 9)):
            own.discard(r.choice(sorted(own)))
            own.add(r.randrange(400))
        sets.append((bytes([i]), b"c", i % 5 == 0, sorted(own)))
    df = spark.createDataFrame(sets, "node binary, centre binary, linked boolean, hashes array<long>")
    kept = {bytes(x["node"]) for x in neardup._rivals(df.drop("hashes"), df.select("node", "hashes"), Settings()).collect()}
    want = set()
    for i, (a, _, la, x) in enumerate(sets):
        for b, _, lb, y in sets[:i]:
            if not (la and lb) and 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y}):
                want |= {a, b}
    assert want and want <= kept


def test_only_wanted_texts_are_moved(spark):
    """The filter before the join keeps every wanted text and few others."""
    texts = spark.range(-3000, 3000).select("id", F.xxhash64("id").alias("key"), F.col("id").cast("string").alias("data"))
    wanted = texts.filter("id % 20 = 0").select(F.col("key").alias("text_key"))
    kept = neardup._only_wanted(texts, wanted)
    assert kept.columns == texts.columns
    ids = [r["id"] for r in kept.select("id").collect()]
    assert set(range(-3000, 3000, 20)) <= set(ids) and len(ids) == len(set(ids)) <= 310
    assert neardup._only_wanted(texts, wanted.limit(0)).count() == 0


def moved_rows(df):
    """Rows written by the exchanges of a query that has run, reused ones once."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(plan.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                total += plan.metrics().apply("shuffleRecordsWritten").value()
            todo += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


@pytest.fixture
def without_broadcasts(spark):
    switch = "spark.sql.adaptive.coalescePartitions.enabled"
    names = ("spark.sql.autoBroadcastJoinThreshold", switch, "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "-1")
    spark.conf.set(switch, "false")
    yield spark
    for n, value in zip(names, before):
        spark.conf.set(n, value)


def test_rivals_move_a_shingle_twice_whatever_the_partitions(without_broadcasts):
    """Lists made before an exchange came in as many pieces as there were partitions."""
    spark = without_broadcasts
    sets = [(bytes([i]), b"c", i == 0, list(range(40)) + [1000 * (i // 2) + j for j in range(100, 160)]) for i in range(60)]
    df = neardup.written(spark.createDataFrame(sets, "node binary, centre binary, linked boolean, hashes array<long>"), "given")
    moved = []
    for partitions in (2, 32):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rivals = neardup._rivals(df.drop("hashes"), df.select("node", "hashes"), Settings())
        assert len(rivals.collect()) == 60
        moved.append(moved_rows(rivals))
    shingles = sum(len(s[3]) for s in sets)
    assert moved[1] < 1.1 * moved[0]
    assert moved[0] < 3 * shingles


def test_rows_of_bands_are_moved_once(without_broadcasts):
    spark, settings = without_broadcasts, Settings()
    table = docs(spark, shared_words(60, share=0.9))
    classes = neardup.written(neardup.sketch(table, settings).select("node", "sketch"), "classes")
    stars = neardup._stars(classes, settings)
    found = {(r["u"], r["v"]): r["wide"] for r in stars.collect()}
    moved = moved_rows(stars)
    buckets = {}
    for r in neardup._bands(classes, settings).collect():
        buckets.setdefault(r["band"], []).append(r["id"])
    want = {}
    for ids in buckets.values():
        for u in ids:
            if u != min(ids):
                want[u, min(ids)] = want.get((u, min(ids)), False) or len(ids) > 2
    assert want and found == want
    pairs = sum(len(ids) - 1 for ids in buckets.values())
    assert moved <= 60 * settings.bands + pairs


def test_copies_under_other_ids_are_not_moved_for_their_set(without_broadcasts):
    spark = without_broadcasts
    items = [(i, "one text that many documents have", "en", "s", 1) for i in range(400)]
    table = docs(spark, items + items[:1])  # and one row is repeated
    classes = neardup.sketch(table, Settings()).filter("doc_id = 0").dropDuplicates(["node"])
    classes = neardup.written(classes.withColumnRenamed("doc_id", "first_doc"), "classes")
    sets = neardup._sets(table, classes, classes.select("node"), Settings())
    assert len(sets.collect()) == 1
    assert moved_rows(sets) < 20
