from collections import Counter

import pytest
from pyspark.sql import functions as F
from llm_samples import clashing, docs, rows

import __spark_entry__ as entry
import corpus_pipeline
from matchday.llm import language, mixing, neardup, packing, secrets

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    table = clashing(docs(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SMALL).cache()
        assert out.columns == table.columns, name
        kept = Counter(r["doc_id"] for r in out.collect())
        if name == "language_id":
            assert not {100, 101, 102, 103} & set(kept) and kept[104] == 1 and kept[110] == 2
        if name == "near_dedup":
            assert max(kept.values()) == 1 and 105 in kept and not {106, 107, 108} & set(kept)
        if name == "secret_scan":
            assert kept == Counter(r["doc_id"] for r in table.collect())
        table = out
    assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).count() >= table.count()


def test_every_stage_takes_an_empty_table(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(spark, []), SMALL).collect() == [], name


def test_run_equals_the_stages_by_hand(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(table)
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    named = language.predict(table, model).filter("lang_pred <> 'und'")
    known = named.selectExpr("doc_id", "text", "coalesce(lang, lang_pred) AS lang", "source", "n_chars").collect()
    assert {r["doc_id"] for r in known} == {d for d, t in texts.items() if t and any(map(str.isalpha, t))}

    def shingles(text):
        words = text.encode().lower().split()
        n = min(5, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()

    sets = {r["doc_id"]: shingles(r["text"]) for r in known}
    group = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {d: new if g == old else g for d, g in group.items()}
    first = [r for r in known if group[r["doc_id"]] == r["doc_id"]]
    novelty = secrets._Novelty()

    def cut(text):
        out, at = "", 0
        for s, e, *_ in secrets.scan(text, novelty):
            out, at = (out + text[at:s] + "[REDACTED]" if s >= at else out), max(at, e)
        return out + text[at:]

    clean = spark.createDataFrame([(*r[:1], cut(r["text"]), *r[2:]) for r in first], table.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(clean).collect()}
    pieces = packing.pieces(clean, corpus_pipeline.TOKENIZER).collect()
    want = Counter({(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]): copies[r["doc_id"]] for r in pieces if copies[r["doc_id"]]})
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want


def test_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", [q for q in entry.oracle_sql() if q.startswith("op")])
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = lambda df: df[columns].sort_values(columns).reset_index(drop=True)
    assert order(got).astype(str).equals(order(want).astype(str))


def test_every_query_reads_whole_tables(spark):
    counts = {r: spark.read.parquet(f"{SMALL}/{r}.parquet").count() for r in ("documents",)}
    for name in ("op2_language_id", "op4_source_mix", "op6_license_scan", "op7_token_counts", "op8_minhash_neardup", "op10_secret_scan"):
        assert entry.queries()[name](spark, SMALL).count() == counts["documents"], name
    assert len(rows()) > 40
    assert neardup.Settings().percent == 80


@pytest.mark.parametrize("labels", [(None,), ("und",), ("und", "en", None)])
def test_language_stage_keeps_every_text_with_a_letter(spark, labels):
    table = docs(spark, [(d, text, labels[i % len(labels)], source, n) for i, (d, text, _, source, n) in enumerate(rows())])
    kept = corpus_pipeline.identify_language(spark, table, SMALL).collect()
    want = [r for r in table.collect() if r["text"] and any(map(str.isalpha, r["text"]))]
    assert kept and Counter(r["doc_id"] for r in kept) == Counter(r["doc_id"] for r in want)


def test_language_stage_gives_the_predicted_language(spark, monkeypatch):
    """Fails if the model is replaced by a constant."""
    items = [(d, text, None if d is not None and d % 3 == 0 else lang, source, n) for d, text, lang, source, n in rows()]
    table = docs(spark, items)
    known = {(d, t): lang for d, t, lang, *_ in rows()[:40]}
    out = {(r["doc_id"], r["text"]): r["lang"] for r in corpus_pipeline.identify_language(spark, table, SMALL).collect()}
    assert all(out[k] == lang for k, lang in known.items() if k in out)
    constant = lambda docs, model, **names: language_predict(docs, model, **names).withColumn(names["label"], F.lit("en"))
    language_predict = language.predict
    monkeypatch.setattr(language, "predict", constant)
    out = {(r["doc_id"], r["text"]): r["lang"] for r in corpus_pipeline.identify_language(spark, table, SMALL).collect()}
    assert any(out[k] != lang for k, lang in known.items() if k in out)


def test_stages_keep_columns_by_value(spark):
    names = ["secrets", "__new", "__key", "__id", "__copy", "_new", "_data", "_key", "_id", "_copy", "_label", "_score", "_lettered"]
    table = docs(spark).withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id"), F.lit(-1)), F.lit(" "), F.coalesce("source", F.lit("-"))) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SMALL)
        assert out.columns == table.columns
        for r in out.collect():
            own = f"{r['doc_id'] if r['doc_id'] is not None else -1} {r['source'] or '-'}"
            assert all(r[n] == f"{n} {own}" for n in names), name
