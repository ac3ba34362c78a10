import numpy as np
import pytest
from llm_samples import clashing, docs, rows

from matchday.llm import language


def brute(model, text):
    """Scores by plain loops over the same hashed grams."""
    total = model.priors.copy()
    for _, _, grams in language._grams([text], model.buckets):
        for order in grams:
            for bucket in order:
                total = total + model.weights[bucket]
    return total


def test_predictions_equal_plain_loops(spark):
    model = language.train(docs(spark))
    got = {r["doc_id"]: r for r in language.predict(docs(spark), model).collect() if r["doc_id"] is not None}
    for doc_id, text, *_ in rows():
        if doc_id is None or text is None or len(text) > 5000 or not any(map(str.isalpha, text)):
            continue
        scores = brute(model, text)
        assert got[doc_id]["lang_pred"] == model.languages[int(scores.argmax())]
        assert got[doc_id]["score"] == pytest.approx(1 / np.exp(scores - scores.max()).sum())


def test_counts_equal_plain_counts(spark):
    model = language.train(docs(spark), smoothing=1.0, buckets=1 << 10)
    counts = np.zeros((1 << 10, 2))
    for _, text, lang, *_ in rows():
        if text and lang and any(map(str.isalpha, text)):
            for _, _, grams in language._grams([text], 1 << 10):
                for b in grams.ravel():
                    if b < 1 << 10:
                        counts[b, model.languages.index(lang)] += 1
    assert np.allclose(model.weights[:-1], np.log((counts + 1) / (counts.sum(0) + (1 << 10))))


def test_pieces_of_long_texts_hold_every_gram_once(monkeypatch):
    text = "abcdefghij" * 50
    whole = np.sort(np.concatenate([g.ravel() for _, _, g in language._grams([text], 1 << 12)]))
    monkeypatch.setattr(language, "PIECE", 64)
    cut = np.sort(np.concatenate([g.ravel() for _, _, g in language._grams([text], 1 << 12)]))
    assert (whole[whole < 1 << 12] == cut[cut < 1 << 12]).all()


def test_awkward_rows(spark):
    found = language.identify(clashing(docs(spark))).collect()
    assert len(found) == len(rows())
    for r in found:
        if r["doc_id"] in (100, 101, 102, 103):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert 0 <= r["score"] <= 1 and r["held_out"] in (True, False)
    repeated = [tuple(r) for r in found if r["doc_id"] == 110]
    assert len(repeated) == 2 and repeated[0] == repeated[1]


def test_empty_and_unlabelled_tables(spark):
    assert language.identify(docs(spark, [])).collect() == []
    unlabelled = [(1, "some words", None, "s", 1)]
    assert [r["lang_pred"] for r in language.identify(docs(spark, unlabelled)).collect()] == ["und"]


def test_too_many_languages_is_an_error(spark):
    with pytest.raises(ValueError):
        language.train(docs(spark), max_languages=1)


def test_held_out_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(table).join(table.selectExpr("doc_id", "lang"), "doc_id").filter("held_out")
    right = found.filter("lang_pred = lang").count()
    assert right >= 0.97 * found.count()
