import random
import re

from llm_samples import clashing, docs, rows

from matchday.llm import licenses

PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    words = words_of(text)
    places = []
    for phrase, label in PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


def test_base_places_equal_brute_force(spark):
    r = random.Random(8)
    bits = "mit Apache license License general public the gnu under licensed version 2 0 foo é MIT, / - \x7f 文".split()
    texts = [" ".join(r.choice(bits) for _ in range(r.randint(0, 80))) for _ in range(300)] + [None, "", "mit-license"]
    table = docs(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    for row in licenses.report(clashing(table)).collect():
        n, places = brute(texts[row["doc_id"]])
        starts = [s for s, _ in places]
        assert (row["n_words"], row["n_base"]) == (n, len(places))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        base = sorted({x for _, x in places})
        assert row["base_labels"] == ",".join(base)
        assert set(base) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1


def test_matching_statistics_equal_brute_force():
    r = random.Random(3)
    for _ in range(100):
        sequences = [[r.randrange(3) for _ in range(r.randint(1, 9))] for _ in range(r.randint(1, 4))]
        text = [r.randrange(4) for _ in range(30)]
        automaton = licenses.Automaton(sequences)
        for end, (state, length) in enumerate(automaton.stream(text), 1):
            fits = lambda n: any(text[end - n : end] == s[i : i + n] for s in sequences for i in range(len(s) - n + 1))
            best = max(n for n in range(end + 1) if n == 0 or fits(n))
            assert length == best
            if length:
                places = {(k, i + length) for k, s in enumerate(sequences) for i in range(len(s) - length + 1) if s[i : i + length] == text[end - length : end]}
                assert places == automaton.ends[state]


def test_templates_are_found_with_small_changes():
    scanner = licenses.Scanner()
    found = lambda text: {s["label"] for s in scanner.scan(scanner.words(text.encode()))[1]}
    assert found("Foo bar. Licensed under CC BY-NC 4.0. Baz") == {"cc-by-nc"}
    bsd = "Redistribution and use in source and binary forms, with or without any modification, are permitted provided that the following conditions are met:"
    assert found(bsd) == {"bsd"}
    assert found("the use of this software in the source of the work is permitted") == set()


def test_long_texts_are_cut_between_words(monkeypatch):
    scanner = licenses.Scanner()
    text = ("xx mit license yy " * 200).encode()
    whole = scanner.words(text)
    monkeypatch.setattr(licenses, "PART", 16)
    assert (scanner.words(text) == whole).all()


def test_clean_documents_have_no_label(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = licenses.report(table).join(table.select("doc_id", "text"), "doc_id")
    assert found.filter("labels <> '' and not lower(text) rlike 'licen[sc]e'").count() == 0


def test_awkward_rows_and_empty_table(spark):
    assert licenses.report(docs(spark)).count() == len(rows())
    assert licenses.report(docs(spark, [])).collect() == []


def test_many_notices_in_one_text():
    from time import perf_counter

    scanner = licenses.Scanner()
    text = ("This project is licensed under the MIT License. Words between them stand here, and more. " * 100_000).encode()
    start = perf_counter()
    base, spans = scanner.scan(scanner.words(text))
    assert perf_counter() - start < 30
    assert len(base) == 100_000 and len(spans) >= 100_000 and {s["label"] for s in spans} == {"mit"}
