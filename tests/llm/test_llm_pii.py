import hashlib
import random
import re
import time

import numpy as np
from llm_samples import clashing, docs, rows
from pyspark.sql import functions as F

from matchday.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


PIECES = [
    "ann.lee+x@mail.example.com", "a@b", "a@b.c", "x@y.z_w@q.r", "@", "..@a-b.c-d.e", "1.2.3.4", "256.1.1.1", "001.02.3.255",
    "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500000000000004", "12", "+1 (743) 555-3824",
    "+44 20 7946 0958", "+1", "+123", "+12 (", "é", "日本", "𝒳", " ", "\n", "-", ".", "+", "word", "00", "\t", "x1.2.3.4y",
    "+49.30.1234567..", "9.9.9.9@h.io", "퟿", "%", "(555) 123-4567",
]


def spans(df, **more):
    return {r["doc_id"]: [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["pii"]] for r in pii.find(df, **more).collect()}


def test_base_spans_equal_brute_force(spark):
    r = random.Random(4)
    items = [(i, "".join(r.choice(PIECES) + r.choice(["", "", " "]) for _ in range(r.randint(0, 40))), "en", "s", 1) for i in range(400)]
    got = spans(docs(spark, items))
    for i, text, *_ in items:
        assert [s for s in got[i] if s[1] < 4] == base(text), text


def test_report_digests(spark):
    items = [*rows(), *((500 + i, t, "en", "s", 1) for i, t in enumerate(["a@b.cc 1.2.3.4", "+1 (743) 555-3824 4111 1111 1111 1111", "", None]))]
    want = {}
    for doc, text, *_ in items:
        found = base(text)
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in found)
        want[doc, text] = (*(sum(k == j for _, k, _ in found) for j in range(4)), hashlib.sha256(listed.encode()).hexdigest())
    got = pii.report(clashing(docs(spark, items))).collect()
    assert len(got) == len(items)
    by_id = {}
    for (doc, _), value in want.items():
        by_id.setdefault(doc, set()).add(value)
    for r in got:
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) in by_id[r["doc_id"]]
    assert pii.report(docs(spark, [])).collect() == []


FIRST = ["Anna", "Peter", "Sarah", "Thomas", "Laura", "Pierre", "Klaus", "Carlos", "Maria", "David"]
LAST = ["Miller", "Schmidt", "Garnier", "Lopes", "Harrow", "Quist", "Venter", "Odell"]
PLACES = ["Green Meadow", "Silver Lake", "Old Bridge", "Northern Crown", "Crystal Harbor"]


def planted(seed, n):
    """Documents with private passages, with look-alikes, and with neither; the
    private strings of each."""
    r = random.Random(seed)
    fill = lambda: " ".join("".join(r.choice("aeinorst") for _ in range(r.randint(3, 8))) for _ in range(r.randint(4, 12)))
    out = []
    for i in range(n):
        first, last = r.choice(FIRST), r.choice(LAST)
        tel = f"({r.randint(200, 999)}) {r.randint(200, 999)}-{r.randint(1000, 9999)}"
        ssn = f"{r.randint(100, 600)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}"
        born = f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1940, 2005)}"
        private = [
            (f"my name is {first} {last}", f"{first} {last}"), (f"write to Dr. {first} {last}", f"Dr. {first} {last}"),
            (f"call {tel}", tel), (f"ssn {ssn}", ssn), (f"born {born}", born),
            (f"lives at {r.randint(1, 99)} {last} Street", None), (f"mail {first.lower()} at {last.lower()} dot com", None),
        ]
        plain = [
            (f"in {r.choice(PLACES)} there", None), (f"version {r.randint(10, 99)}.{r.randint(10, 99)}.{r.randint(100, 999)}", None),
            (f"isbn {r.randint(100, 999)}-{r.randint(10, 99)}-{r.randint(1000, 9999)}", None), (f"page {r.randint(1, 99)} of it", None),
            (f"the price {r.randint(100, 999)}.{r.randint(100, 999)}.{r.randint(10, 99)} €", None), ("The General Public License", None),
        ]
        kind = r.random()
        phrase, secret = r.choice(private) if kind < 0.4 else r.choice(plain)
        if kind < 0.4 and secret is None:
            secret = phrase.split(" ", 2 if phrase.startswith("lives") else 1)[-1]
        out.append((i, f"{fill()} {phrase}, {fill()}.", secret))
    return out


def test_classifier_on_held_out_documents(spark):
    """EM sees no labels; fitted to one half, it is judged on the other."""
    learn, judge = planted(1, 600), planted(2, 600)
    model = pii.fit(pii.proposals(docs(spark, [(i, t, None, None, None) for i, t, _ in learn])))
    got = spans(docs(spark, [(i, t, None, None, None) for i, t, _ in judge]), model=model)
    hit = miss = wrong = 0
    for i, text, secret in judge:
        found = [text[s:e] for s, _, e in got[i]]
        if secret is None:
            wrong += bool(found)
        else:
            hit += any(secret in f or f in secret for f in found)
            miss += not found
    private = sum(s is not None for _, _, s in judge)
    assert hit >= 0.9 * private and wrong <= 0.05 * (len(judge) - private), (hit, private, wrong)
    form = model.accuracy["form"]
    assert form[1][1] > form[1][0], "a form that matches is commoner among private spans"


def test_reliability_decides(spark):
    """A cue that stands before everything stops counting: EM lowers it."""
    few = [(i, t, None, None, None) for i, t, _ in planted(3, 300)]
    noisy = few + [(1000 + i, f"name Green Meadow {i}. called Silver Lake. phone page Old Bridge", None, None, None) for i in range(400)]
    fitted = [pii.fit(pii.proposals(docs(spark, x))) for x in (few, noisy)]
    ratio = [m.accuracy["cue"][1][1] / m.accuracy["cue"][1][0] for m in fitted]
    assert ratio[1] < ratio[0]


def test_expectation_maximisation_finds_known_reliabilities():
    r = np.random.default_rng(5)
    n, right = 4000, [0.95, 0.9, 0.85, 0.8, 0.75, 0.7]
    y = r.random(n) < 0.4
    votes = np.stack([np.where(r.random(n) < a, np.where(y, 1, -1), np.where(y, -1, 1)) for a in right], 1)
    kinds = np.full(n, 5)
    post, table = pii._expectation_maximisation(kinds, votes, np.ones(n), pii.LEAST)
    assert ((post > 0.5) == y).mean() > 0.97
    for j, a in enumerate(right):
        assert abs(table[j][1][2] - a) < 0.05 and abs(table[j][0][0] - a) < 0.05


def test_find_keeps_every_other_column(spark):
    table = clashing(docs(spark)).withColumns({"pii": F.lit("gone"), "base": F.lit("own"), "_base": F.lit("own"), "_m_email": F.lit("own")})
    out = pii.find(table)
    assert sorted(out.columns) == sorted(table.columns)
    kept = [c for c in table.columns if c != "pii"]
    assert sorted(map(repr, out.select(kept).collect())) == sorted(map(repr, table.select(kept).collect()))


def test_very_long_texts(spark):
    """Linear in the text and its matches: a quadratic step takes minutes.
    Beside each unit: base spans of 300,000 code points of it."""
    units = {
        "a.b@c.de 1.2.3.4 ": 2 * 17647, "a": 0, "7": 0, "1 ": 0, "+1    ": 0, "a.": 0, "a@": 0, "1.1.1.": 37500, "Ab ": 0,
    }
    items = [(i, u * (300_000 // len(u)), None, None, None) for i, u in enumerate(units)]
    start = time.time()
    got = {r["doc_id"]: r for r in pii.report(docs(spark, items)).collect()}
    assert time.time() - start < 60
    for i, n in enumerate(units.values()):
        assert sum(got[i][f"n_{k}"] for k in pii.BASE) == n


def test_plan_is_native(spark):
    plan = pii.report(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
