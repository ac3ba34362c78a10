r"""Personal data by weak supervision, in built-in functions alone.

Four base kinds are plain patterns with a check each.  Beyond them, a broad
pattern proposes candidates: names, national numbers, identity numbers, street
addresses, dates, spelled-out mail addresses.  Labelers vote on every candidate
and base span, for, against or not at all: its form (patterns), a gazetteer of
given names and street words, cues before it, counter-cues around it, its
plausibility and what adjoins it.

Votes are counted by pattern over all documents; expectation-maximisation on
the counts estimates how reliable each labeler is, without any label, and gives
every pattern a probability.  With these as soft labels a logistic span
classifier is fitted to votes, kind and length.  Its weights become literals
of an expression, and candidates that it accepts are added to the base spans.

Where a match lies follows from the lengths of the text between matches:
``split`` gives the gaps, ``regexp_extract_all`` the matches, and running sums
(by chunks, so linear but for a small term) their places.  Patterns are written so that
a run of any length is read once: possessive, and begun at a run's start or
where the last match ended.

What the driver sees is one count for each vote pattern (bounded by their
number, whatever the corpus).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions.columns import free_names
from matchday.llm.common import written

# The base kinds in the order in which spans with one start are
# listed, and their patterns.  ``++`` and the lookbehinds change no match: the
# classes before and after a possessive run exclude each other.
_RUN = r"(?:(?<![{0}])|\G)[{0}]++"
BASE = {
    "email": _RUN.format(r"A-Za-z0-9._%+-") + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("0-9") + r"(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Patterns of the candidate kinds.
_CAP = r"\p{Lu}\p{Ll}++"
_TITLE = r"(?:Mrs|Mr|Ms|Dr|Prof|Herr|Frau|Señora|Señor|Sra|Sr|Mme|Monsieur|Madame)\.?"
_WAY = r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Way)"
CANDIDATE = {
    "contact": r"(?<![A-Za-z0-9._-])[A-Za-z0-9][A-Za-z0-9._-]{0,63}+(?: ?\((?:at|AT)\) ?| ?\[(?:at|AT)\] ?| at )[A-Za-z0-9-]{1,63}+"
    r"(?:(?: ?\((?:dot|DOT)\) ?| ?\[(?:dot|DOT)\] ?| dot )[A-Za-z]{2,24}+){1,3}(?![A-Za-z0-9])",
    "street": rf"(?<![0-9\p{{L}}])[0-9]{{1,5}} (?:{_CAP} ){{1,3}}{_WAY}(?!\p{{L}})"
    r"|(?<!\p{L})\p{Lu}\p{Ll}{0,40}(?:straße|strasse|gasse|platz|weg) [0-9]{1,4}[a-z]?(?![0-9\p{L}])"
    rf"|(?<![0-9\p{{L}}])[0-9]{{1,4}},? (?:rue|avenue|boulevard|calle|plaza) (?:(?:de|du|des|la|del) ){{0,2}}{_CAP}(?!\p{{L}})",
    "birth": r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9./-][0-9]|[0-9])",
    "ident": r"(?<![0-9\p{L}-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|[A-Z]{1,2}[0-9]{6,9})(?![0-9\p{L}-])",
    "tel": r"(?<![0-9\p{L}+.,/-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ ./-][0-9]{2,4}(?:[ ./-][0-9]{2,4}){1,4}(?![0-9\p{L}])",
    "person": rf"(?<!\p{{L}}){_TITLE} {_CAP}(?:[ -]{_CAP}){{0,2}}(?!\p{{L}})|(?<!\p{{L}}){_CAP}(?:[ -]{_CAP}){{1,3}}(?!\p{{L}})",
}
#: All of them as one pattern; base kinds take what is theirs, first or, where
#: a candidate may begin with digits, last.  Runs begin at their start alone
#: here: after each match of another kind, the rest of a long run would be
#: read again.
PROPOSED = "|".join([BASE["email"], BASE["phone"], BASE["ip"], *CANDIDATE.values(), BASE["card"]]).replace(r"|\G)", ")")
KINDS = (*BASE, *CANDIDATE)

# Common given names; words that begin names and sentences of
# other things; words before and around spans.
NAMES = """James John Robert Michael William David Richard Joseph Thomas Charles Mary Patricia Jennifer Linda Elizabeth
    Barbara Susan Jessica Sarah Karen Emma Olivia Sophia Anna Laura Maria Peter Paul Daniel Mark George Andrew Alice Helen
    Jean Pierre Michel Philippe Nicolas Marie Sophie Claire Camille Isabelle Hans Klaus Jürgen Wolfgang Stefan Andreas
    Ursula Petra Sabine Monika Heike Carlos José Juan Luis Antonio Manuel Francisco Javier Miguel Carmen Ana Isabel Lucía
    Elena Pilar Giovanni Marco Luca Giulia Ahmed Mohammed Fatima Aisha Wei Ming Yuki Hiroshi Priya Raj Ivan Olga""".split()
OTHERS = """The And Of In On At To From With For This That These Those When Where What Which While If But Or As By Our Your
    Their His Her It We You They General Public License Apache Free Software New North South East West United States
    University Company Corporation Institute Department Journal Press Street Monday Tuesday Wednesday Thursday Friday
    Saturday Sunday January February March April May June July August September October November December Le La Les Der
    Die Das Und El Los Las Una Un Une Des Du De""".split()
CUES = """name named called contact attn dear regards sincerely signed phone telephone tel call mobile fax cell born birth
    dob ssn passport iban account identity resident lives living address mail reach nombre llamo teléfono correo nacido
    nacida nom appelle téléphone né née adresse wohnt heißt geboren telefon anschrift""".split()
COUNTER = """version isbn issn doi page pages figure fig chapter section table equation total price order item part model
    release build port score line lines volume vol number no nr rfc iso sku""".split()

#: Code points kept before and after a span for the labelers.
BEFORE, AFTER = 48, 24
#: Labelers, in the order of their votes, and what EM starts from: how often
#: each votes -1, 0 and 1 on other spans, and on private ones.  Cues only ever
#: vote for a span, counter-cues and what adjoins it only against it.
LABELERS = {
    "form": ((0.30, 0.60, 0.10), (0.03, 0.40, 0.57)),
    "gazetteer": ((0.40, 0.55, 0.05), (0.05, 0.55, 0.40)),
    "cue": ((0.01, 0.90, 0.09), (0.01, 0.49, 0.50)),
    "counter": ((0.39, 0.60, 0.01), (0.02, 0.97, 0.01)),
    "plausible": ((0.40, 0.40, 0.20), (0.03, 0.20, 0.77)),
    "adjoining": ((0.39, 0.60, 0.01), (0.02, 0.97, 0.01)),
}
#: Least probability of an accepted candidate; rounds of EM; and what its start
#: counts for: a share of all spans, so that it weighs alike at every size, and
#: some spans at least.
ACCEPTED, ROUNDS, SHARE, LEAST = 0.5, 60, 0.5, 20.0
#: Values of running sums in a chunk.
_CHUNK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often a lambda in
    ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _inclusive_sums(lengths: Column) -> Column:
    """Running sums of an array of lengths, by chunks: sums of chunks give
    each chunk's start."""
    zero = F.lit(0).cast("long")

    def grown(acc: Column, x: Column) -> Column:
        return F.array_append(acc, F.element_at(acc, -1) + x)

    def cut(all_: Column) -> Column:
        last = F.greatest(F.ceil(F.size(all_) / _CHUNK).cast("int"), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_, b * _CHUNK + 1, F.lit(_CHUNK)))

    def summed(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
        starts = F.slice(F.aggregate(sums, F.array(zero), grown), F.lit(1), F.size(chunks))
        inside = F.zip_with(chunks, starts, lambda c, s: F.slice(F.aggregate(c, F.array(s), grown), F.lit(2), F.size(c)))
        return F.flatten(inside)

    return _let(lengths, lambda all_: _let(cut(all_), summed))


def _matched(docs: DataFrame, text: str, patterns: dict[str, str]) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Append (matches, gaps) of every pattern; gaps are null without matches."""
    names = free_names(docs, *(f"_{part}_{k}" for k in patterns for part in ("m", "g")))
    places = {k: (names[2 * i], names[2 * i + 1]) for i, k in enumerate(patterns)}
    whole = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumns({places[k][0]: F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    return docs.withColumns({
        places[k][1]: F.when(F.size(places[k][0]) > 0, F.split(whole, p, -1)) for k, p in patterns.items()
    }), places


def _spans(matches: str, gaps: str, context: bool) -> Column:
    """Array of (start, end, match), with ``before`` and ``after`` if wanted."""
    m, g = F.col(matches), F.col(gaps)
    sizes = F.transform(m, lambda x: F.length(x).cast("long"))
    steps = F.zip_with(F.transform(g, lambda x: F.length(x).cast("long")), F.concat(F.array(F.lit(0).cast("long")), sizes), lambda a, b: a + b)
    starts = F.slice(_inclusive_sums(steps), F.lit(1), F.size(m))

    def span(x: Column, s: Column) -> Column:
        return F.struct(s.alias("start"), (s + F.length(x)).alias("end"), x.alias("match"))

    found = F.zip_with(m, starts, span)
    if context:
        around = F.zip_with(
            F.slice(g, F.lit(1), F.size(m)), F.slice(g, F.lit(2), F.size(m)),
            lambda a, b: F.struct(F.substring(a, -BEFORE, BEFORE).alias("before"), F.substring(b, 1, AFTER).alias("after")),
        )
        found = F.zip_with(found, around, lambda x, y: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), y["before"].alias("before"), y["after"].alias("after"),
            _digits(x["match"]).alias("digits"),
        ))
    return found


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, F.lit("[^0-9]"), F.lit(""))


def _luhn(digits: Column) -> Column:
    """Whether a string of a few digits passes the Luhn check."""

    def total(back: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            d = F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2)
            return acc + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)

    return _let(F.reverse(digits), total) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern passes the check of its kind."""
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    n = F.length(_digits(match))
    if kind == "phone":
        return n.between(10, 15)
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(match))).otherwise(F.lit(False))
    return F.lit(True)


def _checked(spans: str, kind: str) -> Column:
    """The spans of a base kind that pass its check: (start, kind, end)."""
    passed = F.filter(F.col(spans), lambda s: valid(kind, s["match"]))
    number = KINDS.index(kind)
    return F.transform(passed, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))


def _any_word(words: Sequence[str]) -> str:
    return "|".join(words)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, -1 against, 0 no vote."""
    out = F.when(yes, F.lit(1))
    return (out.when(no, F.lit(-1)) if no is not None else out).otherwise(F.lit(0))


def _kind(match: Column) -> Column:
    """Number in KINDS of the first kind whose whole pattern a proposal has."""
    out = F.when(match.contains("@"), F.lit(0)).when(match.startswith("+"), F.lit(3))
    out = out.when(match.rlike(rf"^{BASE['ip']}$"), F.lit(1))
    for k in CANDIDATE:
        out = out.when(match.rlike(f"^(?:{CANDIDATE[k]})$"), F.lit(KINDS.index(k)))
    return out.otherwise(F.lit(2))


def _votes(kind: Column, s: Column) -> list[Column]:
    """The labelers' votes on a span (match, before, after, digits)."""
    match, before, after, digits = s["match"], s["before"], s["after"], s["digits"]
    is_ = lambda *names: kind.isin([KINDS.index(n) for n in names])
    base_ok = F.when(is_("ip"), valid("ip", match)).when(is_("card"), valid("card", match)).when(
        is_("phone"), valid("phone", match)
    ).otherwise(is_("email"))
    strict = (
        (is_("ident") & match.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$|^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,}"))
        | (is_("tel") & match.rlike(r"^(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}$|^0[1-9][0-9]?(?:[ .-]?[0-9]{2}){4}$|^\(?0[0-9]{2,4}\)?[ /-][0-9]{3,4}[ -]?[0-9]{2,5}$"))
        | is_("street", "contact")
        | (is_("person") & match.rlike(f"^{_TITLE} "))
    )
    lax = is_("card") | (is_("tel") & match.rlike(r"[.][0-9]+[.]|^(?:19|20)[0-9]{2}[ ./-]"))
    form = _vote(base_ok | strict, lax)
    first = rf"^(?:{_TITLE} )?(?:{_any_word(NAMES)})(?![\p{{L}}])"
    other = rf"(?:^|[ -])(?:{_any_word(OTHERS)})(?![\p{{L}}])"
    gazetteer = _vote(
        (is_("person") & match.rlike(first) & ~match.rlike(other)) | is_("street"), is_("person") & match.rlike(other)
    )
    cue = _vote(before.rlike(rf"(?i)(?<!\p{{L}})(?:{_any_word(CUES)})(?!\p{{L}})[^.!?\n]{{0,16}}$"))
    counter = _vote(
        F.lit(False),
        before.rlike(rf"(?i)(?<!\p{{L}})(?:{_any_word(COUNTER)})\W{{0,3}}$") | before.rlike(r"[$€£#=]\s?$") | after.rlike(r"^\s?(?:[%€$°]|(?:km|kg|mm|cm|GB|MB|px|ms)(?!\p{L}))"),
    )
    plain = F.length(digits) == 0
    same = digits.rlike(r"^([0-9])\1*$")
    plausible = _vote(
        (is_("tel", "phone") & F.length(digits).between(9, 15) & ~same) | (is_("birth") & match.rlike(r"(?:19[2-9]|200)[0-9]"))
        | is_("email"),  # what has a form of its own is not judged by it twice
        (~plain & same) | (is_("tel") & ~F.length(digits).between(9, 15)) | (is_("person") & match.rlike(r"^(?:\p{Lu}\p{Ll}[ -]|.* \p{Lu}\p{Ll}$)")),
    )
    adjoining = _vote(F.lit(False), before.rlike(r"[\p{L}0-9_/\\=&]$") | after.rlike(r"^[\p{L}0-9_/\\=&]"))
    return [form, gazetteer, cue, counter, plausible, adjoining]


def _size_class(match: Column) -> Column:
    """0 to 2: up to 11, 18 and more code points."""
    n = F.length(match)
    return F.when(n <= 11, F.lit(0)).when(n <= 18, F.lit(1)).otherwise(F.lit(2))


def proposals(docs: DataFrame, text: str = "text", base: str = "base", proposed: str = "proposed") -> DataFrame:
    """Append ``base``, the checked base spans by start, then kind (start,
    kind: its number in KINDS, end), and ``proposed``, spans of all kinds with
    what they are judged by (start, kind, end, votes, size)."""
    found, places = _matched(docs, text, {**BASE, "any": PROPOSED})
    scratch = free_names(found, *(f"_s_{k}" for k in places))
    found = found.withColumns({n: _spans(*places[k], context=k == "any") for n, k in zip(scratch, places)})
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    parts = []
    for name, k in zip(scratch, BASE):
        parts.append(F.coalesce(_checked(name, k), empty))
    kinded = F.transform(F.col(scratch[-1]), lambda s: F.struct(s.alias("s"), _kind(s["match"]).alias("kind")))
    judged = F.transform(kinded, lambda x: F.struct(
        x["s"]["start"].alias("start"), x["kind"].alias("kind"), x["s"]["end"].alias("end"),
        F.array(*_votes(x["kind"], x["s"])).alias("votes"), _size_class(x["s"]["match"]).alias("size"),
    ))
    own = F.coalesce(judged, F.array().cast("array<struct<start:bigint,kind:int,end:bigint,votes:array<int>,size:int>>"))
    kept = [F.col(c) for c in docs.columns if c.lower() not in (base.lower(), proposed.lower())]
    return found.select(*kept, F.array_sort(F.concat(*parts)).alias(base), own.alias(proposed))


@dataclass(frozen=True)
class Model:
    """``accuracy``: P(vote | private or not) of each labeler, from EM, and
    the weights of the span classifier."""

    accuracy: dict[str, dict[int, tuple[float, float]]]
    bias: float
    votes: dict[tuple[int, int], float]
    kinds: dict[int, float]
    sizes: dict[int, float]


def _expectation_maximisation(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of every pattern, P(vote | class) of every labeler).

    ``weight``: spans that what EM starts from counts for.  It keeps the
    classes from changing places on few or one-sided data.
    """
    start = np.array(list(LABELERS.values()))
    table = start.copy()
    prior = np.full(len(KINDS), 0.3)
    post = np.zeros(len(n))
    for _ in range(ROUNDS):
        log = np.stack([np.log(1 - prior[kind]), np.log(prior[kind])])
        for j in range(votes.shape[1]):
            log = log + np.log(table[j][:, votes[:, j] + 1])
        post = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        for j in range(votes.shape[1]):
            for y, share in enumerate((n * (1 - post), n * post)):
                counts = weight * start[j][y] + np.bincount(votes[:, j] + 1, share, 3)
                table[j][y] = counts / counts.sum()
        for k in range(len(KINDS)):
            own = kind == k
            prior[k] = (0.3 * LEAST + (n * post)[own].sum()) / (LEAST + n[own].sum())
    return post, table


def _features(kind: np.ndarray, votes: np.ndarray, size: np.ndarray) -> np.ndarray:
    parts = [np.ones((len(kind), 1))]
    parts += [(votes[:, [j]] == v).astype(float) for j in range(votes.shape[1]) for v in (-1, 1)]
    parts += [(kind[:, None] == np.arange(len(KINDS))).astype(float), (size[:, None] == np.arange(3)).astype(float)]
    return np.hstack(parts)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights that fit soft labels, by Newton steps with a ridge."""
    w, scale = np.zeros(x.shape[1]), n / max(n.sum(), 1.0) * min(n.sum(), 1e6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (y - p)) - ridge * w
        bend = (x * (scale * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(found: DataFrame, proposed: str = "proposed") -> Model:
    """Estimate labelers and train the span classifier on all proposals.

    ``found`` comes from ``proposals``.  Without any proposal the classifier
    rests on the pseudo-counts alone, which every pattern has one count of.
    """
    span = F.explode(F.col(proposed)).alias("s")
    counted = found.select(span).groupBy("s.kind", "s.votes", "s.size").count().collect()  # one row a pattern
    counted = sorted((r["kind"], tuple(r["votes"]), r["size"], r["count"]) for r in counted)
    kind = np.array([r[0] for r in counted], int)
    votes = np.array([r[1] for r in counted], int).reshape(len(counted), len(LABELERS))
    size = np.array([r[2] for r in counted], int)
    n = np.array([r[3] for r in counted], float)
    post, table = _expectation_maximisation(kind, votes, n, max(LEAST, SHARE * n.sum()))
    # one made-up span of every labeler's clear votes, so that no weight is unseen
    clear = np.array([[v if j == i else 0 for j in range(len(LABELERS))] for i in range(len(LABELERS)) for v in (-1, 1)])
    lone = 1 / (1 + np.prod([table[j][0][clear[:, j] + 1] / table[j][1][clear[:, j] + 1] for j in range(len(LABELERS))], axis=0) * 7 / 3)
    x = _features(np.concatenate([kind, np.full(len(clear), -1)]), np.vstack([votes, clear]), np.concatenate([size, np.full(len(clear), -1)]))
    w = _logistic(x, np.concatenate([post, lone]), np.concatenate([n, np.ones(len(clear))]))
    at = 1 + 2 * len(LABELERS)
    return Model(
        {name: {v: (float(table[j][0][v + 1]), float(table[j][1][v + 1])) for v in (-1, 0, 1)} for j, name in enumerate(LABELERS)},
        float(w[0]),
        {(j, v): float(w[1 + 2 * j + (v > 0)]) for j in range(len(LABELERS)) for v in (-1, 1)},
        {k: float(w[at + k]) for k in range(len(KINDS))},
        {k: float(w[at + len(KINDS) + k]) for k in range(3)},
    )


def _probability(s: Column, model: Model) -> Column:
    """The classifier's probability that a span is private."""
    z = F.lit(model.bias) + F.element_at(F.array(*map(F.lit, model.kinds.values())), s["kind"] + 1)
    z = z + F.element_at(F.array(*map(F.lit, model.sizes.values())), s["size"] + 1)
    for (j, v), weight in model.votes.items():
        z = z + F.when(s["votes"][j] == v, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def classify(found: DataFrame, model: Model, into: str = "pii", base: str = "base", proposed: str = "proposed") -> DataFrame:
    """Replace ``base`` and ``proposed`` by ``into``, an array of (start, kind
    name, end, probability): the base spans, which always stay, at 1, and the
    proposals of other kinds that the classifier accepts, by start, then kind."""
    scored = F.transform(F.filter(F.col(proposed), lambda s: s["kind"] >= len(BASE)), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("number"), s["end"].alias("end"), _probability(s, model).alias("probability")
    ))
    sure = F.transform(F.col(base), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("number"), s["end"].alias("end"), F.lit(1.0).alias("probability")
    ))
    both = F.array_sort(F.concat(sure, F.filter(scored, lambda s: s["probability"] >= ACCEPTED)))
    names = F.array(*map(F.lit, KINDS))
    named = F.transform(both, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(names, s["number"] + 1).alias("kind"), s["end"].alias("end"), s["probability"].alias("probability")
    ))
    kept = [F.col(c) for c in found.columns if c not in (base, proposed) and c.lower() != into.lower()]
    return found.select(*kept, named.alias(into))


def find(docs: DataFrame, model: Model | None = None, text: str = "text", into: str = "pii") -> DataFrame:
    """Append ``into``, the personal data of every whole text (see
    ``classify``).  Without a model one is fitted to ``docs`` first.

    Starts and ends count code points, the end exclusive.  Null and empty
    texts have no spans; repeated rows have the same spans each; an empty
    table gives an empty result.  Base spans are leftmost, not overlapping
    within a kind.  All other columns stay, whatever their names, but one
    named ``into`` is replaced.  A text, its gaps and its spans are one row.
    """
    base, proposed = free_names(docs, "_base", "_proposed")
    if model is None:
        model = fit(proposals(docs.select(text), text))
    return classify(proposals(docs, text, base, proposed), model, into, base, proposed)


def report(docs: DataFrame) -> DataFrame:
    """Counts, a digest of the base spans and the list of all spans.

    Output: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.
    """
    found = written(proposals(docs.select("doc_id", "text")).drop("text"), "proposals")
    named = classify(found, fit(found)).withColumn("sure", F.filter("pii", lambda s: s["kind"].isin(list(BASE))))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("sure", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return named.select(
        "doc_id", *map(count, BASE), F.sha2(listed("sure").cast("binary"), 256).alias("base_sha256"), listed("pii").alias("spans")
    )
