"""Personal data by weak supervision, in DataFrame functions only.

Four kinds are fixed by patterns and checks, and always reported. Further
candidates (long secrets, numbers like card numbers that fail the check,
written-out mail addresses) are weak: regex, gazetteer and context labelers vote on
every candidate, expectation-maximisation estimates how reliable each labeler is,
and a logistic classifier of spans is trained on the posteriors it gives.

Votes and shapes take few values, so a table of their combinations with counts is
all that is learned from; it has at most a few thousand rows, whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.binding import let, states

BASE = ("email", "ip", "card", "phone")
WEAK = ("secret", "account", "contact")
KINDS = BASE + WEAK
ACCEPT = 0.5
ROUNDS = 60

# Possessive forms of the base patterns: they match the same, but need neither
# backtracking nor deep recursion on very long runs. A match can start only where a
# run starts or the match before it ended.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+",
    "contact": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+"
        r"\x20?[\[(]dot[\])]\x20?[A-Za-z]{2,12}+"
    ),
}
# What a text must hold before its pattern is tried.
HINTS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
    "secret": r"[A-Za-z0-9_+/=-]{20}",
    "contact": r"[\[(]at[\])]",
}

# Gazetteers and context words.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu|example"
VENDORS = "sk|pk|ghp|gho|xox[abp]|AKIA|AIza|eyJ|glpat"
CONTEXT = {
    "email": "mail|contact|write|correo|courriel",
    "ip": "ip|host|server|address|addr|node",
    "card": "card|visa|master|credit|karte|carte|tarjeta|payment|iban",
    "phone": "phone|tel|call|fax|mobile|handy",
    "secret": "token|key|secret|password|passwd|pwd|auth|credential",
    "account": "card|visa|master|credit|karte|carte|tarjeta|payment|account|iban",
    "contact": "mail|contact|write|reach|correo|courriel",
}
LABELERS = ("regex", "gazetteer", "context")


def matches(text: Column, pattern: str, hint: str) -> Column:
    """Array of (start, end, value, before, after) of leftmost non-overlapping matches.

    Positions count code points. They come from the lengths of what lies between and
    in matches; ``before`` and ``after`` are up to 24 characters of the gaps.
    """
    empty = F.expr(
        "CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, value: STRING, before: STRING, after: STRING>>)"
    )

    def found(value: Column, gap: Column, at: Column) -> Column:
        def one(own: Column, i: Column) -> Column:
            end = F.get(at, i + 1)
            return F.struct(
                (end - F.length(own)).alias("start"),
                end.alias("end"),
                own.alias("value"),
                F.right(F.get(gap, i), F.lit(24)).alias("before"),
                F.left(F.get(gap, i + 1), F.lit(24)).alias("after"),
            )

        return F.transform(value, one)

    def walk(value: Column, gap: Column) -> Column:
        sizes = F.transform(value, lambda own, i: F.length(F.get(gap, i)) + F.length(own))
        ends = states(sizes, F.lit(0), lambda at, size: at + size)
        return F.when(F.size(value) > 0, let(ends, lambda at: found(value, gap, at))).otherwise(
            empty
        )

    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gap = F.split(text, pattern, -1)
    return F.when(
        text.rlike(hint), let(value, lambda v: let(gap, lambda g: walk(v, g)))
    ).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the checksum that doubles every second from the right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    total = F.aggregate(
        F.transform(
            each,
            lambda d, i: F.coalesce(
                F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d), F.lit(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        part = F.transform(
            F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        )
        return F.forall(part, lambda p: (F.length(p) <= 3) & (p.try_cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """+ for, - against, 0 abstains."""
    vote = F.when(yes, "+")
    if no is not None:
        vote = vote.when(no, "-")
    return vote.otherwise("0")


def _votes(kind: str, m: Column) -> Column:
    """The labelers' votes as a text, in the order of ``LABELERS``."""
    value, digits = m["value"], _digits(m["value"])
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    if kind in ("email", "contact"):
        regex = _vote(value.rlike(r"^[A-Za-z0-9][^@]*[@\[(].*[A-Za-z]{2,}$"), value.rlike(r"\.\."))
        gazetteer = _vote(value.rlike(rf"(?i)[.)\]\x20]({DOMAINS})$"))
    elif kind == "ip":
        regex = _vote(_valid("ip", value), ~_valid("ip", value))
        gazetteer = _vote(value.rlike(r"^[1-9][0-9]{0,2}\."), value.rlike(r"^0"))
    elif kind in ("card", "account"):
        regex = _vote(F.length(digits).isin(15, 16) & luhn(digits), ~luhn(digits))
        gazetteer = _vote(digits.rlike("^(4|5[1-5]|3[47]|6011|65|2[2-7])"), digits.rlike("^0"))
    elif kind == "phone":
        regex = _vote(F.length(digits).between(10, 15), F.length(digits) < 7)
        gazetteer = _vote(value.rlike(r"^\+(1|7|2[0-9]|3[0-9]|4[0-9]|5[0-9]|6[0-9]|8[0-9]|9[0-9])"))
    else:
        regex = _vote(value.rlike("^([0-9a-f]{32,}|[0-9A-F]{32,})$") & mixed, ~mixed)
        gazetteer = _vote(value.rlike(rf"^({VENDORS})"), value.rlike("^[=_+/-]+|[=_-]{4}"))
    context = _vote(
        m["before"].rlike(rf"(?i)\b({CONTEXT[kind]})s?\b[^\p{{L}}\p{{N}}]*(is|=|:)?[^\p{{L}}\p{{N}}]*$"),
        m["before"].rlike(r"(?i)\b(isbn|doi|page|version|build)\b[^\p{L}\p{N}]*$"),
    )
    return F.concat(regex, gazetteer, context)


def _shape(m: Column) -> Column:
    """Features of a span that no labeler looks at: length, quotes and separators."""
    length = F.least(F.floor(F.log2(F.length(m["value"]))), F.lit(7)).cast("string")
    quoted = F.when(m["before"].rlike("[\"'`(<\\[]$"), "q").otherwise("p")
    marks = F.when(m["value"].rlike(r"[\x20()]"), "s").when(m["value"].rlike("[-_+/=]"), "m")
    return F.concat(length, quoted, marks.otherwise("n"))


def _candidate(source: str, m: Column) -> Column:
    base, kind, votes = F.lit(False), F.lit(source), _votes(source, m)
    if source in BASE:
        base = F.coalesce(_valid(source, m["value"]), F.lit(False))
    if source == "card":
        kind = F.when(base, "card").otherwise("account")
        votes = F.when(base, votes).otherwise(_votes("account", m))
    return F.struct(
        m["start"].alias("start"),
        m["end"].alias("end"),
        kind.alias("kind"),
        base.alias("base"),
        votes.alias("votes"),
        _shape(m).alias("shape"),
        F.length(_digits(m["value"])).alias("digits"),
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text: kind, start, end, base (passed its check), votes, shape."""
    text = F.coalesce(text, F.lit(""))
    lists = [
        F.transform(matches(text, pattern, HINTS[source]), partial(_candidate, source))
        for source, pattern in PATTERNS.items()
    ]
    # A dropped base match is no candidate, but for numbers as long as card numbers.
    return F.filter(
        F.concat(*lists),
        lambda c: c["base"]
        | c["kind"].isin("secret", "contact")
        | ((c["kind"] == "account") & c["digits"].between(14, 19)),
    )


@dataclass(frozen=True)
class Model:
    """Reliability of labelers by kind, and the weights of the span classifier."""

    reliability: dict[str, dict[str, float]] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)


def _names(kind: str, votes: str, shape: str) -> list[str]:
    """The classifier's features of a combination."""
    found = [f"{kind}", *[f"{kind}/{n}{v}" for n, v in zip(LABELERS, votes, strict=True)]]
    return [*found, *[f"{kind}/{i}{c}" for i, c in enumerate(shape)]]


def _expectation(table: dict[str, int]) -> tuple[dict[str, float], dict[str, float]]:
    """Posterior by vote combination, and each labeler's estimated accuracy.

    Two classes; a labeler votes +, - or 0 with probabilities that depend on the class
    alone. Pseudo-counts say that labelers are better than chance.
    """
    n = len(LABELERS)
    post = {v: min(max(0.5 + 0.25 * (v.count("+") - v.count("-")), 0.05), 0.95) for v in table}
    given: list[dict] = []
    for _ in range(ROUNDS):
        total = sum(table.values())
        mass = sum(table[v] * post[v] for v in table)
        prior = (mass + 1) / (total + 2)
        given = []
        for j in range(n):
            rate = {}
            for y in (1, 0):
                c = {"+": 4.0 if y else 1.0, "-": 1.0 if y else 4.0, "0": 2.0}
                for v, m in table.items():
                    c[v[j]] += m * (post[v] if y else 1 - post[v])
                rate[y] = {k: x / sum(c.values()) for k, x in c.items()}
            given.append(rate)
        made = {}
        for v in table:
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(given[j][1][v[j]] / given[j][0][v[j]]) for j in range(n))
            made[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        moved = max(abs(made[v] - post[v]) for v in table)
        post = made
        if moved < 1e-7:
            break
    return post, {
        name: rate[1]["+"] / (rate[1]["+"] + rate[0]["+"])
        for name, rate in zip(LABELERS, given, strict=True)
    }


def _logistic(rows: list[tuple[list[str], float, float]]) -> dict[str, float]:
    """Weights of a ridge-regularised logistic model for (features, weight, soft label).

    Rows with equal features share one slope: plain gradient steps over few rows.
    """
    weights = dict.fromkeys({f for names, _, _ in rows for f in names}, 0.0)
    total = sum(w for _, w, _ in rows)
    for _ in range(400):
        slope = {f: 0.001 * x for f, x in weights.items()}
        for names, w, label in rows:
            z = max(-30.0, min(30.0, sum(weights[f] for f in names)))
            error = (1 / (1 + math.exp(-z)) - label) * w / total
            for f in names:
                slope[f] += error
        for f in weights:
            weights[f] -= 0.8 * slope[f]
    return weights


def train(docs: DataFrame, text: str = "text") -> Model:
    """Estimate labelers on all candidates of all texts and fit the span classifier.

    The driver gets the counts of vote and shape combinations, which are bounded by
    the labelers and shapes there are.
    """
    table = (
        docs.select(F.explode(candidates(F.col(text))).alias("c"))
        .groupBy("c.kind", "c.votes", "c.shape")
        .count()
        .orderBy("kind", "votes", "shape")
        .collect()
    )
    reliability, rows = {}, []
    for kind in KINDS:
        own = [r for r in table if r["kind"] == kind]
        if not own:
            continue
        votes: dict[str, int] = {}
        for r in own:
            votes[r["votes"]] = votes.get(r["votes"], 0) + r["count"]
        post, reliability[kind] = _expectation(votes)
        share = 1.0 / sum(votes.values())
        rows += [
            (_names(kind, r["votes"], r["shape"]), r["count"] * share, post[r["votes"]])
            for r in own
        ]
    return Model(reliability, _logistic(rows) if rows else {})


def _score(model: Model, c: Column) -> Column:
    if not model.weights:
        return F.lit(0.0)
    items = [F.lit(x) for pair in sorted(model.weights.items()) for x in pair]
    weights = F.create_map(*items)
    parts = [F.lit("")]
    parts += [
        F.concat(F.lit(f"/{n}"), F.substring(c["votes"], i + 1, 1)) for i, n in enumerate(LABELERS)
    ]
    parts += [F.concat(F.lit(f"/{i}"), F.substring(c["shape"], i + 1, 1)) for i in range(3)]
    total = F.lit(0.0)
    for p in parts:
        total = total + F.coalesce(F.try_element_at(weights, F.concat(c["kind"], p)), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def spans(text: Column, model: Model, accept: float = ACCEPT) -> Column:
    """Array of (start, rank, end, kind, base) in order: base spans and accepted ones.

    A weak span that a base span overlaps is left out, and of weak spans that overlap
    the one that starts first, then the one listed first, stays.
    """
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    kept = F.filter(candidates(text), lambda c: c["base"] | (_score(model, c) >= accept))
    every = F.array_sort(
        F.transform(
            kept,
            lambda c: F.struct(
                c["start"].alias("start"),
                F.element_at(rank, c["kind"]).alias("rank"),
                c["end"].alias("end"),
                c["kind"].alias("kind"),
                c["base"].alias("base"),
            ),
        )
    )

    # In order of start a base span overlaps a weak one if one before it ends behind the
    # weak one's start, or the next one behind it starts before the weak one's end.
    def reach(ends: Column, s: Column) -> Column:
        return F.when(s["base"], F.greatest(ends, s["end"])).otherwise(ends)

    def opened(starts: Column, s: Column) -> Column:
        return F.when(s["base"], s["start"]).otherwise(starts)

    def alone(every: Column, reached: Column, following: Column) -> Column:
        last = F.size(every)
        clear = F.transform(
            every,
            lambda s, i: F.when(
                ~s["base"]
                & (F.get(reached, i) <= s["start"])
                & (F.get(following, last - i - 1) >= s["end"]),
                s,
            ),
        )
        return F.filter(clear, lambda s: s.isNotNull())

    def apart(every: Column) -> Column:
        reached = states(every, F.lit(0), reach)
        following = states(F.reverse(every), F.lit(2**31 - 1), opened)
        return let(reached, lambda r: let(following, lambda f: alone(every, r, f)))

    # Weak spans in order: one that begins before the last kept one ends is dropped.
    def first_ones(weak: Column) -> Column:
        ends = states(
            weak, F.lit(0), lambda at, s: F.when(s["start"] >= at, s["end"]).otherwise(at)
        )

        def kept(at: Column) -> Column:
            marked = F.transform(weak, lambda s, i: F.when(s["start"] >= F.get(at, i), s))
            return F.filter(marked, lambda s: s.isNotNull())

        return let(ends, kept)

    def joined(every: Column) -> Column:
        base = F.filter(every, lambda s: s["base"])
        weak = let(apart(every), first_ones)
        some = F.exists(every, lambda s: ~s["base"])
        return F.when(some, F.array_sort(F.concat(base, weak))).otherwise(every)

    return let(every, joined)


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets.

    Spans that overlap are replaced together, by the kind of the first.
    """

    def parts(found: Column, at: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            begin = F.get(at, i)
            size = s["start"] - begin
            between = F.substring(text, begin + 1, F.greatest(size, F.lit(0)))
            mark = F.when(size >= 0, F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise("")
            return F.concat(between, mark)

        rest = F.substring(text, F.get(at, F.size(found)) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(found, one), ""), rest)

    def walk(found: Column) -> Column:
        ends = states(found, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        return let(ends, lambda at: parts(found, at))

    return let(found, lambda f: F.when(F.size(f) > 0, walk(f)).otherwise(text))
