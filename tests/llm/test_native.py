"""Decontamination and personal data, against brute force in Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontamination, pii, queries
from plumbline.llm.binding import states

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, item_id LONG, hash INT, found STRING"

ITEM = "A train leaves Boston at noon with 120 passengers and Alice asks how many km it runs in 3 hours today."
PARAM = "A train leaves Denver at noon with 85 passengers and Bob asks how many km it runs in 7 hours today."
TWICE = "he pays 40 euros to Anna and then 40 euros to Bob while Anna keeps the box shut"
MIXED = "he pays 7 euros to Kim and then 9 euros to Tom while Lee keeps the box shut"


def brute_tokens(text):
    pattern = re.compile(r"[^\W\d_]+|[0-9]+(?:[.,][0-9]+)*|[.!?\n]")
    out, before = [], None
    for x in pattern.findall(text or ""):
        if x not in ".!?\n":
            if x[0].isdigit():
                kind = decontamination.NUMBER
            elif before is not None and x[0] != x[0].lower() and before not in list(".!?\n"):
                kind = decontamination.NAME
            elif before and before[0].isdigit() and x.lower() in decontamination.UNITS:
                kind = decontamination.UNIT
            else:
                kind = None
            out.append((kind or x.lower(), x if kind else ""))
        before = x
    return out


def brute_windows(text, size=decontamination.WINDOW):
    t = brute_tokens(text)
    for i in range(max(len(t) - size + 1, 1) if t else 0):
        w = t[i : i + size]
        yield i, tuple(x for x, _ in w), tuple(v for _, v in w if v)


def brute_contaminated(docs, items):
    out = set()
    for item, text in items:
        own = {}
        for _, w, s in brute_windows(text):
            if len(s) * 2 <= decontamination.WINDOW:
                own.setdefault(w, set()).add(s)
        for doc, body in docs:
            hit, values = set(), {}
            for _, w, s in brute_windows(body):
                for mine in own.get(w, ()):
                    hit.add(w)
                    for a, b in zip(mine, s, strict=True):
                        values.setdefault(a, set()).add(b)
            if own and hit and len(hit) >= decontamination.COVERAGE * len(own):
                share = sum(len(v) == 1 for v in values.values()) / len(values) if values else 1.0
                if share >= decontamination.CONSISTENT:
                    out.add((doc, item, len(own), len(hit)))
    return out


def test_decontamination(spark):
    docs = [(1, f"Well.\n{ITEM}\nEnd"), (2, f"so {PARAM}"), (3, MIXED), (4, "nothing here"), (5, ITEM[:40])]
    docs += [(6, ""), (7, "x " * 60_000), (1, f"Well.\n{ITEM}\nEnd"), (None, ITEM), (8, None)]
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], SCHEMA)
    bench = spark.createDataFrame(
        [(9, ITEM, 1), (9, ITEM, 1), (13, TWICE, 1), (10, None, 1), (11, "", 1), (12, "too short", 1)],
        "item_id LONG, text STRING, doc_id INT",
    )
    got = decontamination.contaminated(df, bench)
    told = {r.doc_id: r for r in got.collect()}
    assert sorted(told, key=str) == [1, 2, None] and got.count() == 3
    assert not told[1].reparameterised and told[2].reparameterised and told[1].item_id == 9
    assert told[1].coverage == 1.0 and told[1].consistency == 1.0
    assert decontamination.contaminated(df.limit(0), bench).count() == 0
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0


def test_versions_of_an_item_in_one_document(spark):
    other = PARAM.replace("Denver", "Austin").replace("85", "64").replace("Bob", "Carol")
    far = " ".join(f"filler{i}" for i in range(40)).translate(str.maketrans("0123456789", "abcdefghij"))
    head, tail = ITEM[:58], ITEM[58:]
    docs = [(1, f"{ITEM}\n{PARAM}"), (2, f"{PARAM}\n{ITEM}"), (3, f"{PARAM}\n{other}"), (4, f"{PARAM} {far}. {other}")]
    docs += [(5, f"{MIXED}\n{MIXED}"), (6, f"{head} {far} {tail}"), (7, f"{MIXED}\n{TWICE}")]
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], SCHEMA)
    bench = spark.createDataFrame([(9, ITEM, 1), (13, TWICE, 1)], "item_id LONG, text STRING, doc_id INT")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(df, bench).collect()}
    assert set(got) == {(1, 9), (2, 9), (3, 9), (4, 9), (6, 9), (7, 13)}
    assert [got[i, 9].reparameterised for i in (1, 2, 3, 4)] == [False, False, True, True]
    assert got[1, 9].consistency == got[2, 9].consistency == 1.0
    assert got[2, 9].first_token > 15 and got[1, 9].first_token == 0


def test_items_of_figures_capitals_and_few_words(spark):
    sums = "Compute 12 + 7 + 93 + 4 + 18 + 5 + 61 + 30 now"
    title = "What Is The Largest Known Planet Near Any Distant Giant Star"
    items = [(1, sums), (2, title), (3, "why do cats purr"), (4, "2 + 2 = 4"), (5, title.upper()), (6, ITEM)]
    docs = [(1, sums), (2, f"Some page. Q: {sums} and more"), (3, sums.replace("93", "94").replace("18", "81"))]
    docs += [(4, f"Read this: {title}"), (5, "What Is A Very Small Unknown Moon Near My Other Lesser Sun")]
    docs += [(6, "so why do cats purr at night when they sleep"), (7, "so why do dogs purr at night when they sleep")]
    docs += [(8, "we know that 2 + 2 = 4 and go on from there"), (9, "we know that 2 + 3 = 5 and go on from there")]
    docs += [(10, f"{title.upper()} and then"), (11, None), (12, ""), (13, f"see {PARAM}")]
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], SCHEMA)
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id LONG, text STRING, doc_id INT")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(df, bench).collect()}
    titles = {(d, i) for d in (4, 10) for i in (2, 5)}
    assert set(got) == {(1, 1), (2, 1), (6, 3), (8, 4), (13, 6)} | titles
    assert got[1, 1].coverage == got[10, 5].coverage == got[6, 3].coverage == 1.0
    assert got[6, 3].first_token == 1 and not got[6, 3].reparameterised and got[13, 6].reparameterised


def test_both_joins_agree(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    small = sorted(map(tuple, decontamination.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontamination.contaminated(docs, bench).collect())) == small


def test_decontamination_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    got = {
        (r.doc_id, r.item_id, r.n_windows, r.n_matched)
        for r in queries.op2_decontamination(spark, SF_DIR).collect()
    }
    assert got == brute_contaminated(docs, items)
    whole = {(d, i) for d, t in docs for i, q in items if q in t}
    assert whole <= {(d, i) for d, i, _, _ in got}


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    each = [int(c) for c in reversed(digits)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(each)) % 10 == 0


def brute_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(
        (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),  # noqa: B023
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                "phone": lambda: 10 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def odd_texts():
    pick = random.Random(11)
    bits = [
        "a@b.c", "x.y+z@mail-1.example.com", "..foo@d.e", "a@b..c@d.e", "1.2.3.4", "255.255.0.1", "256.1.1.1",
        "1.2.3.4.5.6.7.8", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111-1111-1112", "5500005555555559",
        "+1 (555) 123-4567", "+44 20 7946 0958", "+1", "++1234567890", "12", "@", ".", " ", "-", "é", "🙂",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "a" * 30, "mail: bob [at] example [dot] com",
        "card 1234567890123456", "_", "+", "\n", "word",
    ]
    made = ["".join(pick.choices(bits, k=pick.randint(1, 12))) for _ in range(400)]
    return [*made, "", "1" * 100_000, "1 " * 60_000, "a" * 100_000, "a@" + "b." * 40_000 + "c", "+1" * 30_000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, (None, "a@b.c", 1, 1, ""), (5, None, 1, 1, ""), (5, None, 1, 1, "")], SCHEMA)


def test_base_spans_by_brute_force(spark, odd):
    model = pii.train(odd)
    found = odd.select("text", pii.spans(F.col("text"), model).alias("spans")).collect()
    for r in found:
        base = [(s.start, s.rank, s.end, s.kind) for s in r.spans if s.base]
        assert base == brute_base(r.text), r.text[:200]
        assert list(r.spans) == sorted(r.spans)
        weak = [s for s in r.spans if not s.base]
        assert all(a.end <= b.start for a, b in zip(weak, weak[1:], strict=False))


def test_secrets_are_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = pii.train(docs)
    assert 0 < model.reliability["secret"]["context"] <= 1
    secret = "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\""
    row = spark.createDataFrame([(secret,), ("a word of text",)], "text STRING")
    got = [r[0] for r in row.select(pii.written(pii.spans(F.col("text"), model))).collect()]
    assert got == ["secret:9:49", ""]


def test_redaction(spark, odd):
    model = pii.Model()
    out = odd.select("text", pii.redacted(F.col("text"), pii.spans(F.col("text"), model)).alias("r"))
    for r in out.collect():
        if r.text is None:
            assert r.r is None
            continue
        at, parts = 0, []
        for start, _, end, kind in brute_base(r.text):
            if start >= at:
                parts += [r.text[at:start], f"<{kind}>"]
            at = max(at, end)
        assert r.r == "".join(parts) + r.text[at:]


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 256, 1000])
def test_states_of_a_walk(spark, n):
    items = [(i * 37) % 11 - 3 for i in range(n)]
    row = spark.createDataFrame([(items,)], "x ARRAY<INT>")
    got = row.select(states(F.col("x"), F.lit(5), lambda s, x: F.greatest(s + x, F.lit(0)))).first()[0]
    expected = [5]
    for x in items:
        expected.append(max(expected[-1] + x, 0))
    assert got == expected


def test_weak_spans_by_brute_force(spark):
    r = random.Random(5)
    bits = ["a@b.cd", "x" * 19 + "@y.zz", "4111 1111 1111 1112", "4111111111111111", "+1 202 555 0100",
            "t0" * 12, "me (at) home [dot] com", "sk-" + "Ab1" * 9, "ann@" + "q" * 25 + ".org", "word", "10.0.0.1"]
    texts = ["".join(r.choice(bits) + r.choice(["", " ", " ", "."]) for _ in range(r.randint(0, 60))) for _ in range(150)]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING").select(
        pii.candidates(F.col("text")).alias("c"),
        pii.spans(F.col("text"), pii.Model(), accept=0.0).alias("s"),
    )
    n_weak = 0
    for every, told in rows.collect():
        order = sorted({(c.start, pii.KINDS.index(c.kind), c.end, c.base) for c in every})
        kept, end = [x for x in order if x[3]], 0
        for x in [x for x in order if not x[3]]:
            if any(b[0] < x[2] and x[0] < b[2] for b in order if b[3]) or x[0] < end:
                continue
            kept, end, n_weak = [*kept, x], x[2], n_weak + 1
        assert [(s.start, s.rank, s.end, s.base) for s in told] == sorted(kept)
    assert n_weak > 100


def test_many_matches_in_one_text(spark):
    n = 3_000
    text = " ".join(f"u{i}@b.cd" for i in range(n)) + " " + " ".join(f"{i:08d}" + "aB" * 8 for i in range(n))
    row = spark.createDataFrame([(text,)], "text STRING")
    found = pii.spans(F.col("text"), pii.Model(), accept=0.0)
    spans = row.select(found).first()[0]
    assert len(spans) == 2 * n and all(text[s.start : s.end].find(" ") < 0 for s in spans)


def test_pii_query(spark):
    got = queries.op6_pii(spark, SF_DIR)
    docs = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = brute_base(docs[r.doc_id])
        text = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.n_email == sum(b[3] == "email" for b in base)
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_nothing_to_learn(spark, odd):
    none = odd.limit(0)
    assert pii.train(none) == pii.Model()
    assert none.select(pii.spans(F.col("text"), pii.Model())).count() == 0
