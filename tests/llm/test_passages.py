"""Repeated passages, against brute force in Python."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from plumbline.llm import passages, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, key LONG, at INT"


def brute_passages(rows, run=passages.RUN):
    """Repeated (id, start, end, removed) of rows with unique ids and distinct texts."""
    places, spots = defaultdict(list), {}
    for i, t in sorted(rows):
        found = list(re.finditer(r"[^\x20\x09-\x0D]+", t or ""))
        folded = [re.sub("[A-Z]", lambda m: m[0].lower(), m[0]) for m in found]
        spots[i] = found
        for k in range(len(found) - run + 1):
            places[tuple(folded[k : k + run])].append((i, k))
    flags = {p: p != v[0] for v in places.values() if len(v) > 1 for p in v}
    out, open_runs = set(), {}
    for i, k in sorted(flags):
        gone = flags[i, k]
        begin = open_runs.pop((i, k - 1, gone), k)
        open_runs[i, k, gone] = begin
    for (i, k, gone), begin in open_runs.items():
        out.add((i, spots[i][begin].start(), spots[i][k + run - 1].end(), gone))
    return out


def told(df):
    return [(r.doc_id, r.start, r.end, r.removed) for r in df.collect()]


def planted(seed=5):
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefghÉ", k=pick.randint(1, 6))) for _ in range(900)]

    def prose(n, gap=" "):
        return gap.join(pick.choices(words, k=n))

    shared = [pick.choices(words, k=n) for n in (40, 50, 51, 60, 120)]
    out = []
    for i in range(120):
        passage = list(shared[i % len(shared)])
        gaps = [" ", "\n", "  "] if i % 2 else [" "]
        body = "".join(w + pick.choice(gaps) for w in passage)
        if i % 7 == 0:
            body = body.upper()
        out.append(f"{prose(pick.randint(0, 300))} {body}{prose(pick.randint(0, 300))}")
    return [*out, "", None, "x " * 3000, " \n"]


def test_passages_inside_and_across_lines(spark):
    rows = list(enumerate(planted()))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], SCHEMA).repartition(5)
    got = told(passages.repeated_passages(df))
    assert len(got) == len(set(got)) and set(got) == brute_passages(rows)
    holders = {i for i, _, _, _ in got}
    assert holders == {i for i in range(120) if i % 5} | {122}


def test_passages_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    first, copied = {}, set()
    for i, t in sorted(docs):
        if (t or "") in first:
            copied |= {i, first[t or ""]}
        first.setdefault(t or "", i)
    expected = brute_passages([(i, t) for t, i in first.items()])
    got = {r for r in told(queries.op9_passages(spark, SF_DIR))}
    # Rows of equal texts are whole texts; what is left is as if each text were there once.
    assert {r for r in got if r[0] not in copied} == {r for r in expected if r[0] not in copied}
    alone = set(first.values())
    assert {r for r in got if r[0] in copied & alone and r[3]} == {
        r for r in expected if r[0] in copied and r[3]
    }
    assert {r[0] for r in got if r[0] in copied} == {
        i for i, t in docs if i in copied and len((t or "").split()) >= passages.RUN
    }


def test_passages_edges(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 1, 1), (1, text, 1, 1), (None, text, 1, 1), (2, f"é {text}", 1, 1), (3, None, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(told(passages.repeated_passages(df)), key=str)
    n = len(text)
    assert got == [(1, 0, n, False), (1, 0, n, True), (2, 2, n + 2, True), (None, 0, n, True)]
    assert {r.first_id for r in passages.repeated_passages(df).collect()} == {1}
    assert passages.repeated_passages(df.limit(0)).count() == 0
