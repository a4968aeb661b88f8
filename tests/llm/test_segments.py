"""Passages grown from content-defined units."""

from __future__ import annotations

import random
from collections import defaultdict

from plumbline.llm import queries, segments
from plumbline.llm.bytetext import Texts, words

import numpy as np  # isort: skip

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, row LONG, key INT, id STRING"


def fresh(pick, n):
    return [f"w{pick.randrange(10**9)}" for _ in range(n)]


def planted(passages=40, words_each=51):
    """Texts with fresh words around passages that stand in several of them."""
    pick, texts, where = random.Random(6), [], defaultdict(list)
    kept = [fresh(pick, words_each) for _ in range(passages)]
    for k in range(3 * passages):
        inside = kept[k % passages]
        before, after = fresh(pick, pick.randrange(40)), fresh(pick, pick.randrange(40))
        made = [*before, *inside, *after]
        gaps = [pick.choice((" ", " ", " ", "\n", "\n\n")) for _ in made]
        texts.append("".join(g + (w.upper() if pick.random() < 0.3 else w) for g, w in zip(gaps, made, strict=True)))
        where[k % passages].append(k)
    return texts, where


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)


def test_passages_inside_and_across_lines(spark):
    texts, where = planted()
    clean = [" ".join(fresh(random.Random(99 + i), 200)) for i in range(30)]
    docs = frame(spark, enumerate([*texts, *clean]))
    got = segments.repeated_segments(docs).collect()
    found = {r.doc_id for r in got}
    assert len(found) >= 0.95 * len(texts) and max(found) < len(texts)
    by_class = defaultdict(list)
    for r in got:
        by_class[r.class_key].append(r)
        assert texts[r.doc_id][r.start : r.end].split() and len(texts[r.doc_id][r.start : r.end].split()) == r.n_words >= 24
    for members in by_class.values():
        assert {m.doc_id % 40 for m in members} == {members[0].doc_id % 40}
        assert {m.class_id for m in members} == {min(m.doc_id for m in members)}
    gone = {r.doc_id for r in got if r.removed}
    assert len(gone) > len(texts) / 3
    assert all(set(members) - gone for members in where.values())


def brute(texts, around=segments.AROUND, min_words=segments.MIN_WORDS):
    """Passages by units, text by text in plain loops."""
    units, seen = [], defaultdict(set)
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        h = [int(x) for x in words(Texts(data, np.array([0, len(data)]), 0)).hashes]
        cuts = [
            i
            for i in range(around, len(h) - around)
            if h[i] < min(h[i - around : i]) and h[i] <= min(h[i + 1 : i + around + 1])
        ]
        own = [(a, b) for a, b in zip(cuts, cuts[2:], strict=False)]
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
        units.append([(a, b, tuple(folded[a:b])) for a, b in own])
        for u in units[-1]:
            seen[u[2]].add(len(units))
    made = []
    for k, own in enumerate(units):
        now = None
        hits = [(n, a, b) for n, (a, b, u) in enumerate(own) if len(seen[u]) > 1]
        for n, a, b in [*hits, (10**9, 0, 0)]:
            if now and n - now[0] <= 2:
                now = (n, now[1], b)
                continue
            if now and now[2] - now[1] >= min_words:
                made.append((k, now[2] - now[1]))
            now = (n, a, b)
    return sorted(made)


def test_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    texts = [t for _, t in sorted(map(tuple, docs))]
    got = segments.repeated_segments(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert sorted((r.doc_id, r.n_words) for r in got.collect()) == brute(texts)
    query = queries.op9_paragraphs(spark, SF_DIR)
    assert query.where("line IS NULL").count() == got.count() > 0


def test_edges(spark):
    text = " ".join(fresh(random.Random(1), 80))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "x " * 5000), (5, "é"), (6, text + " " + text)]
    got = segments.repeated_segments(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) in (["1", "1", "6", "None"], ["1", "1", "6", "6", "None"])
    assert sum(not r.removed for r in got) == 1
    assert {r.class_id for r in got} == {1}
    assert segments.repeated_segments(frame(spark, [])).count() == 0
