"""Similarity operators, components, the automaton and the pipeline, against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm import automaton, chosen_path, paragraphs, queries, similar
from plumbline.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, key LONG, size INT, `group` STRING"


def fold_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def grams(text, size=similar.SHINGLE):
    w = fold_words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def near_copies(n=500, seed=3):
    """Texts with groups of copies and near copies, some long, some empty."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdefgh", k=pick.randint(1, 6))) for _ in range(900)]
    out = ["", None, " \n", "one", "one", "One two", "w " * 30_000]
    base = pick.choices(vocabulary, k=150)
    while len(out) < n:
        kind = pick.random()
        if kind < 0.3:
            text = list(base)
            for _ in range(pick.randint(0, 8)):
                text[pick.randrange(len(text))] = pick.choice(vocabulary)
        elif kind < 0.5 and len(out) > 20:
            text = fold_words(pick.choice(out[7:]))
            text = [w.decode() for w in text]
            if pick.random() < 0.5 and text:
                text[pick.randrange(len(text))] = "edit"
        else:
            text = pick.choices(vocabulary, k=pick.randint(1, 200))
        out.append(" ".join(text))
    return out


def brute_classes(texts):
    sets = [grams(t) for t in texts]
    links, degree = [], Counter()
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * len(sets[a] | sets[b]):
                links.append((a, b))
                degree[a] += 1
                degree[b] += 1
    return roots(len(texts), links), degree


@pytest.fixture(scope="module")
def copies(spark):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(near_copies())], SCHEMA)


def test_chosen_path_by_brute_force(copies):
    texts = near_copies()
    root, degree = brute_classes(texts)
    got = {r.doc_id: r for r in chosen_path.similar_documents(copies).collect()}
    assert len(got) == len(texts)
    assert [got[i].class_id for i in range(len(texts))] == root
    assert [got[i].n_links for i in range(len(texts))] == [degree[i] for i in range(len(texts))]


def test_large_groups_go_through_levels_and_blocks(copies, monkeypatch):
    whole = sorted(map(tuple, chosen_path.similar_documents(copies).collect()))
    monkeypatch.setattr(chosen_path, "LEAF", 3)
    monkeypatch.setattr(chosen_path, "NODE_BLOCK", 7)
    monkeypatch.setattr(similar, "BLOCK_SETS", 20)
    assert sorted(map(tuple, chosen_path.similar_documents(copies).collect())) == whole


def test_chosen_path_edges(spark):
    rows = [(1, "a b c d e f", 1, 1, ""), (1, "a b c d e f", 1, 1, ""), (None, "a b c d e f", 1, 1, ""), (2, None, 1, 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, chosen_path.similar_documents(df).collect()), key=str)
    assert got == [(1, 1, 2), (1, 1, 2), (2, 2, 0), (None, 1, 2)]
    assert chosen_path.similar_documents(df.limit(0)).count() == 0
    assert chosen_path.runs_for(0.999, 0.8, 3) > chosen_path.runs_for(0.9, 0.8, 3) >= 1


def test_chosen_path_query_by_brute_force(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    root, degree = brute_classes([texts[i] for i in range(len(texts))])
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op10_chosen_path(spark, SF_DIR).collect()}
    assert got == {i: (root[i], degree[i]) for i in range(len(texts))}


def brute_paragraphs(texts):
    places, sets = [], []
    for i, t in enumerate(texts):
        at = 0
        for n, line in enumerate((t or "").split("\n")):
            if len(fold_words(line)) >= paragraphs.MIN_WORDS:
                places.append((i, n, at, at + len(line)))
                sets.append(grams(line))
            at += len(line) + 1
    links = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    root = roots(len(sets), links)
    size = Counter(root)
    return {p: places[r][:2] for p, r in zip(places, root, strict=True) if size[r] > 1}


def check_paragraphs(got, expected):
    rows = got.collect()
    assert {(r.doc_id, r.line, r.start, r.end) for r in rows} == set(expected)
    by_class = {}
    for r in rows:
        by_class.setdefault(r.class_key, []).append(r)
    assert len(by_class) == len(set(expected.values()))
    for group in by_class.values():
        first = {expected[(r.doc_id, r.line, r.start, r.end)] for r in group}
        stay = [(r.doc_id, r.line) for r in group if not r.removed]
        assert stay == list(first) and {r.class_id for r in group} == {stay[0][0]}


def test_paragraphs_by_brute_force(spark):
    pick = random.Random(9)
    pool = [t for t in near_copies(200, 4) if t and len(t) < 5000]
    texts = ["\n".join(pick.choices([*pool, "é short", ""], k=pick.randint(0, 5))) for _ in range(150)]
    texts += ["", None, "\n\n", "x " * 40_000]
    df = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in enumerate(texts)], SCHEMA)
    check_paragraphs(paragraphs.repeated_paragraphs(df), brute_paragraphs(texts))


def test_paragraph_query_by_brute_force(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    expected = brute_paragraphs([texts[i] for i in range(len(texts))])
    check_paragraphs(queries.op9_paragraphs(spark, SF_DIR).where("line IS NOT NULL"), expected)


def test_paragraph_edges(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"top\n{line}\nend", 1, 1, "")] * 2 + [(None, line, 1, 1, ""), (2, "x", 1, 1, ""), (3, None, 1, 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = paragraphs.repeated_paragraphs(df)
    got = sorted((str(r.doc_id), r.line, r.removed) for r in found.collect())
    assert got == [("1", 1, False), ("1", 1, True), ("None", 0, True)]
    assert paragraphs.repeated_paragraphs(df.limit(0)).count() == 0
    two = spark.createDataFrame([(1, line, 1, 1, ""), (2, f"a\n{line}\nb", 1, 1, ""), (3, None, 1, 1, "")], SCHEMA)
    left = paragraphs.without(two, paragraphs.repeated_paragraphs(two))
    assert {r.doc_id: r.text for r in left.collect()} == {1: line, 2: "a\nb", 3: None}


def test_components(spark):
    pick = random.Random(1)
    links = [(pick.randrange(3000), pick.randrange(3000)) for _ in range(1700)]
    links += [(5000 + i, 5001 + i) for i in range(300)] + [(9000, 9001 + i) for i in range(500)]
    links += [(7, 7), (9000, 9001)]
    root = roots(10_000, links)
    seen = {x for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame([*links, (None, 3)], "a LONG, b LONG")
    assert dict(components(df).collect()) == {x: root[x] for x in seen}
    assert components(df.limit(0)).count() == 0


def automaton_rows(spark):
    texts = ["The cat sat", "the CAT ran", "a\x1cb a\x1cb é", "", None, " \n ", "new words", "w " * 30_000, "the cat sat"]
    rows = [(i, t, 1, 2, "x") for i, t in enumerate(texts)] + [(None, "the dog", 1, 1, ""), (2, "twice", 1, 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


def brute_scores(rows, train):
    ends = object()
    streams = [[*fold_words(t), ends] for t in rows]
    one, two = Counter(), Counter()
    for s, keep in zip(streams, train, strict=True):
        if keep:
            one.update(s)
            two.update(zip([None, *s], s, strict=False))
    n, v = sum(one.values()), len(one)
    out = []
    for s in streams:
        base = score = 0.0
        for before, w in zip([None, *s], s, strict=False):
            root = (one[w] + 1) / (n + v + 1)
            visits = one[ends] if before is None else one[before]
            k = automaton.PRIOR
            base += math.log10(root)
            score += math.log10((two[(before, w)] + k * root) / (visits + k))
        out.append((len(s), sum(one[w] > 0 for w in s), n, round(base, 3), round(score, 3)))
    return out


def test_automaton_by_brute_force(spark):
    df = automaton_rows(spark)
    rows = df.collect()
    training = F.col("doc_id") < 6
    expected = brute_scores([r.text for r in rows], [r.doc_id is not None and r.doc_id < 6 for r in rows])
    for size in (automaton.BLOCK_BYTES, 2000):
        got = automaton.scores(df, training, block_bytes=size).collect()
        made = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), round(r.score, 3)) for r in got]
        wanted = [(r.doc_id, *e) for r, e in zip(rows, expected, strict=True)]
        assert sorted(made, key=str) == sorted(wanted, key=str)
    assert automaton.scores(df.limit(0), training).count() == 0
    untrained = automaton.scores(df, F.lit(False)).collect()
    assert len(untrained) == len(rows) and all(r.n_known == 0 for r in untrained)


def test_automaton_query_by_brute_force(spark):
    got = {r.doc_id: r for r in queries.op7_automaton(spark, SF_DIR).collect()}
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    expected = brute_scores([texts[i] for i in ids], [not got[i].held_out for i in ids])
    for i, e in zip(ids, expected, strict=True):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert abs(r.base_score - e[3]) < 2e-3 and abs(r.score - e[4]) < 2e-3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    root, _ = brute_classes([texts[i] for i in range(len(texts))])
    now, left = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF_DIR).cache()
        left[name] = {r.doc_id for r in now.select("doc_id").collect()}
        if name != "pieces":
            assert now.columns == list(corpus_pipeline.COLUMNS)
    assert left["language"] == set(texts)
    assert left["near_duplicates"] == {i for i in texts if root[i] == i}
    found = {r.doc_id for r in queries.op2_decontamination(spark, SF_DIR).select("doc_id").collect()}
    assert left["decontamination"] == left["near_duplicates"] - found
    assert left["pii"] == left["pieces"] == left["decontamination"]
    assert now.where("NOT restored OR n_tokens != size(ids)").count() == 0


def test_pipeline_edges(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, "s", 0), (3, "123", "en", None, 3), (None, "a letter", "en", "s", 8)]
    rows += [(4, "plain words here", None, "s", 16)] * 2 + [(5, "mail a@b.com now", "en", "s", 16)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    for docs in (df, df.limit(0)):
        now = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, SF_DIR)
        got = sorted(((r.doc_id, r.text, r.lang, r.n_chars) for r in now.collect()), key=str)
        assert got == ([] if docs is not df else sorted([
            (4, "plain words here", "en", 16), (5, "mail <email> now", "en", 16), (None, "a letter", "en", 8)
        ], key=str))
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF_DIR).count() == len(got)


def test_pipeline_judges_rows_not_ids(spark, tmp_path):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first()["text"]
    text = "some words that are found twice in this table of rows"
    rows = [(1, text), (7, text), (7, "a text that is found nowhere else in the table"), (None, "before " + item), (None, "nothing to see here")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")
    docs.coalesce(1).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    left = corpus_pipeline.one_of_each(spark, docs, SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[0], *rows[2:]], key=str)
    clean = corpus_pipeline.without_benchmark(spark, docs, SF_DIR)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted([*rows[:3], rows[4]], key=str)


def test_pairs_of_blocks_take_bounded_memory():
    import tracemalloc

    from plumbline.llm import similar

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 1000, dtype=np.uint64)
    sets = []
    for _ in range(1024):
        changed = base.copy()
        changed[rng.integers(0, 1000, 50)] = rng.integers(0, 1 << 62, 50, dtype=np.uint64)
        sets.append(np.unique(changed))
    tracemalloc.start()
    seen = sum(len(counts) for _, counts in similar._overlaps(sets, sets))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert seen == 1024 and peak < 110
