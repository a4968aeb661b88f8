"""Periodic runs and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import periodic, queries, variants

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, id STRING, t INT, n LONG, word STRING, runs INT"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3) for i, t in texts], SCHEMA)


def runs_of(words):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            start = i
            while i + p < len(words) and words[i] == words[i + p]:
                i += 1
            if i - start + p >= max(12, 2 * p) and i > start:
                found.setdefault((start, i + p - start), p)
            i += 1
    return sorted((s, n, p) for (s, n), p in found.items())


def collapsed_of(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def odd_runs():
    pick = random.Random(11)
    made = ["", " \t\n", "a " * 11, "a " * 12, "a b " * 6, "a b c " * 5, "é ü " * 20 + "x", "a b a " * 40]
    for _ in range(200):
        n, kinds = pick.randint(1, 150), pick.choice((1, 2, 3, 40))
        words = [f"w{pick.randrange(kinds)}" for _ in range(n)]
        start, period = pick.randrange(n), pick.randint(1, 20)
        if pick.random() < 0.6:
            words = [words[i] if i < start else words[start + (i - start) % period] if start + period < n else "z" for i in range(n)]
        made.append(pick.choice((" ", "\n", " \x0b")).join(words))
    return [*made, *made[:20], ("x y z " * 30_000)[:-1]]


def test_periodic_runs(spark):
    texts = [*enumerate(odd_runs()), (None, None), (None, "b " * 30), (3, "b " * 30), (3, "b " * 30)]
    got = periodic.periodic_runs(frame(spark, texts)).collect()
    expected = []
    for id, text in texts:
        words = SPLIT.findall(text or "")
        runs = runs_of(words) if len(words) < 1000 else [(0, len(words), 3)]
        expected.append((id, len(words), runs, collapsed_of(words, runs)))
    made = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(made, key=str) == sorted(expected, key=str)
    assert periodic.periodic_runs(frame(spark, [])).count() == 0


def test_texts_in_small_slices(monkeypatch):
    texts = [t.encode() for t in odd_runs()[:80]]
    monkeypatch.setattr(periodic, "SLICE_BYTES", 10)
    monkeypatch.setattr(periodic, "PAIRS", 50)
    for text in texts:
        known: dict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        numbers = periodic._numbers(text, known)
        assert [list(known)[k] for k in numbers] == text.split()
        found = [tuple(map(int, x)) for x in periodic.find_runs([numbers])[0]]
        assert found == runs_of(text.split())


@pytest.mark.parametrize("kinds", [1, 2, 3, 1000])
def test_common_extensions(kinds):
    rng = np.random.default_rng(kinds)
    words = np.append(rng.integers(0, kinds, 300), kinds + 1)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(300), np.arange(300)))
    i, j = i[i != j], j[i != j]
    got = periodic.Extensions(words).common(i, j)
    for a, b, n in zip(i[::17], j[::17], got[::17], strict=True):
        expected = 0
        while max(a, b) + expected < 301 and words[a + expected] == words[b + expected]:
            expected += 1
        assert n == expected


def test_periodic_query_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    expected = []
    for r in rows:
        words = SPLIT.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        expected.append(
            (
                r.doc_id,
                len(runs),
                *best,
                best[1] and 1000 * best[1] // best[2],
                hashlib.sha256(text.encode()).hexdigest(),
                hashlib.sha256(collapsed_of(words, runs).encode()).hexdigest(),
            )
        )
    got = queries.QUERIES["op11_periodic"](spark, SF_DIR)
    assert dict(got.dtypes)["exponent_milli"] == "bigint"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert any(e[1] for e in expected)


# --- spelling variants


def near(word, known):
    letters = {c for w in known for c in w}
    cuts = {word[:i] + word[i + 1 :] for i in range(len(word))}
    puts = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    swaps = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return ((cuts | puts | swaps) & known.keys()) - {word}


def variants_of(counts):
    forms, made = {}, []
    for word, n in counts.items():
        others = near(word, counts)
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 2 * n else None
        made.append((word, forms[word], n, len(others), counts.get(forms[word])))
    out = []
    for word, form, n, n_near, form_n in made:
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, form, root, n, n_near, form_n))
    return sorted(out, key=str)


def counts_of(texts):
    counts = Counter()
    for id, text in texts:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return counts


def test_variants_of_made_words(spark):
    pick = random.Random(4)
    words = {}
    for _ in range(1500):
        word = "".join(pick.choices("abé×", k=pick.randint(5, 9)))
        words[word] = pick.choice((3, 5, 10, 11, 22, 50))
    words |= {"x" * 5000: 3, "x" * 5001: 9, "x" * 5002: 40, "alone": 7}
    got = variants.spelling_variants(spark.createDataFrame(list(words.items()), "word STRING, n LONG"))
    short = {w: n for w, n in words.items() if len(w) < 5000}
    made = sorted(map(tuple, got.collect()), key=str)
    assert [r for r in made if len(r[0]) < 5000] == variants_of(short)
    assert [(len(w), f and len(f), len(r), m) for w, f, r, _, m, _ in made if len(w) >= 5000] == [
        (5000, 5001, 5002, 1), (5001, 5002, 5002, 2), (5002, None, 5002, 1)
    ]


def test_word_counts(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD_WORDS", 3)
    texts = [(i, t) for i, t in enumerate(odd_runs()[:60])]
    texts += [(None, None), (None, "Straße ÀÉx×y÷z ŸĀaıb \x00c İ 漢 d" * 9), (5, ""), (9, "same same"), (9, "same same")]
    got = variants.word_counts(frame(spark, texts), rewrite=variants.drop_letter)
    expected = {w: n for w, n in counts_of(texts).items() if w}
    assert dict(map(tuple, got.collect())) == expected
    assert variants.word_counts(frame(spark, [])).count() == 0
    assert variants.spelling_variants(variants.word_counts(frame(spark, []))).count() == 0


def test_variants_query_by_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    counts = {w: n for w, n in counts_of(rows).items() if len(w) >= 5 and n >= 3}
    got = queries.QUERIES["op12_variants"](spark, SF_DIR)
    assert sorted(map(tuple, got.collect()), key=str) == variants_of(counts)
    assert {t for _, t in got.select("n", "n_near", "form_n").dtypes} == {"bigint"}
