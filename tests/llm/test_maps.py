"""Operators that work text by text: tokens, pieces, digests, quality, language."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from plumbline.llm import bytetext, digest, hyperlang, pieces, quality, queries, token_counts

SF_DIR = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id LONG, text STRING, id STRING, t INT, n LONG"


def odd_texts(n: int = 400) -> list[str]:
    pick = random.Random(5)
    alphabets = (
        " \t\n\r\x0b\x0c\x1c\x85\xa0   aAéßstre'lL12²½x.,!?-_́ɏȘ<|>漢字🙂　а",
        "ab ▁ c  \n'é",
        "the and of 12.5 ,'s  ",
    )
    made = ["".join(pick.choices(pick.choice(alphabets), k=pick.randint(0, 60))) for _ in range(n)]
    return [*made, "", " ", "▁", "  ", "a<|endoftext|>b <|endoftext|>", "ab " * 30_000, "é" * 50_000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", "x", 1, 1), (3, None, None, None, None), (7, "twice", "x", 1, 1)] * 2
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_token_counts(spark, odd):
    model = Tokenizer.from_file(BPE)
    got = token_counts.token_counts(odd, BPE)
    expected = [
        (r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or "", add_special_tokens=False).ids))
        for r in odd.collect()
    ]
    assert bag(got, "doc_id", "n_bytes", "n_tokens") == sorted(expected, key=str)
    assert token_counts.token_counts(empty(spark), BPE).count() == 0


def test_small_tiers_count_the_same(odd):
    assert bag(token_counts.token_counts(odd, BPE, top=3, cache_entries=2), "doc_id", "n_tokens") == bag(
        token_counts.token_counts(odd, BPE), "doc_id", "n_tokens"
    )


def test_pieces(spark, odd):
    model = SentencePieceProcessor(model_file=PIECES)
    got = pieces.encode(odd, PIECES, digest=True)
    expected = []
    for r in odd.collect():
        ids = model.encode(r.text or "", add_bos=True, add_eos=True)
        expected.append(
            (
                r.doc_id,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(model.decode(ids).encode()).hexdigest(),
            )
        )
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert bag(got, *columns) == sorted(expected, key=str)
    assert pieces.encode(empty(spark), PIECES).count() == 0


def test_pieces_round_trip(odd):
    coded = pieces.encode(odd, PIECES, keep=("doc_id", "text"))
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    assert coded.where("decoded != coalesce(text, '') AND text NOT LIKE '%▁%'").count() == 0
    assert bag(pieces.decode(coded, PIECES), "doc_id", "decoded") == bag(coded, "doc_id", "decoded")


def brute_digest(text: str) -> list[int]:
    b, counts = text.encode(), np.zeros(digest.BUCKETS, int)
    for k, (second, third) in enumerate(digest._TRIPLETS):
        for i in range(len(b) - third):
            x = digest._HASH[0, k][b[i]] ^ digest._HASH[1, k][b[i + second]]
            counts[x ^ digest._HASH[2, k][b[i + third]]] += 1
    cuts = np.sort(counts)[digest._CUTS]
    return [(c > cuts).sum() for c in counts]


def test_digest_by_brute_force():
    texts = ["", "a", "ab", "abc", "abcd", "the cat sat on the mat", "é" * 40, "", "abcabc" * 99]
    made = digest.digests(pa.array(texts, pa.large_string()))
    assert [list(d[2:]) for d in made] == [brute_digest(t) for t in texts]
    assert digest.text_of(made[0]) == digest.text_of(made[7])
    a, b = made[5], made[8]
    assert digest.likeness_of(digest.text_of(a), digest.text_of(b)) == digest.likeness(a, b)
    assert digest.likeness(a, a) == 1.0 and 0.0 <= digest.likeness(a, b) < 1.0


def test_edit_check(spark, odd):
    rows = odd.dropDuplicates(["doc_id", "text"]).where("doc_id IS NOT NULL AND doc_id != 3 AND doc_id != 7")
    texts = dict(rows.select("doc_id", "text").collect())
    ids = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in digest.edit_check(rows).collect()}
    assert sorted(got, reverse=True) == ids
    for i, x in enumerate(ids):
        own, after = texts[x], texts[ids[(i + 1) % len(ids)]]
        k = len(own) // 3
        made = own[: len(own) - k] + after[:k]
        assert got[x].n_chars == len(own)
        assert got[x].edited_sha256 == hashlib.sha256(made.encode()).hexdigest()
        d = digest.digests(pa.array([own, made, after], pa.large_string()))
        assert got[x].fingerprint == digest.text_of(d[0])
        assert got[x].edited_fingerprint == digest.text_of(d[1])
        assert got[x].near_edited == digest.likeness(d[0], d[1])
        assert got[x].near_next == digest.likeness(d[0], d[2])


def test_edit_check_repeats_and_empty(spark, odd):
    assert digest.edit_check(odd).count() == odd.count()
    assert digest.edit_check(empty(spark)).count() == 0
    one = spark.createDataFrame([(1, "abcdef", "", 1, 1)], SCHEMA)
    assert digest.edit_check(one).first().edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert digest.fingerprints(odd).count() == odd.count()


def test_words_and_shingles_by_brute_force():
    texts = [t for t in odd_texts(150) if len(t) < 1000] + ["A b\x0bC  d e F"]
    for size in (1, 3):
        for part in bytetext.slices(pa.array([*texts, None]), 300):
            w = bytetext.words(part)
            values, owner = bytetext.shingles(w, size, len(part))
            sets = bytetext.distinct_sets(values, owner, len(part))
            for k in range(len(part)):
                text = part.data[part.offsets[k] : part.offsets[k + 1]].tobytes().lower().split()
                grams = {tuple(text[i : i + size]) for i in range(max(len(text) - size + 1, 0))}
                expected = len(grams) if len(text) >= size else int(bool(text))
                assert len(sets[k]) == expected and (w.owner == k).sum() == len(text)


def test_quality_on_held_out(spark):
    got = queries.op3_quality(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    both = got.join(labels, "doc_id").where("held_out").toPandas()
    assert got.count() == 200 and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert both.predicted.eq(both.quality).mean() > 0.8


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame(
        [(i, i % 2, "x") for i in range(20)] + [(None, 1, "x"), (1, None, "x"), (2, 0, "y")],
        "doc_id LONG, quality INT, text STRING",
    )
    model = quality.train(odd, labels)
    assert quality.score(odd, model).count() == odd.count()
    assert quality.score(empty(spark), model).count() == 0
    none = quality.train(empty(spark), labels)
    assert quality.score(odd, none).select("score").distinct().count() == 1
    ones = quality.train(odd, labels.where("quality = 1"))
    assert quality.score(odd, ones).where("score > 0.5").count() == odd.count()


def test_quality_fit_repeats(spark):
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(40)]
    rows = [(f"d{i}", " ".join(r.choice(words[i % 2 * 10 :], 12)), i % 2) for i in range(60)]
    again = [("d1", "another text of one id", 1)] * 200
    docs = spark.createDataFrame([*rows, *again], "doc_id STRING, text STRING, quality INT")
    labels = docs.select("doc_id", "quality")
    a = quality.train(docs, labels)
    b = quality.train(docs.orderBy(F.desc("text")).repartition(7), labels)
    assert np.array_equal(a.weights, b.weights) and (a.bias, a.slope) == (b.bias, b.slope)


def test_descent_separates():
    rows = [np.array([i % 2, 10 + i]) for i in range(60)]
    labels = np.array([i % 2 for i in range(60)])
    model = quality.fit(rows, labels)
    assert model.weights[1] > 0 > model.weights[0]


def test_language(spark, odd):
    got = queries.op8_language(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    both = got.join(docs, "doc_id").where("held_out").toPandas()
    assert (both.lang_pred == both.lang).mean() > 0.95
    languages, prototypes = hyperlang.train(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert languages == ["de", "en", "es", "fr"]
    told = hyperlang.predict(odd, languages, prototypes, keep=("doc_id", "text"))
    for r in told.collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    assert told.count() == odd.count()


def test_language_edges(spark, odd):
    clash = odd.withColumnRenamed("id", "lang").withColumnRenamed("n", "__n")
    languages, prototypes = hyperlang.train(clash.where("lang = 'none'"))
    assert languages == [] and len(prototypes) == 0
    told = hyperlang.predict(odd, languages, prototypes)
    assert {r.lang_pred for r in told.collect()} == {"und"}
    assert hyperlang.predict(empty(spark), languages, prototypes).count() == 0


def test_trigrams_by_brute_force():
    texts = ["Ab, c!", "", "  ÉÀ--é", "123", "x"]
    part = next(bytetext.slices(pa.array(texts)))
    bundle, _ = hyperlang.profiles(part)
    for k, text in enumerate(texts):
        letters = [0]
        for c in text:
            low = ord(c.lower()) if c.isalpha() else 0
            if low or letters[-1]:
                letters.append(low)
        if letters[-1]:
            letters.append(0)
        total = np.zeros(hyperlang.DIMENSIONS)
        for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
            v = np.roll(hyperlang._vector(a), 2).astype(int) * np.roll(hyperlang._vector(b), 1)
            total += v * hyperlang._vector(c)
        assert np.array_equal(bundle[k], total), text


def peak_of(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


@pytest.mark.parametrize("kind", ["short", "wide", "long"])
def test_language_memory_is_bounded(kind):
    pick = np.random.default_rng(3)
    if kind == "short":
        texts = ["".join(map(chr, pick.integers(97, 123, 40))) for _ in range(10_000)]
    else:
        n = 174_000 if kind == "wide" else 1_000_000
        texts = ["".join(map(chr, pick.integers(0x4E00, 0x4E00 + 5000, n)))]
    column = pa.array(texts)
    hyperlang._letters()

    def work():
        for part in hyperlang._parts(column):
            hyperlang.profiles(part)

    assert peak_of(work) < 300


def test_language_by_parts_is_the_same(monkeypatch):
    texts = ["Ab, c! " * 50, "", "éàü 漢字かな " * 9, "123", "x", *[f"t{i} ab" for i in range(40)]]
    whole = [hyperlang.profiles(p) for p in hyperlang._parts(pa.array(texts))]
    monkeypatch.setattr(hyperlang, "_AT_ONCE", 3)
    monkeypatch.setattr(hyperlang, "_TEXTS", 4)
    parts = [hyperlang.profiles(p) for p in hyperlang._parts(pa.array(texts))]
    assert len(parts) > len(whole) == 1
    for k in (0, 1):
        assert np.array_equal(np.concatenate([p[k] for p in parts]), whole[0][k])
