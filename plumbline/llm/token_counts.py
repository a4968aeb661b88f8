"""Token counts: a broadcast table of frequent pre-token lengths over worker caches.

A byte-level BPE tokenizer never merges across pre-tokens, so a text has as many
tokens as its pre-tokens have together. Each task cuts whole texts into
pre-tokens and adds up lengths: the first tier is a broadcast table of the most
frequent pre-tokens, the second a cache in the worker process, and only what
both miss goes to the tokenizer. No pre-token is shuffled and the counts never
depend on what the tiers hold.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP = 32_768
LONGEST = 24
WARM_ROWS = 4_000
CACHE_ENTRIES = 300_000
BATCH_CHARS = 1 << 21

# General categories up to U+024F, where they no longer change.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_BLANK = r"\t-\r \x85\xa0"
_LATIN = re.compile(r"[\x00-ɏ]*")
_PRE_TOKEN = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
# Pieces that begin with white space, for texts beyond Latin; no pre-token crosses
# into ASCII white space, unless other white space stands next to it.
_PIECE = re.compile(r"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
_ODD_BLANK = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_worker: dict = {}


class _Lengths:
    """The tokenizer of a worker process with its cache, kept between tasks."""

    def __init__(self, path: str, cache_entries: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        split = settings["pre_tokenizer"] or {}
        self.splits = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and settings["normalizer"] is None
        )
        special = [t["content"] for t in settings["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.limit = cache_entries
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens, or larger independent pieces; None if only the whole text will do."""
        if not self.splits or self.special and self.special.search(text):
            return None
        if _LATIN.fullmatch(text):
            return _PRE_TOKEN.findall(text)
        return None if _ODD_BLANK.search(text) else _PIECE.findall(text)

    def look_up(self, wanted: set[str], frequent: dict[str, int]) -> dict[str, int]:
        found, missed = {}, []
        for piece in wanted:
            n = frequent.get(piece) or self.recent.get(piece) or self.older.get(piece)
            if n is None:
                missed.append(piece)
            else:
                found[piece] = n
        fresh = dict(zip(missed, self.encode(missed), strict=True)) if missed else {}
        if len(self.recent) + len(fresh) > self.limit:
            self.recent, self.older = {}, self.recent
        for piece, n in fresh.items():
            if len(piece) <= LONGEST:
                self.recent[piece] = n
        found.update(fresh)
        return found

    def count(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        cut = [self.pieces(t) for t in texts]
        known = self.look_up(set().union(*[p for p in cut if p]), frequent)
        whole = [t for t, p in zip(texts, cut, strict=True) if p is None]
        lengths = iter(self.encode(whole) if whole else ())
        return [
            next(lengths) if p is None else sum(map(known.__getitem__, p)) for p in cut
        ]


def _lengths(path: str, cache_entries: int) -> _Lengths:
    if _worker.get("key") != (path, cache_entries):
        _worker.update(key=(path, cache_entries), lengths=_Lengths(path, cache_entries))
    return _worker["lengths"]


def groups_of(texts: list[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Runs of texts with at most ``limit`` characters, or of one text."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def frequent_lengths(
    docs: DataFrame, path: str, text: str = "text", top: int = TOP, rows: int = WARM_ROWS
) -> dict[str, int]:
    """At most ``top`` frequent pre-tokens of at most ``LONGEST`` characters, with lengths.

    They are taken from about ``rows`` texts chosen by hash. This only warms the first
    tier: what it lacks is looked up behind it, so every count is exact all the same.
    """
    n = docs.count()
    if n == 0:
        return {}
    share = min(1.0, rows / n)
    picked = docs.where(
        F.pmod(F.xxhash64(F.lit("warm"), text), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, seen = _lengths(path, CACHE_ENTRIES), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(p for p in lengths.pieces(t or "") or () if len(p) <= LONGEST)
        most = seen.most_common(top)
        yield pa.RecordBatch.from_pydict(
            {"piece": [p for p, _ in most], "n": [n for _, n in most]},
            pa.schema([("piece", pa.string()), ("n", pa.int64())]),
        )

    table = (
        picked.select(F.col(text).alias("t"))
        .mapInArrow(pieces, "piece STRING, n LONG")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(top)
        .toArrow()
    )
    found = table.column("piece").to_pylist()
    return dict(zip(found, _lengths(path, CACHE_ENTRIES).encode(found), strict=True))


def token_counts(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    top: int = TOP,
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """``id``, ``n_bytes`` and ``n_tokens`` of every text, as the tokenizer at ``path`` counts.

    No special tokens are added; special strings in a text are handled as the
    tokenizer does by default. NULL is the empty text with no bytes and no tokens.
    One row comes out for each row that goes in, repeated ones too; other columns
    are left out. Runs one small job to fill the first tier.
    """
    rows = docs.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    frequent: Broadcast = docs.sparkSession.sparkContext.broadcast(
        frequent_lengths(rows, path, "t", top)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, common = _lengths(path, cache_entries), frequent.value
        for batch in batches:
            n = [
                k
                for group in groups_of(batch.column(1).to_pylist())
                for k in lengths.count(group, common)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return (
        rows.withColumn("n_bytes", F.octet_length("t").cast("long"))
        .mapInArrow(count, f"id {kind}, n_bytes LONG, n_tokens LONG")
        .withColumnRenamed("id", id)
    )
