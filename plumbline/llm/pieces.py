"""SentencePiece encoding and decoding through a table of distinct marked words.

Where no piece holds a white-space marker after another character, no merge can
cross into a marker, so a text falls into independent chunks: markers followed by
a word. Each task keeps a bounded table of the chunks it has met; the distinct
chunks of a group of texts that are not in it are segmented once, in one call, and
ids are joined back by position. The occurrences of a word never travel: a table
of words shared by all tasks would shuffle every occurrence of every word.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.token_counts import groups_of
from plumbline.llm.workers import lean, parts_of

MARK = "▁"
TABLE_ENTRIES = 400_000
LONGEST = 40
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")

_worker: dict = {}


class _Segmenter:
    def __init__(self, path: str, entries: int):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.model = SentencePieceProcessor(model_file=path)
        proto = ModelProto.FromString(self.model.serialized_model_proto())
        normal = proto.normalizer_spec
        inside = re.compile(f"[^{MARK}]{MARK}")
        self.splits = (
            normal.add_dummy_prefix
            and normal.escape_whitespaces
            and not normal.remove_extra_whitespaces
            and not normal.precompiled_charsmap
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and proto.trainer_spec.model_type == proto.trainer_spec.BPE
            # user-defined symbols are matched before merging, whatever surrounds them
            and not any(p.type == 4 or inside.search(p.piece) for p in proto.pieces)
        )
        self.limit = entries
        self.table: dict[str, bytes] = {}
        self.mark = self._bytes([self.model.piece_to_id(MARK)])
        self.begin = self._bytes([self.model.bos_id()])
        self.end = self._bytes([self.model.eos_id()])

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def _segment(self, chunks: list[str]) -> dict[str, bytes]:
        # The library puts the first marker there itself, but none before an empty text.
        ids = self.model.encode([c[1:] for c in chunks], num_threads=1)
        made = dict(zip(chunks, map(self._bytes, ids), strict=True))
        if MARK in made:
            made[MARK] = self.mark
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, without begin and end."""
        if not self.splits:
            return [self._bytes(x) for x in self.model.encode(texts, num_threads=1)]
        cut = [_CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        wanted = set().union(*cut)
        if len(self.table) > self.limit:
            self.table = {}
        missed = [c for c in wanted if c not in self.table]
        fresh = self._segment(missed) if missed else {}
        local = {c: self.table[c] for c in wanted if c not in fresh} | fresh
        self.table.update((c, ids) for c, ids in fresh.items() if len(c) <= LONGEST)
        return [b"".join(map(local.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


def _segmenter(path: str, entries: int) -> _Segmenter:
    if _worker.get("key") != (path, entries):
        _worker.update(key=(path, entries), segmenter=_Segmenter(path, entries))
    return _worker["segmenter"]


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    digest: bool = False,
    entries: int = TABLE_ENTRIES,
) -> DataFrame:
    """Columns ``keep`` and the ids of every whole text with begin and end, as the library
    gives them.

    Columns ``ids`` (array of int) and ``decoded``, the text the library decodes them
    to; with ``digest``, in their place ``n_tokens``, ``ids_sha256`` over the ids as
    little-endian unsigned 32-bit integers and ``decoded_sha256``. NULL is the empty
    text: begin and end only. One row per row that goes in. A model whose pieces cross
    markers, or that normalises text, encodes whole texts.
    """
    fields = [
        ("n_tokens", pa.int64(), "LONG"),
        ("ids_sha256", pa.string(), "STRING"),
        ("decoded_sha256", pa.string(), "STRING"),
    ]
    if not digest:
        fields = [("ids", pa.list_(pa.int32()), "ARRAY<INT>"), ("decoded", pa.string(), "STRING")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _segmenter(path, entries)
        for batch in parts_of(batches):
            at = 0
            for group in groups_of(batch.column(batch.num_columns - 1).to_pylist()):
                made: list[tuple] = []
                for ids in model.encode(group):
                    ids = model.begin + ids + model.end
                    decoded = model.decode(ids)
                    if digest:
                        made.append(
                            (
                                len(ids) // 4,
                                hashlib.sha256(ids).hexdigest(),
                                hashlib.sha256(decoded.encode()).hexdigest(),
                            )
                        )
                    else:
                        made.append((np.frombuffer(ids, "<i4"), decoded))
                some = batch.slice(at, len(group))
                at += len(group)
                arrays = [
                    pa.array(list(c), f[1])
                    for c, f in zip(zip(*made, strict=True), fields, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:-1], *arrays],
                    names=[*some.schema.names[:-1], *[f[0] for f in fields]],
                )

    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("__text"))
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.mapInArrow(lean(run), ", ".join([*kinds, *[f"{n} {sql}" for n, _, sql in fields]]))


def decode(
    docs: DataFrame, path: str, id: str = "doc_id", ids: str = "ids", entries: int = TABLE_ENTRIES
) -> DataFrame:
    """``id`` and ``decoded``: the library's text for each array of ids; NULL has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _segmenter(path, entries).model
        for batch in batches:
            texts = [model.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["id", "decoded"]
            )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, decoded STRING").withColumnRenamed("id", id)
