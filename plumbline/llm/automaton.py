"""Language-model scores by a weighted backoff automaton.

The model is a smoothed bigram model over words. Every word is a state; a state has
an arc for each word seen after it, weighted with the smoothed bigram, and one
failure arc, weighted with what the arcs leave over, to the root, whose arcs are the
smoothed single words. A text is read once from left to right: the state is carried
along, an arc or the failure arc is taken, and log-probabilities add up.

The corpus' n-grams are never in one place. N-grams are 64-bit keys, cut into
buckets by value. Tasks count the keys of their training texts and send, per bucket,
one packed array of sorted keys and counts; blocks of texts send the distinct keys
they need in the same way, and each bucket answers every block with counts. The
answers are the part of the automaton that a block's texts can reach. Keys of one
frequent word with all its successors are spread over all buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.bytetext import mix, slices, words

BLOCK_BYTES = 6 << 20
#: Strength of the root's probability inside a state's smoothed arcs.
PRIOR = 4.0
FLUSH_TOKENS = 4_000_000

_BEGIN = np.uint64(0x6A09E667F3BCC909)
_END = np.uint64(0xBB67AE8584CAA73B)
_ONE = np.uint64(1)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, bytes of equal weight together, compressed."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def word_key(h: np.ndarray) -> np.ndarray:
    """Keys have 64 bits; those of single words are odd, those of pairs even."""
    return mix(h) | _ONE


def pair_key(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(3) + h + _ONE) & ~_ONE


class Stream:
    """The tokens of some texts in a row: each text's words and then its end."""

    def __init__(self, column: pa.Array):
        hashes, sizes = [], []
        for part in slices(column):
            w = words(part)
            count = np.bincount(w.owner, minlength=len(part))
            h = np.full(len(w.hashes) + len(part), _END)
            h[np.arange(len(w.hashes)) + w.owner] = w.hashes
            hashes.append(h)
            sizes.append(count + 1)
        self.token = np.concatenate([*hashes, np.empty(0, np.uint64)])
        self.sizes = np.concatenate([*sizes, np.empty(0, np.int64)])
        self.ends = np.cumsum(self.sizes)
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        if len(before):
            before[self.ends - self.sizes] = _BEGIN
        self.state = before


def _cut(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty buckets of sorted keys and where each begins, and the end."""
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    opens = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    if len(keys) == 0:
        opens = np.empty(0, np.int64)
    return bucket[opens].astype(np.int32), np.append(opens, len(keys))


def _message(bucket, block, keys, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int32()),
            pa.array(block, pa.int32()),
            pa.array(keys, pa.binary()),
            pa.array(counts, pa.binary()),
        ],
        names=["bucket", "block", "keys", "counts"],
    )


_MESSAGE = "bucket INT, block INT, keys BINARY, counts BINARY"


def _counted(docs: DataFrame, buckets: int, pairs: bool) -> DataFrame:
    """Packed n-gram counts of ``docs`` per task and bucket; ``block`` is NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(
                np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True
            )
            held.clear()
            bucket, at = _cut(keys, buckets)
            spans = list(zip(at[:-1], at[1:], strict=True))
            return _message(
                bucket,
                [None] * len(bucket),
                [pack_keys(keys[a:b]) for a, b in spans],
                [pack(counts[a:b]) for a, b in spans],
            )

        for batch in batches:
            for part in slices(batch.column(0), 4 << 20):
                text = pa.LargeStringArray.from_buffers(
                    len(part),
                    pa.py_buffer(np.ascontiguousarray(part.offsets)),
                    pa.py_buffer(part.data),
                )
                s = Stream(text)
                held.append(word_key(s.token))
                if pairs:
                    held.append(pair_key(s.state, s.token))
                if sum(map(len, held)) > FLUSH_TOKENS:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, _MESSAGE)


def _merge(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([*map(unpack_keys, keys), np.empty(0, np.uint64)])
    number = np.concatenate([*[unpack(c, np.int64) for c in counts], np.empty(0, np.int64)])
    order = np.argsort(every, kind="stable")
    every, number = every[order], number[order]
    opens = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    if len(every) == 0:
        return every, number
    return every[opens], np.add.reduceat(number, opens)


def totals(train: DataFrame, buckets: int) -> tuple[int, int]:
    """Tokens and distinct tokens of the training texts."""

    def run(table: pa.Table) -> pa.Table:
        _, n = _merge(table.column("keys").to_pylist(), table.column("counts").to_pylist())
        return pa.table({"n": pa.array([int(n.sum())]), "v": pa.array([len(n)])})

    row = (
        _counted(train, buckets, pairs=False)
        .groupBy("bucket")
        .applyInArrow(run, "n LONG, v LONG")
        .agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        .first()
    )
    return row["n"] or 0, row["v"] or 0


def _wanted(s: Stream, inverse: bool) -> tuple[np.ndarray, ...]:
    """Distinct keys of the words and arcs that a block meets, sorted; and where each
    token's word, and then its arc, is among them."""
    keys = np.concatenate((word_key(s.token), pair_key(s.state, s.token)))
    return np.unique(keys, return_inverse=True) if inverse else (np.unique(keys),)


def read(
    s: Stream, counts: np.ndarray, place: np.ndarray, n: int, v: int, prior: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log10 weight of the arcs taken at each token, the root's alone, and its count.

    A state is the last word read, so the steps of one pass from left to right are
    known side by side: the state at a token is entered as often as the token before it
    was counted, the begin state as often as texts end.
    """
    size = len(s.token)
    seen, arc = counts[place[:size]], counts[place[size:]]
    root = (seen + 1) / (n + v + 1)
    visits = np.empty(size, np.int64)
    visits[1:] = seen[:-1]
    visits[s.ends - s.sizes] = seen[s.ends - 1]
    failure = prior / (visits + prior)
    step = np.where(arc > 0, arc / (visits + prior) + failure * root, failure * root)
    return np.log10(step), np.log10(root), seen


def scores(
    docs: DataFrame,
    training: Column,
    id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    prior: float = PRIOR,
) -> DataFrame:
    """Scores of all texts by a model of the rows where ``training`` holds.

    Columns: ``id``, ``n_tokens`` (words and one end), ``n_known`` (those seen in
    training), ``train_tokens``, ``base_score`` (single words with one added to each
    count) and ``score`` (the automaton's log10 probability). Words are what stands
    between ASCII white space, with A-Z in lower case. NULL is the empty text: its end
    is its one token. One row per row; texts are shuffled by a hash of
    ``id`` and text, so rows of one id, or without one, are spread.

    Runs two jobs first: the size of all texts, which sets the number of blocks and
    buckets, and the number of tokens and of distinct tokens.
    """
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(text, F.lit("")).alias("t"),
        F.coalesce(training, F.lit(False)).alias("train"),
    )
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    buckets = int(-(-size // block_bytes)) or 1
    train = rows.where("train").select("t")
    n, v = totals(train, buckets)

    blocked = rows.select(
        F.pmod(F.xxhash64("id", "t"), F.lit(buckets)).cast("int").alias("block"), "id", "t"
    )

    def ask(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        s = Stream(table.column("t").combine_chunks())
        (keys,) = _wanted(s, inverse=False)
        bucket, at = _cut(keys, buckets)
        packed = [pack_keys(keys[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        none = [None] * len(packed)
        return pa.Table.from_batches([_message(bucket, [block] * len(packed), packed, none)])

    def answer(table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        keys, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
        known = [i for i, b in enumerate(blocks) if b is None]
        every, number = _merge([keys[i] for i in known], [counts[i] for i in known])
        bucket = table.column("bucket")[0].as_py()
        asked = [i for i, b in enumerate(blocks) if b is not None]
        made = []
        for i in asked:
            wanted = unpack_keys(keys[i])
            found = np.zeros(len(wanted), np.int64)
            if len(every):
                at = np.minimum(np.searchsorted(every, wanted), len(every) - 1)
                found = np.where(every[at] == wanted, number[at], 0)
            made.append(pack(found))
        reply = _message([bucket] * len(made), [blocks[i] for i in asked], [None] * len(made), made)
        return pa.Table.from_batches([reply])

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        s = Stream(texts.column("t").combine_chunks())
        _, place = _wanted(s, inverse=True)
        order = np.argsort(np.asarray(replies.column("bucket")), kind="stable")
        packed = replies.column("counts").to_pylist()
        counts = np.concatenate([unpack(packed[i], np.int64) for i in order])
        step, root, seen = read(s, counts, place, n, v, prior)
        opens = s.ends - s.sizes
        return pa.table(
            {
                "id": texts.column("id"),
                "n_tokens": s.sizes.astype(np.int64),
                "n_known": np.add.reduceat((seen > 0).astype(np.int64), opens),
                "base_score": np.add.reduceat(root, opens),
                "score": np.add.reduceat(step, opens),
            }
        )

    requests = blocked.groupBy("block").applyInArrow(ask, _MESSAGE)
    replies = (
        _counted(train, buckets, pairs=True)
        .union(requests)
        .groupBy("bucket")
        .applyInArrow(answer, _MESSAGE)
    )
    kind = rows.schema["id"].dataType.simpleString()
    found = (
        blocked.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(
            score, f"id {kind}, n_tokens LONG, n_known LONG, base_score DOUBLE, score DOUBLE"
        )
    )
    return found.select(
        F.col("id").alias(id),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
