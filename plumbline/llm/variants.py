"""Spelling variants: words one edit apart, grouped under their most frequent form.

Near words are found by asymmetric chunks. A word of length m gives two disjoint chunks
of q = m // 2 letters; the other word gives its positional grams of that length. One
edit leaves one chunk whole: the first one in its place, or the second one moved by
what the words differ in length, one place at most. Grams anywhere else can meet no
chunk and are not made, so a word gives a fixed number of them, however long it is.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.storage import Stored

MIN_LETTERS = 5
MIN_COUNT = 3
#: A form is at least so many times as frequent as the words that it stands for.
RATIO = 2
#: Distinct words that a task counts before it passes its counts on.
HELD_WORDS = 1 << 18

#: Bytes of Latin-1: letters stay, A-Z in lower case; all others separate words.
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)

Rewrite = Callable[[bytes, bytes], bytes]


def words_of(text: str) -> list[bytes]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF in Latin-1, with A-Z in lower case."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def drop_letter(id: bytes, word: bytes) -> bytes:
    """The word without one letter where 97 divides the checksum of ``id:word``."""
    plain = word if word.isascii() else word.decode("latin-1").encode()
    h = zlib.crc32(plain, zlib.crc32(id + b":"))
    if h % 97:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame, id: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """``word`` and ``n``, its occurrences in all whole texts. A NULL text has no words.

    ``rewrite`` takes a row's id and a word, as bytes, and returns the word to count; a
    NULL id is empty. Texts are counted one by one and added up in each task before
    the shuffle, so a word found everywhere is one row for each task.
    """

    def passed_on(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        made = pa.RecordBatch.from_arrays(
            [words, pa.array(held.values(), pa.int64())], names=["word", "n"]
        )
        held.clear()
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for name, t in zip(batch.column(0), batch.column(1), strict=True):
                counts = Counter(words_of(t.as_py()))
                if rewrite is None:
                    held.update(counts)
                else:
                    key = name.as_py().encode()
                    for word, n in counts.items():
                        held[rewrite(key, word)] += n
                if len(held) > HELD_WORDS:
                    yield passed_on(held)
        yield passed_on(held)

    rows = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    counted = rows.mapInArrow(run, "word STRING, n LONG")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("word") != "")


def _slot(length: Column, slot: int, gram: Column) -> Column:
    return F.struct(length.alias("length"), F.lit(slot).alias("slot"), gram.alias("gram"))


def _chunks(word: Column, length: Column) -> Column:
    q = F.expr("length div 2").cast("int")
    return F.array(
        _slot(length, 0, F.substr(word, F.lit(1), q)), _slot(length, 1, F.substr(word, q + 1, q))
    )


def _grams(word: Column) -> Column:
    """Grams of ``word`` where a word as long, or one letter shorter, has its chunks."""
    made = []
    for more in (0, 1):
        other = F.expr(f"length - {more}")
        q = F.expr(f"(length - {more}) div 2").cast("int")
        made += [
            _slot(other, 0, F.substr(word, F.lit(1), q)),
            _slot(other, 1, F.substr(word, q + 1 + more, q)),
        ]
    return F.array(*made)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``other`` and ``other_n`` for every two words that differ by exactly one
    inserted, deleted or replaced letter, in both directions.

    ``words`` has distinct words of two letters or more, and ``n``.
    """
    sized = words.select("word", "n", F.char_length("word").alias("length"))
    chunks = sized.select(
        F.col("word").alias("other"),
        F.col("n").alias("other_n"),
        F.inline(_chunks(F.col("word"), F.col("length"))),
    )
    grams = sized.select(
        "word", "n", F.col("length").alias("own"), F.inline(_grams(F.col("word")))
    )
    # Of two words as long as each other the smaller one gives the grams.
    once = (F.col("own") > F.col("length")) | (F.col("word") < F.col("other"))
    met = grams.join(chunks, ["length", "slot", "gram"]).where(
        once & (F.levenshtein("word", "other", 1) == 1)
    )
    pairs = met.select("word", "n", "other", "other_n").distinct()
    both = F.array(
        F.struct("word", "other", "other_n"),
        F.struct(
            F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")
        ),
    )
    return pairs.select(F.inline(both))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word with its most frequent near word, if that is frequent enough.

    ``words`` has distinct words and their counts ``n``. Result: ``word``, ``form`` (the near
    word with the largest n, ties to the smallest in code-point order, if its n is at
    least ``ratio`` times the word's; else NULL), ``root`` (where following forms ends;
    the word itself without a form), ``n``, ``n_near`` and ``form_n``. A word without near
    words has ``n_near`` 0; an empty table gives an empty one. Forms get more frequent with
    each step, so there is no circle, and paths are as long as the logarithm of the
    largest count; they are halved in each round. Runs a job for the near words and one
    for each round; tables are written to the shared folder.
    """
    stored = Stored(words.select("word", "n")).frame
    best = near_words(stored).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"),
    )
    enough = -F.col("best.n") >= ratio * F.col("n")
    forms = Stored(
        stored.join(best, "word", "left").select(
            "word",
            F.when(enough, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, -F.col("best.n")).alias("form_n"),
        )
    ).frame
    roots = _roots(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame) -> DataFrame:
    """The end of each word's path of links, by doubling the steps taken."""
    now = Stored(links)
    while True:
        paths = now.frame.select("word", "root")
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = paths.join(onward, "root", "left")
        after = Stored(joined.select("word", F.coalesce("next", "root").alias("root"), "next"))
        moved = not after.frame.where(F.col("next").isNotNull()).isEmpty()
        now.drop()
        now = after
        if not moved:
            return now.frame.drop("next")
