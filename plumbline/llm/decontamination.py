"""Benchmark decontamination by template windows, in DataFrame functions only.

A text becomes a row of tokens; numbers, names and units become typed
placeholders that remember their value. Windows of templates are joined by hash, so
a question with other numbers or names still matches. The values that take each
other's place must then agree: one value of the item always stands for one value in
the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.binding import let
from plumbline.llm.storage import Stored

WINDOW = 8
COVERAGE = 0.5
CONSISTENT = 0.8
#: Hits of one occurrence have document positions that shift by at most so many tokens
#: against the item's, from one to the next: values may have more words than others.
SLACK = 3
#: Windows of the benchmark up to this number travel as a broadcast; more are shuffled.
BROADCAST_WINDOWS = 200_000

# Units that count as such after a number.
UNITS = (
    "mm cm m km in ft mi mg g kg t lb oz ml l s sec min h hr hrs day days week weeks month months "
    "year years second seconds minute minutes hour hours meter meters metre metres mile miles foot "
    "feet inch inches gram grams liter liters litre litres pound pounds dollar dollars cent cents "
    "euro euros percent degree degrees"
).split()
_WORD = r"[\p{L}\p{M}]"
_FIGURE = r"\p{N}++(?:[.,]\p{N}++)*+"
#: Placeholders: a token with a value begins with the mark of its kind.
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
# A capital that opens a word and stands up to eight signs, none of them a sentence
# end, behind a letter or figure.
_NAME = r"(?=\p{Lu})(?<![\p{L}\p{M}])(?<=[\p{L}\p{M}\p{N}][^\p{L}\p{M}\p{N}.!?\n]{1,8})"
_UNIT = rf"({NUMBER}[\p{{N}}.,]{{1,24}}+\s?)(?=(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{M}}]))"
_TOKEN = rf"[{NAME}{UNIT}]?+{_WORD}++|{NUMBER}{_FIGURE}"


def tokens(text: Column) -> Column:
    """The text's words and figures in lower case; names, figures and units are marked.

    A name is a capitalised word that does not open a sentence; a unit follows a
    figure of up to 24 signs.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[\x01-\x03]", " ")
    named = F.lower(F.regexp_replace(plain, _NAME, NAME))

    def counted(t: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(t, _FIGURE, NUMBER + "$0"), _UNIT, "$1" + UNIT)

    marked = let(named, lambda t: F.when(t.rlike(r"\p{N}"), counted(t)).otherwise(t))
    return F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0))


def windows(
    df: DataFrame, keys: list[str], text: str, size: int = WINDOW, literal: bool = False
) -> DataFrame:
    """``keys`` with ``at``, ``hash`` and ``slots`` (marked values in order) of every window.

    A text with fewer tokens, but some, has one window of all of them. ``literal`` adds
    ``n``, the window's number of tokens, and ``exact``, the hash of the tokens without marks.
    """

    def every(h: Column, v: Column, found: Column) -> Column:
        last = F.greatest(F.size(h) - size, F.lit(0))
        return F.transform(
            F.when(F.size(h) > 0, F.sequence(F.lit(0), last)),
            lambda i: F.struct(
                i.alias("at"),
                F.xxhash64(F.slice(h, i + 1, F.lit(size))).alias("hash"),
                F.array_join(F.slice(v, i + 1, F.lit(size)), "").alias("slots"),
                *plain(F.slice(found, i + 1, F.lit(size))),
            ),
        )

    def plain(some: Column) -> list[Column]:
        if not literal:
            return []
        bare = F.transform(some, lambda x: F.regexp_replace(x, "[\x01-\x03]", ""))
        return [F.size(some).alias("n"), F.xxhash64(bare).alias("exact")]

    def of(found: Column) -> Column:
        # Marks sort before letters and figures.
        marked = F.lit("\x04")
        hashes = F.transform(
            found, lambda x: F.xxhash64(F.when(x < marked, F.left(x, F.lit(1))).otherwise(x))
        )
        values = F.transform(found, lambda x: F.when(x < marked, x).otherwise(""))
        return let(hashes, lambda h: let(values, lambda v: every(h, v, found)))

    made = let(tokens(F.col(text)), of)
    each = df.select(*keys, F.explode(made).alias("__w"))
    return each.select(*keys, "__w.*")


def _values(slots: Column) -> Column:
    """The marked values of a window."""
    return F.regexp_extract_all(slots, F.lit("[\x01-\x03][^\x01-\x03]*"), F.lit(0))


def _occurrences(hits: DataFrame, pair: list[str]) -> DataFrame:
    """Every hit once for each ``way`` to judge it together with others, and its ``part``.

    All hits of a pair; its verbatim hits; those at one shift against the item, up to
    ``SLACK`` from each to the next; and those in a row whose item position does not
    fall back by more than ``SLACK``.
    """
    own = Window.partitionBy(*pair)
    shift = F.col("at") - F.col("__item_at")
    by_shift, by_place = own.orderBy("shift"), own.orderBy("at", "__item_at")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    told = (
        hits.withColumn("shift", shift)
        .withColumn("jump", (F.col("shift") - F.lag("shift").over(by_shift) > SLACK).cast("int"))
        .withColumn(
            "back",
            (F.lag("__item_at").over(by_place) - F.col("__item_at") > SLACK).cast("int"),
        )
        .withColumn("aligned", F.sum(F.coalesce("jump", F.lit(0))).over(by_shift.rowsBetween(*so_far)))
        .withColumn("run", F.sum(F.coalesce("back", F.lit(0))).over(by_place.rowsBetween(*so_far)))
    )
    verbatim = F.when(F.col("slots") == F.col("__item_slots"), 0).cast("long")
    ways = [F.lit(0).cast("long"), verbatim, F.col("aligned"), F.col("run")]
    return told.select(
        *pair, "hash", "__item_slots", "slots", "at", F.posexplode(F.array(*ways)).alias("way", "part")
    ).where(F.col("part").isNotNull())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    coverage: float = COVERAGE,
    consistent: float = CONSISTENT,
) -> DataFrame:
    """One row per document and benchmark item whose passage the document holds.

    Columns: ``id``, ``item``, ``n_windows`` of the item, ``n_matched`` of them found,
    their share ``coverage``, the share ``consistency`` of the item's slot values that
    have one single value (1 without slots), ``reparameterised`` (a value differs) and
    ``first_token`` of the match. A row needs at least ``coverage`` and ``consistent``.
    A document may hold several versions of an item: these are judged over all its hits,
    over the verbatim ones, and over each occurrence, by aligned positions and by runs
    in which the item's position does not fall back. The best that passes is told. Windows that are mostly placeholders say little as
    templates: they match only with their own values. Rows with the same id count as one document; NULL and empty texts match
    nothing; an item shorter than a window is found where a document holds all its
    tokens in a row, or where a whole document has its template.

    The benchmark's windows are counted first (one small job): up to
    ``BROADCAST_WINDOWS`` they are broadcast and documents are not shuffled before the
    match; more of them are joined by a shuffle of window hashes.
    """
    keyed = benchmark.select(F.col(item).alias("__item"), F.col(item_text).alias("__text"))
    # The same item may be listed twice: windows of one item at one place count once.
    each = windows(keyed.distinct(), ["__item"], "__text", size, literal=True).withColumn(
        "dense", F.regexp_count("slots", F.lit("[\x01-\x03]")) * 2 > size
    )
    own = each.withColumn("hash", F.when(F.col("dense"), F.col("exact")).otherwise(F.col("hash")))
    totals = own.groupBy("__item").agg(F.countDistinct("hash").alias("n_windows"))
    known = (
        own.where(~F.col("dense"))
        .groupBy("__item", "hash", F.col("slots").alias("__item_slots"))
        .agg(F.min("at").alias("__item_at"))
    )
    by_words = (
        own.where(F.col("dense") | (F.col("n") < size))
        .groupBy("__item", "hash", "exact", "n")
        .agg(F.min("at").alias("__item_at"))
    )
    sizes = {r["n"]: r["count"] for r in by_words.groupBy("n").count().collect()}
    wanted = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    columns = ["__id", "__item", "hash", "__item_slots", "__item_at", "slots", "at"]

    def small(side: DataFrame, n: int) -> DataFrame:
        return F.broadcast(side) if n <= BROADCAST_WINDOWS else side

    met = windows(wanted, ["__id"], "__text", size).join(small(known, known.count()), "hash")
    met = met.select(*columns)
    # Only a benchmark with such items has the documents' windows made by their words too.
    for n, count in sorted(sizes.items()):
        side = by_words.where(F.col("n") == n).drop("n").withColumn("__item_slots", F.lit(""))
        there = windows(wanted, ["__id"], "__text", n, literal=True).drop("hash", "slots", "n")
        said = there.join(small(side, count), "exact").withColumn("slots", F.lit(""))
        met = met.union(said.select(*columns))
    # Stored: the few windows that match are read twice, the documents once for each size.
    hits = Stored(met.distinct()).frame
    pair = ["__id", "__item"]
    grouped = [*pair, "way", "part"]
    each = _occurrences(hits, pair)
    matched = each.groupBy(*grouped).agg(
        F.countDistinct("hash").alias("n_matched"), F.min("at").alias("first_token")
    )
    slots = each.where(F.col("slots") != "").select(
        *grouped,
        F.explode(F.arrays_zip(_values(F.col("__item_slots")), _values(F.col("slots")))).alias("z"),
    )
    agreed = (
        slots.groupBy(*grouped, F.col("z")["0"].alias("own"))
        .agg(
            F.countDistinct(F.col("z")["1"]).alias("n"),
            F.max((F.col("z")["1"] != F.col("z")["0"]).cast("int")).alias("other"),
        )
        .groupBy(*grouped)
        .agg(
            F.avg((F.col("n") == 1).cast("double")).alias("consistency"),
            F.max("other").alias("other"),
        )
    )
    matched = matched.join(totals, "__item").where(
        F.col("n_matched") >= coverage * F.col("n_windows")
    )
    same = matched["__id"].eqNullSafe(agreed["__id"])
    for name in grouped[1:]:
        same = same & (matched[name] == agreed[name])
    judged = matched.join(agreed, same, "left").select(
        matched["__id"],
        matched["__item"],
        "n_windows",
        "n_matched",
        F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
        F.coalesce("other", F.lit(0)).alias("other"),
        "first_token",
    )
    rank = F.struct(
        (-F.col("n_matched")).alias("n"), (-F.col("consistency")).alias("c"), "other", "first_token"
    )
    best = (
        judged.where(F.col("consistency") >= consistent)
        .groupBy(*pair, "n_windows")
        .agg(F.min(rank).alias("best"))
    )
    n_matched = -F.col("best.n")
    return best.select(
        F.col("__id").alias(id),
        F.col("__item").alias(item),
        "n_windows",
        n_matched.alias("n_matched"),
        (n_matched / F.col("n_windows")).alias("coverage"),
        (-F.col("best.c")).alias("consistency"),
        (F.col("best.other") == 1).alias("reparameterised"),
        F.col("best.first_token").alias("first_token"),
    )
