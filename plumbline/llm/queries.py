"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import (
    automaton,
    chosen_path,
    decontamination,
    digest,
    hyperlang,
    neighbours,
    paragraphs,
    passages,
    periodic,
    pieces,
    pii,
    quality,
    segments,
    token_counts,
    variants,
)
from plumbline.llm.binding import let

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id: str, folds: int) -> Column:
    """Remainder of the id's checksum; a NULL id is in fold 0."""
    checksum = F.crc32(F.col(id).cast("string").cast("binary")) % folds
    return F.coalesce(checksum, F.lit(0)).cast("int")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.token_counts(docs, path)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.contaminated(docs, benchmark)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = quality.train(docs, labels.where(fold("doc_id", 4) != 2))
    return quality.score(docs, model).select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op4_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edit_check(table(spark, sf_dir, "documents"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), digest=True)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.spans(F.col("text"), pii.train(docs)).alias("found"))
    base = F.filter("found", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.BASE],
        F.sha2(pii.written(base).cast("binary"), 256).alias("base_sha256"),
        pii.written(F.col("found")).alias("spans"),
    )


def op7_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return automaton.scores(docs, fold("doc_id", 7) != 2).select(
        "doc_id",
        (fold("doc_id", 7) == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages, prototypes = hyperlang.train(docs.where(fold("doc_id", 4) != 2))
    return hyperlang.predict(docs, languages, prototypes).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines, and passages inside and across lines, whose ``line`` is NULL."""
    docs = table(spark, sf_dir, "documents")
    lines = paragraphs.repeated_paragraphs(docs)
    passages = segments.repeated_segments(docs).withColumn("line", F.lit(None).cast("int"))
    return lines.unionByName(passages.select(*lines.columns))


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op10_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.similar_documents(table(spark, sf_dir, "documents"))


def _made_periodic(id: Column, text: Column) -> Column:
    """The text of one id in ten with its words from some place on replaced by a cycle."""
    h = F.crc32(id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def cycle(words: Column, n: Column) -> Column:
        start = g % n
        period = 1 + F.floor((n - start) / (3 + g % 8))

        def turned(at: Column) -> Column:
            def source(i: Column) -> Column:
                return F.when(i < at["start"], i).otherwise(
                    at["start"] + (i - at["start"]) % at["period"]
                )

            places = F.sequence(F.lit(0).cast("long"), n - 1)
            picked = F.transform(places, lambda i: F.get(words, source(i).cast("int")))
            return F.array_join(picked, " ")

        return let(F.struct(start.alias("start"), period.alias("period")), turned)

    def changed(words: Column) -> Column:
        n = F.size(words).cast("long")
        return F.when(n > 0, cycle(words, n)).otherwise(text)

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, changed)).otherwise(text)


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = docs.select("doc_id", _made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic.periodic_runs(made)
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    lines = F.transform(
        "runs",
        lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")),
    )
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = variants.word_counts(
        table(spark, sf_dir, "documents"), rewrite=variants.drop_letter
    )
    frequent = counts.where(
        (F.char_length("word") >= variants.MIN_LETTERS) & (F.col("n") >= variants.MIN_COUNT)
    )
    return variants.spelling_variants(frequent)


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_digest": op4_digest,
    "op5_pieces": op5_pieces,
    "op6_pii": op6_pii,
    "op7_automaton": op7_automaton,
    "op8_language": op8_language,
    "op9_paragraphs": op9_paragraphs,
    "op9_passages": op9_passages,
    "op10_chosen_path": op10_chosen_path,
    "op11_periodic": op11_periodic,
    "op12_variants": op12_variants,
    "op13_neighbours": op13_neighbours,
}

#: Tokenizers, models, digests and MinHash have no SQL; tests/llm holds them against brute force.
SQL: dict[str, str] = {}
