"""A corpus pipeline: language, near copies, benchmark passages, personal data, pieces.

Every stage is a function (spark, docs, sf_dir) that returns a DataFrame; it is
written as Parquet in the shared folder and read again as the next stage's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import chosen_path, decontamination, hyperlang, pieces, pii
from plumbline.llm.storage import Stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: those without letters, and all where no
    labelled row teaches a language. Fill in a NULL ``lang``."""
    languages, prototypes = hyperlang.train(docs)
    told = hyperlang.predict(docs, languages, prototypes, keep=COLUMNS)
    return told.where(F.col("lang_pred") != hyperlang.UNDETERMINED).select(
        "doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars"
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a number of their own: ids may be NULL, or repeated with another text.

    ``docs`` is a stored table, whose rows get the same numbers whenever it is read.
    """
    return docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row of each class of near copies.

    A row is judged by its own text, whatever rows share its id. Of rows with the same id
    and text one stays, also without words.
    """
    rows = _numbered(docs)
    told = chosen_path.similar_documents(rows, id="row")
    gone = told.where(F.col("class_id") != F.col("row")).select("row")
    # Texts without words are in no class.
    worded = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = rows.where(worded).join(gone, "row", "left_anti").select(*COLUMNS)
    wordless = rows.where(~worded).select(*COLUMNS).dropDuplicates(["doc_id", "text"])
    return kept.union(wordless)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark, each row by its own text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _numbered(docs)
    found = decontamination.contaminated(rows, benchmark, id="row")
    return rows.join(found.select("row").distinct(), "row", "left_anti").select(*COLUMNS)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows."""
    model = pii.train(docs)
    text = pii.redacted(F.col("text"), pii.spans(F.col("text"), model))
    return docs.select("doc_id", text.alias("text"), "lang", "source").select(
        "doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars")
    )


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, their number, and whether decoding gives the text back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = pieces.encode(docs, path, keep=("doc_id", "lang", "source", "text"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("restored"),
    )


STAGES = [
    ("language", by_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", redacted),
    ("pieces", as_pieces),
]

#: SQL has no language profiles and no tokenizer; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir)).frame
    return docs
