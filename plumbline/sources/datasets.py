"""Named datasets with declared schemas, and the readers and sinks that use them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from plumbline.functions.columns import decode_escapes

# Field separator of the raw text files and their columns.
SEPARATOR = "::"
RAW_USERS = "user_id LONG, gender STRING, age INT, occupation INT, zip STRING"
RAW_MOVIES = "movie_id LONG, title STRING, genres STRING"
RAW_RATINGS = "user_id LONG, movie_id LONG, rating INT, timestamp LONG"


@dataclass(frozen=True)
class DatasetSpec:
    """Where a table lies and how to read it."""

    path: str
    format: str = "parquet"
    schema: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    #: Whether texts hold backslash escapes that stand for characters.
    escaped: bool = False


def delimited(
    path: str, schema: str, encoding: str = "UTF-8", escaped: bool = False
) -> DatasetSpec:
    """Headerless text with a multi-character separator.

    With ``escaped`` a backslash is a character like others to the scan, and escapes are
    decoded behind it.
    """
    options = {"sep": SEPARATOR, "encoding": encoding}
    if escaped:
        options |= {"escape": "", "quote": ""}
    return DatasetSpec(path, "csv", schema, options, escaped)


# Fixed values below: folder and file names of the stored tables.


def training_datasets(root: str) -> dict[str, DatasetSpec]:
    return {**_raw(root), **_processed(root), **_splits(root)}


def inference_datasets(root: str) -> dict[str, DatasetSpec]:
    return {
        **_raw(root),
        **_processed(root),
        **_splits(root),
        "model_input": DatasetSpec(f"{root}/04_inference_model_input_data/inference.parquet"),
        "model_output": DatasetSpec(f"{root}/05_inference_model_output_data/inference.parquet"),
    }


def _raw(root: str) -> dict[str, DatasetSpec]:
    folder = f"{root}/01_raw_data"
    return {
        "raw_users": delimited(f"{folder}/users.dat", RAW_USERS),
        "raw_movies": delimited(f"{folder}/movies.dat", RAW_MOVIES, "ISO-8859-1", escaped=True),
        "raw_ratings": delimited(f"{folder}/ratings.dat", RAW_RATINGS),
    }


def _processed(root: str) -> dict[str, DatasetSpec]:
    folder = f"{root}/02_processed_data"
    return {
        "users": DatasetSpec(f"{folder}/users_processed.parquet"),
        "movies": DatasetSpec(f"{folder}/movies_processed.parquet"),
        "numbered_ratings": DatasetSpec(f"{folder}/numbered_ratings.parquet"),
        "ratings": DatasetSpec(f"{folder}/processed_ratings.parquet"),
    }


def _splits(root: str) -> dict[str, DatasetSpec]:
    folder = f"{root}/03_train_val_test_data"
    return {name: DatasetSpec(f"{folder}/{name}.parquet") for name in ("train", "val", "test")}


def read(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    """Read with the declared schema; escapes become their characters.

    Stored tables hold no NaN, see :func:`write`, so filters on them reach the files; in
    raw text NaN becomes NULL here.
    """
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    df = reader.load(spec.path)
    if spec.format != "parquet":
        df = nan_as_null(df)
    if spec.escaped:
        texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
        df = df.withColumns({c: decode_escapes(c) for c in texts})
    return df


def nan_as_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def write(df: DataFrame, spec: DatasetSpec) -> None:
    """Replace the table; float NaN is stored as NULL."""
    nan_as_null(df).write.mode("overwrite").format(spec.format).options(**spec.options).save(spec.path)


def written(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Write a table and go on from the stored copy, with a short lineage."""
    write(df, spec)
    return df.sparkSession.read.format(spec.format).load(spec.path)


def write_metric_csv(metrics: DataFrame, path: str) -> None:
    """One CSV file with a header; for metric tables, which have one row per k."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
