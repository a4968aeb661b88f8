"""Jobs, sources and saved state: written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from plumbline.functions.columns import epoch_seconds
from plumbline.operators.encoders import (
    FrequencyEncode,
    FrequencyEncodeModel,
    StandardScale,
    StandardScaleModel,
)
from plumbline.plans import data_jobs, profiles
from plumbline.queries.tables import SALES_SQL, rounded, sales, table
from plumbline.settings import ProcessingSettings
from plumbline.sources.datasets import RAW_MOVIES, delimited, read, training_datasets, write
from plumbline.sources.state import load_settings, load_table, save_state, shared_folder
from plumbline.sources.trials import append_trials, read_trials


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/plumbline-{uuid.uuid4().hex}"


def _movies(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.concat("p_name", F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")")).alias(
            "title"
        ),
        F.col("p_type").alias("genres"),
    )


def delimited_text(spark, d):
    """Written and read as ``::`` text in a one-byte encoding."""
    spec = delimited(f"{_folder(spark)}/movies.dat", RAW_MOVIES, "ISO-8859-1")
    write(_movies(spark, d), spec)
    return read(spark, spec)


def movies_with_year(spark, d):
    return data_jobs.process_movies(_movies(spark, d), ProcessingSettings())


def encoders_from_state(spark, d):
    """Scaler and categories fitted, saved, loaded and applied."""
    df = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    folder = _folder(spark)
    tables = {
        "scaler": StandardScale(["c_acctbal"]).fit(df).state,
        "categories": FrequencyEncode(["c_mktsegment"]).fit(df).state,
    }
    save_state(spark, folder, tables, '{"columns": ["c_acctbal", "c_mktsegment"]}')
    scaled, coded = load_settings(spark, folder)["columns"]
    scaler = StandardScaleModel([scaled], load_table(spark, folder, "scaler"))
    categories = FrequencyEncodeModel([coded], load_table(spark, folder, "categories"))
    return rounded(categories.transform(scaler.transform(df)), "c_acctbal")


def encoders_in_pipeline(spark, d):
    """A pipeline of scaler and categories: fitted, saved, loaded and applied."""
    df = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    folder = _folder(spark)
    stages = [StandardScale(["c_acctbal"]), FrequencyEncode(["c_mktsegment"])]
    Pipeline(stages=stages).write().save(f"{folder}/unfitted")
    fitted = Pipeline.load(f"{folder}/unfitted").fit(df)
    fitted.write().save(f"{folder}/fitted")
    return rounded(PipelineModel.load(f"{folder}/fitted").transform(df), "c_acctbal")


def escaped_text(spark, d):
    """Titles written with escapes for some of their characters, and read back decoded."""
    path = f"{_folder(spark)}/escaped.dat"
    escapes = F.create_map(
        F.lit(0), F.lit(r"\x41"), F.lit(1), F.lit(r"\u00e9"), F.lit(2), F.lit(r"\101"),
        F.lit(3), F.lit(r"\ud83d\ude00"), F.lit(4), F.lit(r"\\n"), F.lit(5), F.lit(r"\t"),
        F.lit(6), F.lit(r"\q"), F.lit(7), F.lit("a \"plain\" one"),
    )
    parts = table(spark, d, "part")
    title = F.concat("p_name", F.lit(" "), escapes[F.col("p_partkey").cast("int") % 8])
    lines = parts.select(F.concat_ws("::", "p_partkey", title, "p_type"))
    lines.write.text(path)
    return read(spark, delimited(path, RAW_MOVIES, "ISO-8859-1", escaped=True))


def training_job_labels(spark, d):
    """The first job from raw text to labelled ratings, counted by label."""
    data = training_datasets(_folder(spark))
    lines, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    ratings = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").cast("int").alias("rating"),
        epoch_seconds("o_orderdate").alias("timestamp"),
    )
    users = table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.substring("c_mktsegment", 1, 1).alias("gender"),
        F.col("c_nationkey").alias("age"),
        F.col("c_nationkey").alias("occupation"),
        F.col("c_name").alias("zip"),
    )
    write(users, data["raw_users"])
    write(_movies(spark, d), data["raw_movies"])
    write(ratings, data["raw_ratings"])
    return data_jobs.process_training_data(spark, data, ProcessingSettings())


def feature_summary(spark, d):
    tables = profiles.numeric_feature(sales(spark, d), "l_quantity", ["target"])
    columns = ["mean", "std", "q1", "q2", "q3", "target_mean", "target_std"]
    return rounded(tables["summary"], *columns)


def feature_top_values(spark, d):
    tables = profiles.categorical_feature(sales(spark, d), "l_returnflag", ["target"])
    return rounded(tables["top"], "share")


def label_profile_rate(spark, d):
    return rounded(profiles.label_profile(sales(spark, d), "target", "month")["rate"], "rate")


def trial_log(spark, d):
    """Months as trials of a run per return flag; some are logged twice and stay one row."""
    path = _folder(spark)
    means = sales(spark, d).groupBy("l_returnflag", F.substring("month", 1, 4).alias("year")).agg(
        F.avg("l_quantity").alias("metric"), F.count(F.lit(1)).cast("int").alias("n")
    )
    logged = means.select(
        F.concat(F.lit("run "), "l_returnflag").alias("run"),
        F.col("year").cast("int").alias("trial"),
        F.create_map(F.lit("year"), "year").alias("params"),
        F.lit("mean_quantity").alias("metric_name"),
        "metric",
        F.lit(0.0).alias("training_time"),
        F.col("n").alias("best_iteration"),
    )
    append_trials(logged.withColumn("metric", F.lit(-1.0)).where("trial % 2 = 0"), path)
    append_trials(logged, path)
    append_trials(logged.where("trial % 3 = 0"), path)
    back = read_trials(spark, path)
    year = F.col("params")["year"].alias("year")
    return rounded(back.select("run", "trial", year, "metric_name", "metric", "best_iteration"), "metric")


QUERIES = {
    f.__name__: f
    for f in (
        delimited_text,
        trial_log,
        movies_with_year,
        encoders_from_state,
        encoders_in_pipeline,
        escaped_text,
        training_job_labels,
        feature_summary,
        feature_top_values,
        label_profile_rate,
    )
}

_MOVIES = """WITH movies AS (
  SELECT p_partkey AS movie_id, p_name || ' (' || (p_size + 1950)::VARCHAR || ')' AS title,
    p_type AS genres, (p_size + 1950)::VARCHAR AS year FROM part)"""

SQL = {
    "trial_log": f"""WITH {SALES_SQL}
SELECT 'run ' || l_returnflag AS run, month[1:4]::INT AS trial, month[1:4] AS year,
  'mean_quantity' AS metric_name, round(avg(l_quantity), 6) AS metric,
  count(*)::INT AS best_iteration
FROM sales GROUP BY l_returnflag, month[1:4]""",
    "delimited_text": f"{_MOVIES} SELECT movie_id, title, genres FROM movies",
    "movies_with_year": f"{_MOVIES} SELECT movie_id, title, year FROM movies",
    "encoders_from_state": """
WITH s AS (
  SELECT c_mktsegment AS value, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS id
  FROM customer GROUP BY 1)
SELECT c_custkey, round((c_acctbal - m) / d, 6) AS c_acctbal, s.id::INT AS c_mktsegment
FROM customer JOIN s ON c_mktsegment = s.value,
  (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d FROM customer)""",
    "escaped_text": r"""
SELECT p_partkey AS movie_id, p_name || ' ' ||
  ['A', 'é', 'A', '😀', '\n', chr(9), '\q', 'a "plain" one'][1 + p_partkey % 8] AS title,
  p_type AS genres FROM part""",
    "training_job_labels": """
WITH r AS (
  SELECT o_custkey AS u, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
free AS (
  SELECT u, (SELECT count(DISTINCT i) FROM r) - count(DISTINCT i) AS free FROM r GROUP BY 1)
SELECT 1 AS label, count(*) AS count FROM r
UNION ALL SELECT 0, sum(least(free, 5))::BIGINT FROM r JOIN free USING (u)""",
    "feature_summary": f"""WITH {SALES_SQL}
SELECT count(l_quantity) AS count, count(*) - count(l_quantity) AS missing,
  round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
  min(l_quantity) AS min, max(l_quantity) AS max,
  round(quantile_cont(l_quantity, 0.25), 6) AS q1, round(quantile_cont(l_quantity, 0.5), 6) AS q2,
  round(quantile_cont(l_quantity, 0.75), 6) AS q3,
  round(avg(target), 6) AS target_mean, round(stddev_samp(target), 6) AS target_std
FROM sales""",
    "feature_top_values": f"""WITH {SALES_SQL}
SELECT l_returnflag AS value, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sales), 6) AS share
FROM sales GROUP BY 1 ORDER BY count DESC, value LIMIT 3""",
    "label_profile_rate": f"""WITH {SALES_SQL}
SELECT month, round(avg(target), 6) AS rate FROM sales GROUP BY 1""",
}

SQL["encoders_in_pipeline"] = SQL["encoders_from_state"]
