"""All numeric columns of a table profiled from one read."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import wide
from plumbline.queries.tables import table

COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "sparse",
    "nothing",
)
TARGETS = ["returned"]


def _lines(spark, d):
    """Lines with a target, a column with missing values and one without any value."""
    return table(spark, d, "lineitem").select(
        "*",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.when(F.col("l_linenumber") < 3, F.col("l_quantity")).cast("double").alias("sparse"),
        F.lit(None).cast("double").alias("nothing"),
    )


def _rounded(df):
    """Eight digits: means of whole cents lie on the border of six."""
    return df.withColumns({n: F.round(n, 8) for n, kind in df.dtypes if kind == "double"})


def summaries_of_columns(spark, d):
    return _rounded(wide.numeric_summaries(_lines(spark, d), COLUMNS, TARGETS))


def boxes_of_columns(spark, d):
    return _rounded(wide.numeric_boxes(_lines(spark, d), COLUMNS))


def histograms_of_columns(spark, d):
    lines = _lines(spark, d).select("l_linenumber", "l_quantity", "sparse", "returned")
    columns = ["l_linenumber", "l_quantity", "sparse"]
    return _rounded(wide.numeric_histograms(lines, columns, 7, TARGETS))


QUERIES = {
    f.__name__: f for f in (summaries_of_columns, boxes_of_columns, histograms_of_columns)
}

_LINES = """WITH lines AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
    CASE WHEN l_linenumber < 3 THEN l_quantity END AS sparse, NULL::DOUBLE AS nothing
  FROM lineitem)"""


def _long(columns) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value, returned FROM lines" for c in columns
    )
    return f"{_LINES}, long AS ({parts})"


_QUARTILES = ", ".join(
    f"quantile_cont(value, {q}) AS q{i}" for i, q in ((1, 0.25), (2, 0.5), (3, 0.75))
)
_BOXES = f"""{_long(COLUMNS)},
q AS (
  SELECT "column", count(value) AS count, avg(value) AS mean, {_QUARTILES}
  FROM long GROUP BY 1 HAVING count(value) > 0),
fenced AS (
  SELECT *, q1 - (q3 - q1) * 1.5 AS low_fence, q3 + (q3 - q1) * 1.5 AS high_fence FROM q),
ends AS (
  SELECT f."column", min(value) FILTER (value BETWEEN low_fence AND high_fence) AS least,
    max(value) FILTER (value BETWEEN low_fence AND high_fence) AS largest,
    count(*) FILTER (value < low_fence OR value > high_fence) AS outliers
  FROM long l JOIN fenced f ON l."column" = f."column" GROUP BY 1)
SELECT "column", count, round(mean, 8) AS mean, round(q1, 8) AS q1, round(q2, 8) AS q2,
  round(q3, 8) AS q3, round(low_fence, 8) AS low_fence, round(high_fence, 8) AS high_fence,
  round(least(coalesce(least, q1), q1), 8) AS whisker_low,
  round(greatest(coalesce(largest, q3), q3), 8) AS whisker_high, outliers
FROM fenced JOIN ends USING ("column")"""

SQL = {
    "summaries_of_columns": f"""{_long(COLUMNS)}, q AS (
  SELECT "column", count(value) AS count, count(*) - count(value) AS missing,
    avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
    {_QUARTILES}, avg(returned) FILTER (value IS NOT NULL) AS returned_mean,
    stddev_samp(returned) FILTER (value IS NOT NULL) AS returned_std
  FROM long GROUP BY 1)
SELECT "column", count, missing, round(mean, 8) AS mean, round(std, 8) AS std,
  round(min, 8) AS min, round(max, 8) AS max, round(q1, 8) AS q1, round(q2, 8) AS q2,
  round(q3, 8) AS q3, round(returned_mean, 8) AS returned_mean,
  round(returned_std, 8) AS returned_std FROM q""",
    "boxes_of_columns": _BOXES,
    "histograms_of_columns": f"""{_long(["l_linenumber", "l_quantity", "sparse"])},
ends AS (
  SELECT "column", min(value) AS a, (max(value) - min(value)) / 7 AS width FROM long GROUP BY 1),
placed AS (
  SELECT "column", a, width, least(floor((value - a) / width), 6)::INT AS bin, returned
  FROM long JOIN ends USING ("column") WHERE value IS NOT NULL)
SELECT "column", bin, count(*) AS count, round(avg(returned), 8) AS returned_mean,
  round(any_value(a + bin * width), 8) AS low, round(any_value(a + (bin + 1) * width), 8) AS high
FROM placed GROUP BY "column", bin""",
}
