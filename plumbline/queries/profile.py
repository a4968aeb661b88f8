"""Counts, summaries and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.columns import (
    capture,
    epoch_seconds,
    epoch_to_timestamp,
    month_text,
    percent_label,
)
from plumbline.functions.frames import first_rows
from plumbline.operators import binning, counts, summaries
from plumbline.plans import profiles
from plumbline.queries.tables import SALES_SQL, finite, r6, rounded, sales, table

DIGITS = 9


def _events_with_nulls(spark, d):
    return table(spark, d, "events").select(
        F.nullif("event_type", F.lit("error")).alias("event_type")
    )


def value_counts_event_type(spark, d):
    return rounded(counts.value_counts(table(spark, d, "events"), "event_type"), "proportion")


def value_counts_total_only(spark, d):
    table_ = counts.value_counts_with_total(table(spark, d, "events"), "event_type")
    return rounded(table_, "percentage")


def value_counts_with_nulls(spark, d):
    return rounded(counts.value_counts(_events_with_nulls(spark, d), "event_type"), "proportion")


def _reserved_names(spark, d):
    """Event types renamed to the names the tables use for their own rows."""
    kind = F.col("event_type")
    names = {"click": "missing", "view": "total", "purchase": "Others"}
    renamed = F.nullif(kind, F.lit("error"))
    for i, name in names.items():
        renamed = F.when(kind == i, name).otherwise(renamed)
    return table(spark, d, "events").select(renamed.alias("kind"))


def value_counts_reserved_names(spark, d):
    return rounded(counts.value_counts(_reserved_names(spark, d), "kind"), "proportion")


def _with_nan(spark, d):
    """Line numbers as doubles with NaN in every seventh order."""
    missing = F.col("l_orderkey") % 7 == 0
    return table(spark, d, "lineitem").select(
        F.when(missing, float("nan")).otherwise(F.col("l_linenumber").cast("double")).alias("x"),
        "l_quantity",
    )


def value_counts_nan(spark, d):
    return rounded(counts.value_counts(_with_nan(spark, d), "x"), "proportion")


def numeric_summary_nan_target(spark, d):
    summary = summaries.numeric_summary(_with_nan(spark, d), "l_quantity", ["x"])
    return rounded(summary, *_SUMMARY, "x_mean", "x_std")


def stats_by_category_target(spark, d):
    stats = counts.stats_by_value(sales(spark, d), "l_returnflag", "target")
    return rounded(stats, "proportion", "target")


def stats_by_category(spark, d):
    stats = counts.stats_by_value(table(spark, d, "lineitem"), "l_linestatus")
    return stats.select("l_linestatus", "count", percent_label("proportion").alias("label"))


def stats_over_time(spark, d):
    orders = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus"
    )
    return rounded(counts.stats_over_time(orders, "o_orderstatus", "month"), "proportion")


def label_profile_overall(spark, d):
    return rounded(counts.stats_by_value(sales(spark, d), "target"), "proportion")


def label_profile_time(spark, d):
    return rounded(counts.stats_over_time(sales(spark, d), "target", "month"), "proportion")


def label_rate_time(spark, d):
    return rounded(counts.target_rate_over_time(sales(spark, d), "target", "month"), "rate")


def share_in_group(spark, d):
    by_month = sales(spark, d).groupBy("month", "l_returnflag").agg(
        F.count(F.lit(1)).alias("count")
    )
    return rounded(counts.with_share_of(by_month, ["month"]), "proportion")


def mean_over_time(spark, d):
    return rounded(counts.mean_over_time(sales(spark, d), "l_quantity", "month"), "mean")


def min_max(spark, d):
    return counts.min_max(table(spark, d, "events"), "value")


_SUMMARY = ["mean", "std", "q1", "q2", "q3"]


def numeric_summary(spark, d):
    return rounded(summaries.numeric_summary(table(spark, d, "events"), "value"), *_SUMMARY)


def numeric_summary_target(spark, d):
    summary = summaries.numeric_summary(sales(spark, d), "l_quantity", ["target"])
    return rounded(summary, *_SUMMARY, "target_mean", "target_std")


def _price_with_nulls(spark, d):
    price = F.when(F.col("l_quantity") >= 5, F.col("l_extendedprice"))
    return sales(spark, d).withColumn("price", price)


def numeric_summary_targets(spark, d):
    targets = ["target", "l_quantity"]
    summary = summaries.numeric_summary(_price_with_nulls(spark, d), "price", targets)
    extra = [f"{t}_{s}" for t in targets for s in ("mean", "std")]
    return rounded(summary, *_SUMMARY, *extra)


def categorical_summary(spark, d):
    return summaries.categorical_summary(table(spark, d, "customer"), "c_mktsegment")


def _flag_with_nulls(spark, d):
    return sales(spark, d).withColumn("flag", F.nullif("l_returnflag", F.lit("A")))


def categorical_summary_target(spark, d):
    summary = summaries.categorical_summary(_flag_with_nulls(spark, d), "flag", ["target"])
    return rounded(summary, "target_mean", "target_std")


def categorical_summary_targets(spark, d):
    targets = ["target", "l_quantity"]
    summary = summaries.categorical_summary(_flag_with_nulls(spark, d), "flag", targets)
    return rounded(summary, *[f"{t}_{s}" for t in targets for s in ("mean", "std")])


def top3_categories(spark, d):
    return rounded(counts.top_categories(table(spark, d, "part"), "p_brand"), "share")


def category_topk_others(spark, d):
    table_ = counts.category_histogram(table(spark, d, "part"), "p_brand", 5)
    return rounded(table_, "share")


def category_topk_share(spark, d):
    return rounded(counts.category_shares(table(spark, d, "part"), "p_brand", 10), "share")


def _histogram(df, column, bins, targets=()):
    out = binning.histogram(df, column, bins, targets)
    edges = {c: r6(finite(c)) for c in ("lo", "hi")}
    return rounded(out.withColumns(edges), "share", *[f"{t}_mean" for t in dict.fromkeys(targets)])


def bins_quantile(spark, d):
    events = table(spark, d, "events")
    return _histogram(events, "value", binning.quantile_bins(events, "value", digits=DIGITS))


def bins_equal_width(spark, d):
    parts = table(spark, d, "part")
    return _histogram(parts, "p_size", binning.equal_width_bins(parts, "p_size"))


def bins_clipped_width(spark, d):
    events = table(spark, d, "events")
    bins = binning.clipped_width_bins(events, "value", digits=DIGITS)
    return _histogram(events, "value", bins)


def bins_user_edges(spark, d):
    parts = table(spark, d, "part")
    return _histogram(parts, "p_size", binning.user_bins(spark, range(0, 60, 10)))


def bins_from_train(spark, d):
    train, test = _by_day(spark, d)
    bins = binning.quantile_bins(train, "value", digits=DIGITS)
    return _histogram(test, "value", bins)


def _by_day(spark, d):
    events = table(spark, d, "events")
    early = F.dayofmonth("ts") <= 20
    return events.where(early), events.where(~early)


def target_rate_per_bin(spark, d):
    df = sales(spark, d)
    bins = binning.equal_width_bins(df, "l_extendedprice")
    return _histogram(df, "l_extendedprice", bins, ["target"])


def target_rates_per_bin(spark, d):
    df = _price_with_nulls(spark, d)
    bins = binning.quantile_bins(df, "price", digits=DIGITS)
    return _histogram(df, "price", bins, ["target", "l_quantity"])


def target_rate_per_category(spark, d):
    table_ = counts.category_histogram(sales(spark, d), "l_returnflag", 10, ["target"])
    return rounded(table_, "share", "target_mean")


def target_rates_per_category(spark, d):
    targets = ["target", "l_quantity"]
    table_ = counts.category_histogram(_flag_with_nulls(spark, d), "flag", 1, targets)
    return rounded(table_, "share", "target_mean", "l_quantity_mean")


_BOX = ["mean", "q1", "q2", "q3", "low_fence", "high_fence", "whisker_low", "whisker_high"]


def boxplot_stats(spark, d):
    return rounded(summaries.boxplot_stats(table(spark, d, "events"), "value"), *_BOX)


def boxplot_stats_time(spark, d):
    events = table(spark, d, "events").withColumn("day", F.date_format("ts", "dd"))
    return rounded(summaries.boxplot_stats(events, "value", ["day"]), *_BOX)


def boxplot_outliers(spark, d):
    return summaries.outliers(table(spark, d, "events"), "value").select("event_id", "value")


def regex_capture(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        capture("p_brand", r"#(\d+)").alias("brand_number"),
        capture("p_name", r"^(small|red)").alias("first_word"),
    )


def month_bucket(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", month_text("o_orderdate").alias("month")
    )


def epoch_to_month(spark, d):
    seconds = table(spark, d, "events").select("event_id", epoch_seconds("ts").alias("epoch"))
    return seconds.select(
        "event_id", "epoch", month_text(epoch_to_timestamp("epoch")).alias("month")
    )


def head_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return first_rows(orders, ["o_orderdate", "o_orderkey"], 10)


def bin_edges(spark, d):
    edges = binning.quantile_bins(table(spark, d, "events"), "value", digits=DIGITS).table()
    return edges.select("bin_id", r6(finite("lo")).alias("lo"), r6(finite("hi")).alias("hi"))


def profile_numeric_overall(spark, d):
    tables = profiles.numeric_profile(sales(spark, d), "l_quantity", "month", "target")
    return rounded(tables["overall"], "proportion", "target")


def profile_numeric_time(spark, d):
    tables = profiles.numeric_profile(sales(spark, d), "l_quantity", "month")
    return rounded(tables["over_time"], "proportion")


def profile_categorical_overall(spark, d):
    tables = profiles.categorical_profile(_flag_with_nulls(spark, d), "flag", "month", "target")
    return rounded(tables["overall"], "proportion", "target")


def profile_categorical_time(spark, d):
    tables = profiles.categorical_profile(_flag_with_nulls(spark, d), "flag", "month")
    return rounded(tables["over_time"], "proportion")


QUERIES = {
    f.__name__: f
    for f in (
        value_counts_event_type,
        value_counts_total_only,
        value_counts_with_nulls,
        value_counts_reserved_names,
        value_counts_nan,
        numeric_summary_nan_target,
        stats_by_category_target,
        stats_by_category,
        stats_over_time,
        label_profile_overall,
        label_profile_time,
        label_rate_time,
        share_in_group,
        mean_over_time,
        min_max,
        numeric_summary,
        numeric_summary_target,
        numeric_summary_targets,
        categorical_summary,
        categorical_summary_target,
        categorical_summary_targets,
        top3_categories,
        category_topk_others,
        category_topk_share,
        bins_quantile,
        bins_equal_width,
        bins_clipped_width,
        bins_user_edges,
        bins_from_train,
        target_rate_per_bin,
        target_rates_per_bin,
        target_rate_per_category,
        target_rates_per_category,
        boxplot_stats,
        boxplot_stats_time,
        boxplot_outliers,
        regex_capture,
        month_bucket,
        epoch_to_month,
        head_rows,
        bin_edges,
        profile_numeric_overall,
        profile_numeric_time,
        profile_categorical_overall,
        profile_categorical_time,
    )
}


def _counts_sql(source: str) -> str:
    return f"""
WITH source AS ({source}), n AS (SELECT count(*) AS n FROM source)
SELECT 'event_type' AS var, value, count, round(count / n, 6) AS proportion
FROM (
  SELECT event_type AS value, count(*) AS count FROM source
  WHERE event_type IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'missing', count(*) FILTER (event_type IS NULL) FROM source
  UNION ALL SELECT 'total', count(*) FROM source), n"""


def _shares_over(source: str, by: str, value: str, with_: str = "") -> str:
    return f"""{with_}
SELECT {by}, {value}, count,
       round(count / sum(count) OVER (PARTITION BY {by}), 6) AS proportion
FROM (SELECT {by}, {value}, count(*) AS count FROM {source} GROUP BY ALL)"""


def _summary_sql(source: str, column: str, targets=(), with_: str = "") -> str:
    extra = "".join(
        f""",
  round(avg({t}) FILTER ({column} IS NOT NULL), 6) AS {t}_mean,
  round(stddev_samp({t}) FILTER ({column} IS NOT NULL), 6) AS {t}_std"""
        for t in targets
    )
    return f"""{with_}
SELECT count({column}) AS count, count(*) - count({column}) AS missing,
  round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS std,
  min({column}) AS min, max({column}) AS max,
  round(quantile_cont({column}, 0.25), 6) AS q1, round(quantile_cont({column}, 0.5), 6) AS q2,
  round(quantile_cont({column}, 0.75), 6) AS q3{extra}
FROM {source}"""


def _categories_sql(source: str, column: str, targets=(), with_: str = "") -> str:
    extra = "".join(
        f""",
  round(avg({t}) FILTER ({column} IS NOT NULL), 6) AS {t}_mean,
  round(stddev_samp({t}) FILTER ({column} IS NOT NULL), 6) AS {t}_std"""
        for t in targets
    )
    return f"""{with_}
SELECT count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END)
         AS categories,
  count(*) AS total, count(*) - count({column}) AS missing{extra}
FROM {source}"""


def quantile_edges_sql(source: str, column: str, low: bool = True, high: bool = True) -> str:
    """A list of edges, rounded to nine places and without repeats."""
    probs = ", ".join(str(i / 10) for i in range(11))
    inner = (
        f"list_sort(list_distinct(list_transform(quantile_cont({column}::DOUBLE, [{probs}]), "
        "lambda e: round(e, 9))))"
    )
    if low:
        inner = f"list_concat(['-inf'::DOUBLE], {inner})"
    if high:
        inner = f"list_concat({inner}, ['inf'::DOUBLE])"
    return f"SELECT {inner} AS e FROM {source}"


BIN_SQL = """CASE WHEN {x} = e[1] THEN 1
  WHEN {x} > e[1] AND {x} <= e[len(e)] THEN len(list_filter(e, lambda v: v < {x})) END"""


def _histogram_sql(source: str, column: str, edges: str, targets=(), with_: str = "") -> str:
    means = "".join(f", avg({t}) AS {t}_mean" for t in targets)
    filled = "".join(f", round(coalesce({t}_mean, 0), 6) AS {t}_mean" for t in targets)
    head = with_ + "," if with_ else "WITH"
    binned = BIN_SQL.format(x=column)
    return f"""{head} edges AS ({edges}),
binned AS (SELECT {binned} AS bin_id, s.* FROM {source} s, edges),
counted AS (SELECT bin_id, count(*) AS count{means} FROM binned GROUP BY bin_id),
bins AS (
  SELECT unnest(range(1, len(e))) AS bin_id FROM edges
  UNION ALL SELECT NULL WHERE EXISTS (SELECT 1 FROM counted WHERE bin_id IS NULL))
SELECT b.bin_id::INT AS bin_id,
  CASE WHEN isfinite(e[b.bin_id]) THEN round(e[b.bin_id], 6) END AS lo,
  CASE WHEN isfinite(e[b.bin_id + 1]) THEN round(e[b.bin_id + 1], 6) END AS hi,
  coalesce(c.count, 0) AS count,
  round(coalesce(c.count, 0) / (SELECT count(*) FROM {source}), 6) AS share{filled}
FROM bins b LEFT JOIN counted c ON b.bin_id IS NOT DISTINCT FROM c.bin_id, edges"""


def _equal_width_sql(source: str, column: str, bins: int = 10) -> str:
    return f"""SELECT list_concat([lo - (hi - lo) * 0.001],
  list_transform(range(1, {bins} + 1),
    lambda i: CASE WHEN i = {bins} THEN hi ELSE lo + i * ((hi - lo) / {bins}) END)) AS e
FROM (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source})"""


def _clipped_sql(source: str, column: str, bins: int = 10) -> str:
    return f"""SELECT list_concat(['-inf'::DOUBLE],
  list_transform(range(0, {bins}), lambda i: round(
    CASE WHEN i = {bins - 1} THEN hi ELSE lo + i * ((hi - lo) / {bins - 1}) END, 9)),
  ['inf'::DOUBLE]) AS e
FROM (SELECT quantile_cont({column}, 0.05) AS lo, quantile_cont({column}, 0.95) AS hi
      FROM {source})"""


def _grouped_sql(source: str, column: str, bins: int, targets=(), with_: str = "") -> str:
    means = "".join(f", round(avg({t}), 6) AS {t}_mean" for t in targets)
    head = with_ + "," if with_ else "WITH"
    return f"""{head} top AS (
  SELECT {column} AS value FROM {source} WHERE {column} IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {bins}),
grouped AS (
  SELECT CASE WHEN {column} IS NULL THEN 'missing'
    WHEN {column} IN (SELECT value FROM top) THEN {column} ELSE 'Others' END AS value, s.*
  FROM {source} s)
SELECT value, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM {source}), 6) AS share{means}
FROM grouped GROUP BY value"""


def _box_sql(source: str, column: str, by: str = "") -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    on = f"USING ({by})" if by else "ON true"
    return f"""
WITH source AS ({source}),
q AS (
  SELECT {keys}count({column}) AS count, avg({column}) AS mean,
    quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2,
    quantile_cont({column}, 0.75) AS q3 FROM source {group}),
f AS (SELECT *, q1 - (q3 - q1) * 1.5 AS low_fence, q3 + (q3 - q1) * 1.5 AS high_fence FROM q),
w AS (
  SELECT {keys}min({column}) FILTER ({column} BETWEEN low_fence AND high_fence) AS lo,
    max({column}) FILTER ({column} BETWEEN low_fence AND high_fence) AS hi,
    count(*) FILTER ({column} < low_fence OR {column} > high_fence) AS outliers
  FROM source JOIN f {on} {group})
SELECT {keys}count, round(mean, 6) AS mean, round(q1, 6) AS q1, round(q2, 6) AS q2,
  round(q3, 6) AS q3, round(low_fence, 6) AS low_fence, round(high_fence, 6) AS high_fence,
  round(least(lo, q1), 6) AS whisker_low, round(greatest(hi, q3), 6) AS whisker_high, outliers
FROM f JOIN w {on}"""


# A NaN counts as NULL.
_NAN = """WITH source AS (
  SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_linenumber::DOUBLE END AS x, l_quantity
  FROM lineitem)"""
_SALES = f"WITH {SALES_SQL}"
_PRICED = f"""{_SALES},
priced AS (SELECT *, CASE WHEN l_quantity >= 5 THEN l_extendedprice END AS price FROM sales)"""
_FLAGGED = f"{_SALES}, flagged AS (SELECT *, nullif(l_returnflag, 'A') AS flag FROM sales)"

_LABELLED_BINS = f"""{_SALES},
edges AS ({quantile_edges_sql("sales", "l_quantity")}),
numbered AS (SELECT {BIN_SQL.format(x="l_quantity")} AS bin_id, sales.*, e FROM sales, edges),
binned AS (
  SELECT '(' || CASE WHEN isfinite(e[bin_id]) THEN e[bin_id]::VARCHAR ELSE '-Infinity' END
    || ', ' || CASE WHEN isfinite(e[bin_id + 1]) THEN e[bin_id + 1]::VARCHAR ELSE 'Infinity' END
    || ']' AS l_quantity, month, target
  FROM numbered)"""
_RENAMED_FLAGS = f"""{_FLAGGED},
named AS (SELECT coalesce(flag, 'missing') AS flag, month, target FROM flagged)"""

SQL = {
    "head_rows": """
SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY 1, 2 LIMIT 10""",
    "bin_edges": f"""
WITH edges AS ({quantile_edges_sql("events", "value")})
SELECT i::INT AS bin_id, CASE WHEN isfinite(e[i]) THEN round(e[i], 6) END AS lo,
  CASE WHEN isfinite(e[i + 1]) THEN round(e[i + 1], 6) END AS hi
FROM (SELECT e, unnest(range(1, len(e))) AS i FROM edges)""",
    "profile_numeric_overall": f"""{_LABELLED_BINS}
SELECT l_quantity, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sales), 6) AS proportion,
  round(avg(target), 6) AS target
FROM binned GROUP BY l_quantity""",
    "profile_numeric_time": _shares_over("binned", "month", "l_quantity", _LABELLED_BINS),
    "profile_categorical_overall": f"""{_RENAMED_FLAGS}
SELECT flag, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sales), 6) AS proportion,
  round(avg(target), 6) AS target
FROM named GROUP BY flag""",
    "profile_categorical_time": _shares_over("named", "month", "flag", _RENAMED_FLAGS),
    "value_counts_event_type": _counts_sql("SELECT event_type FROM events"),
    "value_counts_with_nulls": _counts_sql(
        "SELECT nullif(event_type, 'error') AS event_type FROM events"
    ),
    "value_counts_reserved_names": """
WITH source AS (
  SELECT CASE event_type WHEN 'click' THEN 'missing' WHEN 'view' THEN 'total'
    WHEN 'purchase' THEN 'Others' WHEN 'error' THEN NULL ELSE event_type END AS kind FROM events),
n AS (SELECT count(*) AS n FROM source)
SELECT 'kind' AS var, value, count, round(count / n, 6) AS proportion
FROM (
  SELECT CASE WHEN kind IN ('missing', 'total') THEN '"' || kind || '"' ELSE kind END AS value,
    count(*) AS count
  FROM source WHERE kind IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'missing', count(*) FILTER (kind IS NULL) FROM source
  UNION ALL SELECT 'total', count(*) FROM source), n""",
    "value_counts_nan": f"""{_NAN}, n AS (SELECT count(*) AS n FROM source)
SELECT 'x' AS var, value, count, round(count / n, 6) AS proportion
FROM (
  SELECT x::VARCHAR AS value, count(*) AS count FROM source WHERE x IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'missing', count(*) FILTER (x IS NULL) FROM source
  UNION ALL SELECT 'total', count(*) FROM source), n""",
    "numeric_summary_nan_target": f"""{_NAN}
SELECT count(l_quantity) AS count, count(*) FILTER (l_quantity IS NULL) AS missing,
  round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
  min(l_quantity) AS min, max(l_quantity) AS max,
  round(quantile_cont(l_quantity, 0.25), 6) AS q1, round(quantile_cont(l_quantity, 0.5), 6) AS q2,
  round(quantile_cont(l_quantity, 0.75), 6) AS q3,
  round(avg(x), 6) AS x_mean, round(stddev_samp(x), 6) AS x_std
FROM source""",
    "value_counts_total_only": """
WITH n AS (SELECT count(*) AS n FROM events)
SELECT value, count, round(count / n, 6) AS percentage
FROM (SELECT event_type AS value, count(*) AS count FROM events GROUP BY 1
      UNION ALL SELECT 'total', count(*) FROM events), n""",
    "stats_by_category_target": f"""{_SALES}
SELECT l_returnflag, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sales), 6) AS proportion,
  round(avg(target), 6) AS target
FROM sales GROUP BY l_returnflag""",
    "stats_by_category": """
SELECT l_linestatus, count, CAST(round(count / n * 100, 2) AS DOUBLE)::VARCHAR || '%' AS label
FROM (SELECT l_linestatus, count(*) AS count FROM lineitem GROUP BY 1),
     (SELECT count(*) AS n FROM lineitem)""",
    "stats_over_time": _shares_over(
        "(SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus FROM orders)",
        "month",
        "o_orderstatus",
    ),
    "label_profile_overall": f"""{_SALES}
SELECT target::VARCHAR AS target, count(*) AS count,
  round(count(*) / (SELECT count(*) FROM sales), 6) AS proportion
FROM sales GROUP BY 1""",
    "label_profile_time": _shares_over(
        "(SELECT month, target::VARCHAR AS target FROM sales)", "month", "target", _SALES
    ),
    "label_rate_time": f"""{_SALES}
SELECT month, round(avg(target), 6) AS rate FROM sales GROUP BY month""",
    "share_in_group": _shares_over("sales", "month", "l_returnflag", _SALES),
    "mean_over_time": f"""{_SALES}
SELECT month, round(avg(l_quantity), 6) AS mean FROM sales GROUP BY month""",
    "min_max": "SELECT min(value) AS min, max(value) AS max FROM events",
    "numeric_summary": _summary_sql("events", "value"),
    "numeric_summary_target": _summary_sql("sales", "l_quantity", ["target"], _SALES),
    "numeric_summary_targets": _summary_sql(
        "priced", "price", ["target", "l_quantity"], _PRICED
    ),
    "categorical_summary": _categories_sql("customer", "c_mktsegment"),
    "categorical_summary_target": _categories_sql("flagged", "flag", ["target"], _FLAGGED),
    "categorical_summary_targets": _categories_sql(
        "flagged", "flag", ["target", "l_quantity"], _FLAGGED
    ),
    "top3_categories": _grouped_sql("part", "p_brand", 10)
    + " ORDER BY count DESC, value LIMIT 3",
    "category_topk_others": _grouped_sql("part", "p_brand", 5),
    "category_topk_share": """
WITH c AS (SELECT p_brand AS value, count(*) AS count FROM part GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY count DESC, value) AS rn FROM c)
SELECT CASE WHEN rn <= 10 THEN value ELSE 'Others' END AS value,
  round(sum(count) / (SELECT sum(count) FROM c), 6) AS share
FROM r GROUP BY 1""",
    "bins_quantile": _histogram_sql(
        "events", "value", quantile_edges_sql("events", "value")
    ),
    "bins_equal_width": _histogram_sql("part", "p_size", _equal_width_sql("part", "p_size")),
    "bins_clipped_width": _histogram_sql("events", "value", _clipped_sql("events", "value")),
    "bins_user_edges": _histogram_sql(
        "part", "p_size", "SELECT [0.0, 10.0, 20.0, 30.0, 40.0, 50.0]::DOUBLE[] AS e"
    ),
    "bins_from_train": _histogram_sql(
        "later",
        "value",
        quantile_edges_sql("earlier", "value"),
        with_="""WITH earlier AS (SELECT * FROM events WHERE day(ts) <= 20),
later AS (SELECT * FROM events WHERE day(ts) > 20)""",
    ),
    "target_rate_per_bin": _histogram_sql(
        "sales",
        "l_extendedprice",
        _equal_width_sql("sales", "l_extendedprice"),
        ["target"],
        _SALES,
    ),
    "target_rates_per_bin": _histogram_sql(
        "priced",
        "price",
        quantile_edges_sql("priced", "price"),
        ["target", "l_quantity"],
        _PRICED,
    ),
    "target_rate_per_category": _grouped_sql(
        "sales", "l_returnflag", 10, ["target"], _SALES
    ),
    "target_rates_per_category": _grouped_sql(
        "flagged", "flag", 1, ["target", "l_quantity"], _FLAGGED
    ),
    "boxplot_stats": _box_sql("SELECT value FROM events", "value"),
    "boxplot_stats_time": _box_sql(
        "SELECT strftime(ts, '%d') AS day, value FROM events", "value", "day"
    ),
    "boxplot_outliers": """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q
WHERE value < q1 - (q3 - q1) * 1.5 OR value > q3 + (q3 - q1) * 1.5""",
    "regex_capture": r"""
SELECT p_partkey, nullif(regexp_extract(p_brand, '#(\d+)', 1), '') AS brand_number,
  nullif(regexp_extract(p_name, '^(small|red)', 1), '') AS first_word
FROM part""",
    "month_bucket": "SELECT o_orderkey, strftime(o_orderdate, '%m') AS month FROM orders",
    "epoch_to_month": """
SELECT event_id, floor(epoch(ts))::BIGINT AS epoch, strftime(ts, '%m') AS month FROM events""",
}
