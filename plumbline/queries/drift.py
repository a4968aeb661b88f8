"""Drift between train, test and validation slices of the events, split by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import drift
from plumbline.operators.binning import quantile_bins
from plumbline.queries.profile import BIN_SQL, quantile_edges_sql
from plumbline.queries.tables import rounded, table

DIGITS = 9


def _sets(spark, d):
    events = table(spark, d, "events")
    day = F.dayofmonth("ts")
    return {
        "train": events.where(day <= 20),
        "val": events.where((day > 20) & (day <= 25)),
        "test": events.where(day > 25),
    }


def aligned_histogram(spark, d):
    sets = _sets(spark, d)
    bins = quantile_bins(sets["train"], "value", digits=DIGITS)
    return drift.aligned_bin_counts("value", bins, **sets)


def aligned_categories(spark, d):
    return drift.aligned_category_counts("event_type", **_sets(spark, d))


def psi_numeric(spark, d):
    table_ = drift.compare_psi("value", digits=DIGITS, **_sets(spark, d))
    return rounded(table_.select("pair", "psi"), "psi")


def psi_categorical(spark, d):
    table_ = drift.compare_psi("event_type", bins=3, **_sets(spark, d))
    return rounded(table_.select("pair", "psi"), "psi")


def psi_train_categories(spark, d):
    """The same with train's top values used for all three sets."""
    table_ = drift.compare_psi("event_type", bins=3, reference_top_k=True, **_sets(spark, d))
    return rounded(table_.select("pair", "psi"), "psi")


def psi_severity(spark, d):
    """Severity classes after tripling one category in the test slice."""
    aligned = drift.aligned_category_counts("event_type", **_sets(spark, d))
    shifted = aligned.withColumn(
        "test", F.when(F.col("bin") == "error", F.col("test") * 3).otherwise(F.col("test"))
    )
    return drift.psi_pairs(shifted).select("pair", "severity")


def kl_numeric(spark, d):
    return rounded(drift.compare_kl("value", digits=DIGITS, **_sets(spark, d)), "kl")


def kl_categorical(spark, d):
    return rounded(drift.compare_kl("event_type", **_sets(spark, d)), "kl")


QUERIES = {
    f.__name__: f
    for f in (
        aligned_histogram,
        aligned_categories,
        psi_numeric,
        psi_categorical,
        psi_train_categories,
        psi_severity,
        kl_numeric,
        kl_categorical,
    )
}

_SETS = """WITH tagged AS (
  SELECT *, CASE WHEN day(ts) <= 20 THEN 'train' WHEN day(ts) <= 25 THEN 'val' ELSE 'test' END
    AS set FROM events),
train AS (SELECT * FROM tagged WHERE set = 'train')"""


def _binned(low: bool) -> str:
    edges = quantile_edges_sql("train", "value", low=low)
    return f"""{_SETS},
edges AS ({edges}),
binned AS (SELECT {BIN_SQL.format(x="value")}::INT AS bin, set FROM tagged, edges)"""


_COUNTS = """, aligned AS (
  SELECT bin, count(*) FILTER (set = 'train') AS train, count(*) FILTER (set = 'test') AS test,
    count(*) FILTER (set = 'val') AS val
  FROM binned GROUP BY bin)"""
_CATEGORIES = f"{_SETS}, binned AS (SELECT event_type AS bin, set FROM tagged)"

_TOP_OF_EACH = f"""{_SETS},
c AS (SELECT set, event_type, count(*) AS n FROM tagged GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY set ORDER BY n DESC, event_type) AS rn FROM c),
binned AS (
  SELECT CASE WHEN rn <= 3 THEN t.event_type ELSE 'Others' END AS bin, t.set
  FROM tagged t JOIN r ON t.set = r.set AND t.event_type = r.event_type)"""
_TOP_OF_TRAIN = f"""{_SETS},
top AS (SELECT event_type FROM train GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3),
binned AS (
  SELECT CASE WHEN event_type IN (SELECT event_type FROM top) THEN event_type
    ELSE 'Others' END AS bin, set
  FROM tagged)"""

_NORMALISED = """, shares AS (
  SELECT train / sum(train) OVER () AS train, test / sum(test) OVER () AS test,
    val / sum(val) OVER () AS val FROM aligned)"""
_SMOOTHED = """, smooth AS (
  SELECT (train + 1e-10) / sum(train + 1e-10) OVER () AS train,
    (test + 1e-10) / sum(test + 1e-10) OVER () AS test,
    (val + 1e-10) / sum(val + 1e-10) OVER () AS val FROM shares)"""


def _psi(p: str, q: str) -> str:
    return f"sum(({p} - {q}) * ln(({p} + 1e-6) / ({q} + 1e-6)))"


def _pairs(term, name: str, source: str) -> str:
    pairs = [("train", "test"), ("train", "val"), ("val", "test")]
    return " UNION ALL ".join(
        f"SELECT '{p}_{q}' AS pair, {term(p, q)} AS {name} FROM {source}" for p, q in pairs
    )


def _psi_sql(binned: str) -> str:
    pairs = _pairs(lambda p, q: f"round({_psi(p, q)}, 6)", "psi", "shares")
    return f"{binned}{_COUNTS}{_NORMALISED} {pairs}"


def _kl_sql(binned: str) -> str:
    pairs = _pairs(lambda p, q: f"round(sum({p} * ln({p} / {q})), 6)", "kl", "smooth")
    return f"{binned}{_COUNTS}{_NORMALISED}{_SMOOTHED} {pairs}"


_SHIFTED = """, original AS (SELECT * FROM counted),
aligned AS (
  SELECT bin, train, CASE WHEN bin = 'error' THEN test * 3 ELSE test END AS test, val
  FROM original)"""

SQL = {
    "aligned_histogram": f"{_binned(True)}{_COUNTS} SELECT * FROM aligned",
    "aligned_categories": f"{_CATEGORIES}{_COUNTS} SELECT * FROM aligned",
    "psi_numeric": _psi_sql(_binned(True)),
    "psi_categorical": _psi_sql(_TOP_OF_EACH),
    "psi_train_categories": _psi_sql(_TOP_OF_TRAIN),
    "psi_severity": (
        f"{_CATEGORIES}{_COUNTS.replace('aligned', 'counted')}{_SHIFTED}{_NORMALISED}"
        ", p AS ("
        + _pairs(_psi, "psi", "shares")
        + ") SELECT pair, CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.2 THEN 'moderate' "
        "ELSE 'significant' END AS severity FROM p"
    ),
    "kl_numeric": _kl_sql(_binned(False)),
    "kl_categorical": _kl_sql(_CATEGORIES),
}
