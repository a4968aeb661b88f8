"""Distribution drift between train, test and validation tables.

The tables are tagged and unioned, then one aggregate per bin or category gives
the aligned counts of all three; PSI and KL are column arithmetic on that table.
The aligned table is computed and stored when the function is called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from plumbline.functions.columns import MISSING, OTHERS, present_text, share, unreserved
from plumbline.functions.frames import one_row
from plumbline.operators.binning import Bins, quantile_bins
from plumbline.operators.ranking import top_k_within
from plumbline.sources.state import cut_lineage

# Smoothing terms and class limits that define the published numbers.
PSI_EPSILON = 1e-6
KL_EPSILON = 1e-10
NO_CHANGE_BELOW = 0.1
MODERATE_BELOW = 0.2

SETS = ("train", "test", "val")
PAIRS = (("train", "test"), ("train", "val"), ("val", "test"))


def aligned_bin_counts(
    column: str, bins: Bins, *, train: DataFrame, test: DataFrame, val: DataFrame
) -> DataFrame:
    """``bin`` and one count per set, over the union of occurring bins, absent = 0."""
    sets = {"train": train, "test": test, "val": val}
    return _side_by_side(
        _union_of(
            {
                name: bins.assign(df.select(column), column, "bin").select("bin")
                for name, df in sets.items()
            }
        )
    )


def aligned_category_counts(
    column: str, *, train: DataFrame, test: DataFrame, val: DataFrame
) -> DataFrame:
    """The same over every category; NULL is the category ``missing``."""
    return _side_by_side(_categories(column, train, test, val))


def aligned_category_shares(
    column: str,
    top_k: int = 10,
    reference_top_k: bool = False,
    *,
    train: DataFrame,
    test: DataFrame,
    val: DataFrame,
) -> DataFrame:
    """Shares of the top categories and ``Others``, over the union of named values.

    Each set has its own top values unless ``reference_top_k`` takes train's. One
    pass counts every (set, category); the rest works on those counts.
    """
    counts = (
        _categories(column, train, test, val)
        .groupBy("set", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    top = top_k_within(counts, ["set"], [F.desc("count"), F.col("bin")], top_k)
    if reference_top_k:
        top, keys = top.where(F.col("set") == "train"), ["bin"]
    else:
        keys = ["set", "bin"]
    named = top.select(*keys, F.lit(True).alias("named"))
    grouped = counts.join(named, keys, "left").select(
        F.when(F.col("named"), F.col("bin")).otherwise(F.lit(OTHERS)).alias("bin"),
        *[
            F.when(F.col("set") == s, F.col("count")).otherwise(F.lit(0)).alias(s)
            for s in SETS
        ],
    )
    others = one_row(train, bin=F.lit(OTHERS), **{s: F.lit(0) for s in SETS})
    summed = grouped.unionByName(others).groupBy("bin")
    return normalised(cut_lineage(summed.agg(*[F.sum(s).alias(s) for s in SETS])))


def _categories(
    column: str, train: DataFrame, test: DataFrame, val: DataFrame
) -> DataFrame:
    sets = {"train": train, "test": test, "val": val}
    return _union_of(
        {
            name: df.select(_category(df, column))
            for name, df in sets.items()
        }
    )


def _category(df: DataFrame, column: str) -> Column:
    own = unreserved(present_text(df, column), MISSING, OTHERS)
    return F.coalesce(own, F.lit(MISSING)).alias("bin")


def _union_of(sets: dict[str, DataFrame]) -> DataFrame:
    tagged = [df.withColumn("set", F.lit(name)) for name, df in sets.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


def _side_by_side(tagged: DataFrame) -> DataFrame:
    return cut_lineage(
        tagged.groupBy("bin").agg(
            *[F.count_if(F.col("set") == s).alias(s) for s in SETS]
        )
    )


def normalised(aligned: DataFrame) -> DataFrame:
    """Divide each set's column by its sum."""
    totals = aligned.agg(*[F.sum(s).alias(s) for s in SETS])
    return aligned.select(
        "bin", *[share(F.col(s), totals.select(s).scalar()).alias(s) for s in SETS]
    )


def psi_term(expected: Column, actual: Column) -> Column:
    ratio = (expected + PSI_EPSILON) / (actual + PSI_EPSILON)
    return (expected - actual) * F.ln(ratio)


def psi(aligned: DataFrame, expected: str, actual: str) -> DataFrame:
    """Population stability index of two columns of an aligned table."""
    totals = aligned.agg(F.sum(expected).alias("e"), F.sum(actual).alias("a"))
    e = share(F.col(expected), totals.select("e").scalar())
    a = share(F.col(actual), totals.select("a").scalar())
    return aligned.select(psi_term(e, a).alias("t")).agg(F.sum("t").alias("psi"))


def psi_severity(value: Column) -> Column:
    return (
        F.when(value < NO_CHANGE_BELOW, F.lit("none"))
        .when(value < MODERATE_BELOW, F.lit("moderate"))
        .otherwise(F.lit("significant"))
    )


def psi_pairs(aligned: DataFrame) -> DataFrame:
    """``pair, psi, severity`` for the three pairs of an aligned table."""
    return _pairs(normalised(aligned), psi_term, "psi").withColumn(
        "severity", psi_severity(F.col("psi"))
    )


def kl_pairs(aligned: DataFrame) -> DataFrame:
    """``pair, kl``: relative entropy in nats after smoothing and renormalising."""
    shares = normalised(aligned)
    smoothed = shares.select("bin", *[(F.col(s) + KL_EPSILON).alias(s) for s in SETS])
    return _pairs(normalised(smoothed), lambda p, q: p * F.ln(p / q), "kl")


def _pairs(shares: DataFrame, term, name: str) -> DataFrame:
    sums = shares.agg(
        *[F.sum(term(F.col(p), F.col(q))).alias(f"{p}_{q}") for p, q in PAIRS]
    )
    rows = F.array(
        *[
            F.struct(F.lit(f"{p}_{q}").alias("pair"), F.col(f"{p}_{q}").alias(name))
            for p, q in PAIRS
        ]
    )
    return sums.select(F.inline(rows))


def compare_psi(
    column: str,
    bins: int = 10,
    reference_top_k: bool = False,
    digits: int | None = None,
    method: str = "exact",
    *,
    train: DataFrame,
    test: DataFrame,
    val: DataFrame,
) -> DataFrame:
    """Numeric columns use train's quantile bins, others their top categories."""
    sets = {"train": train, "test": test, "val": val}
    if _is_numeric(train, column):
        fitted = quantile_bins(train, column, bins, digits=digits, method=method)
        return psi_pairs(aligned_bin_counts(column, fitted, **sets))
    return psi_pairs(aligned_category_shares(column, bins, reference_top_k, **sets))


def compare_kl(
    column: str,
    bins: int = 10,
    digits: int | None = None,
    method: str = "exact",
    *,
    train: DataFrame,
    test: DataFrame,
    val: DataFrame,
) -> DataFrame:
    """Numeric columns use train's quantile edges, open only at the top: a value under
    train's minimum has no bin. Others use every category."""
    sets = {"train": train, "test": test, "val": val}
    if _is_numeric(train, column):
        fitted = quantile_bins(
            train, column, bins, open_low=False, digits=digits, method=method
        )
        return kl_pairs(aligned_bin_counts(column, fitted, **sets))
    return kl_pairs(aligned_category_counts(column, **sets))


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NumericType)
