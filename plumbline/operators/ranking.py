"""Ranking metrics at k and top-k selection.

Inputs are rows (query, item, label, prediction). Rows are brought together by query in
one shuffle, and their labels in another; all that follows stays where these put it.
Queries with very many rows go another way: row-level ranks keep only the first
``max(ks)`` rows, which Spark cuts before the shuffle, and tied groups are
pre-aggregated, so that such a query is never one task's work. Predictions are compared
as 32-bit floats.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.frames import dealt, metric_columns_in_order, prefixed
from plumbline.sources.state import cut_lineage

METRICS = ("ndcg", "recall", "precision", "map")
DEFAULT_KS = (1, 2, 3, 4, 5)
#: A query is large if this many rows of it are among those drawn, one in so many: from
#: some 25,000 rows on. Either way gives the same values, so it matters little which one.
LARGE, ONE_IN = 25, 1000
#: Rows by version that one task gets, on average.
VERSION_ROWS = 500_000


def top_k_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, out: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of each group with their rank; ``order`` must be total."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


def large_queries(df: DataFrame, *keys: Column | str) -> DataFrame | None:
    """``qid``, a struct of the keys, of queries with very many rows, or None; stored.

    One pass over the keys, when the function is called. Inside a struct NULL equals itself.
    """
    return sizes_of(df, *keys)[0]


def sizes_of(df: DataFrame, *keys: Column | str) -> tuple[DataFrame | None, int]:
    """:func:`large_queries`, and about how many rows there are in all."""
    drawn = df.select(F.struct(*keys).alias("qid")).sample(1 / ONE_IN, seed=0)
    sizes = cut_lineage(drawn.groupBy("qid").agg(F.count(F.lit(1)).alias("size")))
    found = sizes.where(F.col("size") >= LARGE).select("qid")
    seen = sizes.agg(F.sum("size"), F.max("size")).first()
    return found if (seen[1] or 0) >= LARGE else None, ONE_IN * (seen[0] or 0)


def together(
    rows: DataFrame, query: str = "qid", size: int = 0
) -> tuple[DataFrame, list[str]]:
    """``rows`` with all those of a query in one task, and what windows over a query are
    partitioned by: a number comes first, by which most rows are sorted at once. Of about
    ``size`` rows, if given, a task gets a bounded part."""
    return hashed(dealt(rows, size, query, always=True), query)


def hashed(rows: DataFrame, query: str = "qid") -> tuple[DataFrame, list[str]]:
    """:func:`together` where the rows of a query are in one task already."""
    return rows.withColumn("__hash", F.xxhash64(query)), ["__hash", query]


def query_metrics(
    df: DataFrame,
    ks: Sequence[int] = DEFAULT_KS,
    pred: str = "pred",
    label: str = "label",
    qid: str = "qid",
    item: str = "movie_id",
    metrics: Sequence[str] = METRICS,
    sizes_from: DataFrame | None = None,
    versions: int = 0,
) -> DataFrame:
    """One row per query with ``<metric>_<k>`` columns; no positives scores 0.

    ``metrics`` names the wanted ones: what only the others need is not computed. The
    queries are read once when the function is called, to find the large ones: from
    ``sizes_from`` if given, which has as many rows of each query. With ``versions`` each
    row has an array of so many predictions, and each query a row for every ``version``, from
    0 on: the rows are moved once for all of them.
    """
    ks = sorted(set(ks))
    rows = df.select(
        F.struct(F.col(qid).alias("id")).alias("qid"),
        F.col(item).alias("item"),
        F.col(label).cast("double").alias("label"),
        F.col(pred).cast("array<float>" if versions else "float").alias("score"),
    )
    large, size = sizes_of(df if sizes_from is None else sizes_from, F.col(qid).alias("id"))
    few, many, by = rows, None, ["version"] if versions else []
    if large is not None:
        few = rows.join(F.broadcast(large), "qid", "left_anti")
        many = rows.join(F.broadcast(large), "qid", "left_semi")
    if versions:
        sums = _sums_by_version(few, ks, metrics, size * versions)
    else:
        sums = _sums(few, ks, metrics, size)
    if many is not None and versions:
        # To the path of large queries each version of one is a query.
        each = _by_version(many).withColumn("qid", F.struct("qid", "version"))
        found = _sums_of_large(each, ks, metrics).withColumn("version", F.col("qid.version"))
        sums = sums.unionByName(found.withColumn("qid", F.col("qid.qid")))
    elif many is not None:
        sums = sums.unionByName(_sums_of_large(many, ks, metrics))
    columns = []
    for k in ks:
        total = F.nullif(F.col("positives"), F.lit(0))
        found = F.col(f"hits_{k}")
        values = {
            "ndcg": F.col(f"dcg_{k}") / F.nullif(F.col(f"ideal_{k}"), F.lit(0.0)),
            "recall": found / total,
            "precision": found / F.lit(k),
            "map": F.col(f"ap_{k}") / F.nullif(found, F.lit(0)),
        }
        columns += [_or_zero(values[m]).alias(f"{m}_{k}") for m in METRICS if m in metrics]
    return sums.select(F.col("qid.id").alias(qid), *by, *columns)


def _by_version(rows: DataFrame) -> DataFrame:
    """A row per row and prediction, with ``version`` from 0 on."""
    others = [c for c in rows.columns if c != "score"]
    return rows.select(*others, F.posexplode("score").alias("version", "score"))


def _sum_names(ks: Sequence[int], metrics: Sequence[str]) -> list[str]:
    """The sums over a query that the metrics are made of."""
    names = [f"{part}_{k}" for k in ks for part in ("dcg", "ideal") if "ndcg" in metrics]
    names += [f"hits_{k}" for k in ks if set(metrics) - {"ndcg"}]
    names += [f"ap_{k}" for k in ks if "map" in metrics]
    return [*names, *(["positives"] if "recall" in metrics else [])]


def _sums(
    rows: DataFrame, ks: Sequence[int], metrics: Sequence[str], size: int = 0
) -> DataFrame:
    """The sums of queries whose rows fit one task; there are about ``size`` rows."""
    near, query = together(rows, size=size)
    ranked = Window.partitionBy(*query).orderBy(F.desc("score"), F.col("item"))
    positive = F.col("label") > 0
    so_far = F.sum(positive.cast("int")).over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    placed = near.withColumns({"rank": F.row_number().over(ranked), "so_far": so_far})
    if "ndcg" in metrics:
        tied = Window.partitionBy(*query).orderBy(F.desc("score")).rangeBetween(0, 0)
        discount = F.lit(1.0) / F.log2(F.col("rank") + 1.0)
        placed = placed.withColumn("gain", F.avg("label").over(tied) * discount)
    sums = {}
    for k in ks:
        inside = F.col("rank") <= k
        sums |= {
            f"dcg_{k}": F.sum(F.when(inside, F.col("gain"))),
            f"hits_{k}": F.count_if(inside & positive),
            f"ap_{k}": F.sum(F.when(inside & positive, F.col("so_far") / F.col("rank"))),
        }
    names = _sum_names(ks, metrics)
    made = placed.groupBy("qid").agg(*[c.alias(n) for n, c in sums.items() if n in names])
    if "ndcg" in metrics:
        made = made.join(_label_sums(rows, ks, size), "qid", "left")
    elif "recall" in metrics:
        positives = rows.groupBy("qid").agg(F.count_if(positive).alias("positives"))
        made = made.join(positives, "qid", "left")
    return made.select("qid", *names)


def _sums_by_version(
    rows: DataFrame, ks: Sequence[int], metrics: Sequence[str], size: int = 0
) -> DataFrame:
    """:func:`_sums` of each ``version``, where rows have an array of scores.

    Rows are brought together once, and have their place in the ideal list, which no
    prediction changes, before they are a row per version.
    """
    # Their number is given, or few tasks would get rows that are many only later.
    dealt_to = max(1, -(-size // VERSION_ROWS))
    near, query = hashed(rows.repartition(dealt_to, "qid"))
    best = Window.partitionBy(*query).orderBy(F.desc("label"))
    near = _by_version(near.withColumn("best", F.row_number().over(best)))
    ranked = Window.partitionBy(*query, "version").orderBy(F.desc("score"), F.col("item"))
    tied = Window.partitionBy(*query, "version").orderBy(F.desc("score")).rangeBetween(0, 0)
    positive = F.col("label") > 0
    so_far = F.sum(positive.cast("int")).over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    placed = near.withColumns({"rank": F.row_number().over(ranked), "so_far": so_far})
    placed = placed.withColumns(
        {
            "gain": F.avg("label").over(tied) * (F.lit(1.0) / F.log2(F.col("rank") + 1.0)),
            "ideal": F.col("label") * (F.lit(1.0) / F.log2(F.col("best") + 1.0)),
        }
    )
    sums = {"positives": F.count_if(positive)}
    for k in ks:
        inside = F.col("rank") <= k
        sums |= {
            f"dcg_{k}": F.sum(F.when(inside, F.col("gain"))),
            f"ideal_{k}": F.sum(F.when(F.col("best") <= k, F.col("ideal"))),
            f"hits_{k}": F.count_if(inside & positive),
            f"ap_{k}": F.sum(F.when(inside & positive, F.col("so_far") / F.col("rank"))),
        }
    names = _sum_names(ks, metrics)
    made = placed.groupBy("qid", "version").agg(*[sums[n].alias(n) for n in names])
    return made.select("qid", "version", *names)


def _label_sums(rows: DataFrame, ks: Sequence[int], size: int = 0) -> DataFrame:
    """Positives and ideal gains, which no prediction changes, of queries that fit one task."""
    near, query = together(rows.select("qid", "label"), size=size)
    counts = near.groupBy(*query, "label").agg(F.count(F.lit(1)).alias("size"))
    best = Window.partitionBy(*query).orderBy(F.desc("label"))
    placed = counts.withColumn("end", F.sum("size").over(best))
    return placed.groupBy("qid").agg(
        F.sum(F.when(F.col("label") > 0, F.col("size")).otherwise(0)).alias("positives"),
        *[F.sum(F.col("label") * _discounts(k)).alias(f"ideal_{k}") for k in ks],
    )


def _discounts(k: int) -> Column:
    """The sum of the discounts, up to rank ``k``, of the ``size`` ranks up to ``end``."""
    sums = [0.0]
    for rank in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(rank + 1))
    up_to = F.array(*[F.lit(d) for d in sums])

    def reached(position: Column) -> Column:
        return F.get(up_to, F.least(position, F.lit(k)).cast("int"))

    return reached(F.col("end")) - reached(F.col("end") - F.col("size"))


def _sums_of_large(rows: DataFrame, ks: Sequence[int], metrics: Sequence[str]) -> DataFrame:
    """The same for queries of any size."""
    # Two reads of the rows at most: the first ones of each query, and these counts, from
    # which the gains and the ideal list follow. Each table has a row for every query.
    tables = []
    if "ndcg" in metrics:
        counts = rows.groupBy("qid", "score", "label").agg(F.count(F.lit(1)).alias("size"))
        tables += [
            _tied_gain(counts, "score", ks, "dcg"),
            _tied_gain(
                counts.withColumn("score", F.col("label").cast("float")), "score", ks, "ideal"
            ),
        ]
        positive = F.sum(F.when(F.col("label") > 0, F.col("size")).otherwise(0))
    else:
        counts, positive = rows, F.count_if(F.col("label") > 0)
    if "recall" in metrics:
        tables.append(counts.groupBy("qid").agg(positive.alias("positives")))
    if set(metrics) - {"ndcg"}:
        tables.append(_hits(rows, ks))
    joined = tables[0]
    for table in tables[1:]:
        joined = joined.join(table, "qid", "left")
    return joined.select("qid", *_sum_names(ks, metrics))


def metric_table(df: DataFrame, ks: Sequence[int] = DEFAULT_KS, **columns) -> DataFrame:
    """``k, ndcg, recall, precision, map``: the means over all queries."""
    ks = sorted(set(ks))
    per_query = query_metrics(df, ks, **columns)
    means = per_query.agg(
        *[F.avg(f"{m}_{k}").alias(f"{m}_{k}") for k in ks for m in METRICS]
    )
    rows = [
        F.struct(F.lit(k).alias("k"), *[F.col(f"{m}_{k}").alias(m) for m in METRICS])
        for k in ks
    ]
    return means.select(F.inline(F.array(*rows)))


def ndcg_at(df: DataFrame, k: int, **columns) -> DataFrame:
    return _single("ndcg", df, k, columns)


def recall_at(df: DataFrame, k: int, **columns) -> DataFrame:
    return _single("recall", df, k, columns)


def precision_at(df: DataFrame, k: int, **columns) -> DataFrame:
    return _single("precision", df, k, columns)


def map_at(df: DataFrame, k: int, **columns) -> DataFrame:
    return _single("map", df, k, columns)


def compare_models(
    best: DataFrame,
    default: DataFrame,
    best_prefix: str = "best_",
    default_prefix: str = "default_",
) -> DataFrame:
    """Two metric tables side by side on ``k``, columns ordered by metric."""
    left = prefixed(best, best_prefix, keep=["k"])
    right = prefixed(default, default_prefix, keep=["k"])
    return metric_columns_in_order(
        left.join(right, "k", "full"), "k", [best_prefix, default_prefix]
    )


class RankingScorer(Evaluator):
    """A named metric at k as an ``Evaluator``; larger is better."""

    def __init__(self, metric: str = "ndcg", k: int = 5, name: str | None = None, **columns):
        super().__init__()
        if metric not in METRICS:
            raise ValueError(f"unknown metric: {metric}")
        self.metric, self.k = metric, k
        self.name = name or f"{metric}_at_{k}"
        self.columns = columns

    def _evaluate(self, dataset: DataFrame) -> float:
        table = _single(self.metric, dataset, self.k, self.columns)
        return float(table.first()[self.metric] or 0.0)

    def isLargerBetter(self) -> bool:
        return True


def _single(metric: str, df: DataFrame, k: int, columns: dict) -> DataFrame:
    per_query = query_metrics(df, [k], metrics=[metric], **columns)
    return per_query.agg(F.avg(f"{metric}_{k}").alias(metric))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _hits(rows: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Positives in the top k and the sum of (positives so far / rank) over them."""
    top = top_k_within(rows, ["qid"], [F.desc("score"), F.col("item")], max(ks))
    positive = (F.col("label") > 0).cast("int")
    so_far = F.sum(positive).over(Window.partitionBy("qid").orderBy("rank"))
    precision = F.when(F.col("label") > 0, so_far / F.col("rank")).otherwise(F.lit(0.0))
    marked = top.withColumn("precision", precision)
    aggregates = []
    for k in ks:
        inside = F.col("rank") <= k
        aggregates += [
            F.count_if(inside & (F.col("label") > 0)).alias(f"hits_{k}"),
            F.sum(F.when(inside, F.col("precision")).otherwise(0.0)).alias(f"ap_{k}"),
        ]
    return marked.groupBy("qid").agg(*aggregates)


def _tied_gain(counts: DataFrame, score: str, ks: Sequence[int], out: str) -> DataFrame:
    """Discounted gain in which tied rows share the mean label of their group."""
    top = max(ks)
    labelled = F.when(F.col("label").isNotNull(), F.col("size"))
    groups = counts.groupBy("qid", score).agg(
        (F.sum(F.col("label") * F.col("size")) / F.sum(labelled)).alias("gain"),
        F.sum("size").alias("size"),
    )
    # Each group has a row or more, so the first `top` groups cover the top ranks.
    first = top_k_within(groups, ["qid"], [F.desc(score)], top, out="place")
    end = F.sum("size").over(Window.partitionBy("qid").orderBy("place"))
    placed = first.withColumn("end", end)
    return placed.groupBy("qid").agg(
        *[F.sum(F.col("gain") * _discounts(k)).alias(f"{out}_{k}") for k in ks]
    )
