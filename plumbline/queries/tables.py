"""Driver tables in the roles of users, items and interactions, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import epoch_seconds, hash_number
from plumbline.operators.interactions import number_interactions
from plumbline.operators.negatives import with_negatives
from plumbline.sources.state import cut_lineage

KEYS = ["l_orderkey", "l_linenumber", "item_id", "l_suppkey", "l_extendedprice", "l_ship"]
SEED = 42
NEGATIVES = 5
COLUMNS = {"user": "user_id", "item": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def finite(column: str) -> Column:
    value = F.col(column)
    return F.when(F.abs(value) != float("inf"), value)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order: month, target and numeric columns."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "o_custkey",
        "l_returnflag",
        "l_quantity",
        "l_extendedprice",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
    )


SALES_SQL = """sales AS (
  SELECT o_custkey, l_returnflag, l_quantity, l_extendedprice,
         strftime(o_orderdate, '%Y-%m') AS month,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("rating"),
        epoch_seconds("o_orderdate").alias("ts"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        epoch_seconds("l_shipdate").alias("l_ship"),
    )


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["user_id", "item_id", "rating", "ts"]
    return number_interactions(interactions(spark, sf_dir), "user_id", "ts", KEYS, kept)


def labelled(
    spark: SparkSession, sf_dir: str, positives: DataFrame | None = None
) -> DataFrame:
    """Positives and negatives, from one stored copy of the numbered interactions."""
    if positives is None:
        positives = cut_lineage(numbered(spark, sf_dir))
    return with_negatives(positives, NEGATIVES, SEED, **COLUMNS)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
    )


USER_COLUMNS = ["user_id", "segment", "nation", "balance"]
ITEM_COLUMNS = ["item_id", "type", "brand", "size"]


def fixed_score() -> Column:
    """A repeatable stand-in for a model, with ties."""
    return (hash_number(F.col("user_id"), F.col("item_id")) % 20) / F.lit(20.0)


INTERACTIONS_SQL = """interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, l_quantity AS rating,
         epoch(o_orderdate)::BIGINT AS ts, l_orderkey, l_linenumber, l_suppkey,
         l_extendedprice, epoch(l_shipdate)::BIGINT AS l_ship
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ORDER_SQL = (
    "ts DESC, l_orderkey, l_linenumber, item_id, l_suppkey, l_extendedprice, l_ship"
)

NUMBERED_SQL = f"""{INTERACTIONS_SQL},
numbered AS (
  SELECT user_id, item_id, rating, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY {_ORDER_SQL}) AS interaction_num,
         row_number() OVER (ORDER BY user_id, {_ORDER_SQL}) - 1 AS qid
  FROM interactions)"""


def hash_sql(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


def _draws_sql() -> str:
    """Five distinct numbers below ``free``, one step per draw."""
    steps, chosen = [], []
    source = "drawing"
    for j in range(NEGATIVES):
        top = f"(free - {NEGATIVES} + {j})"
        pick = f"({hash_sql(str(SEED), 'qid', str(j))} % ({top} + 1))"
        taken = f"{pick} IN ({', '.join(chosen)})" if chosen else "false"
        steps.append(
            f"step{j} AS (SELECT *, CASE WHEN {taken} THEN {top} ELSE {pick} END AS d{j} "
            f"FROM {source})"
        )
        source = f"step{j}"
        chosen.append(f"d{j}")
    return ",\n".join(steps)


def _negatives_sql(numbered: str) -> str:
    """Negatives and labelled rows of the table ``numbered`` that the text defines."""
    return f"""{numbered},
catalogue AS (
  SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS position
  FROM (SELECT DISTINCT item_id FROM numbered)),
owned AS (
  SELECT DISTINCT user_id, position FROM numbered JOIN catalogue USING (item_id)),
gaps AS (
  SELECT user_id, list(gap ORDER BY gap) AS gaps,
         (SELECT count(*) FROM catalogue) - count(*) AS free
  FROM (SELECT user_id, position - row_number() OVER (
          PARTITION BY user_id ORDER BY position) + 1 AS gap FROM owned)
  GROUP BY user_id),
drawing AS (SELECT n.*, g.free FROM numbered n JOIN gaps g USING (user_id)),
{_draws_sql()},
drawn AS (
  SELECT user_id, rating, ts, interaction_num, qid,
         unnest([{', '.join(f'd{j}' for j in range(NEGATIVES))}]) AS draw
  FROM step{NEGATIVES - 1}),
placed AS (
  SELECT d.*, draw + len(list_filter(g.gaps, lambda gap: gap <= draw)) AS position
  FROM drawn d JOIN gaps g USING (user_id)),
negatives AS (
  SELECT user_id, item_id, rating, ts, interaction_num, qid, 0 AS label
  FROM placed JOIN catalogue USING (position)),
labelled AS (
  SELECT user_id, item_id, rating, ts, interaction_num, qid, 1 AS label FROM numbered
  UNION ALL SELECT * FROM negatives)"""


NEGATIVES_SQL = _negatives_sql(NUMBERED_SQL)
NEGATIVES_HOT_SQL = _negatives_sql(
    NUMBERED_SQL.replace("numbered AS (", "plain AS (", 1)
    + """,
numbered AS (
  SELECT CASE WHEN item_id % 2 = 0 THEN 1 ELSE user_id END AS user_id, item_id, rating, ts,
         interaction_num, qid FROM plain)"""
)

SCORE_SQL = f"({hash_sql('user_id', 'item_id')} % 20) / 20.0"
