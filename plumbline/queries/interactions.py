"""Interaction preparation, negatives, splits, features and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import interactions as ops
from plumbline.operators.counts import group_sizes, value_counts_within
from plumbline.operators.counts import label_counts as count_labels
from plumbline.operators.encoders import FrequencyEncode, StandardScale
from plumbline.operators.features import decode_ids, dense_ids, encode_ids, join_features
from plumbline.operators.negatives import negative_samples as sample_negatives
from plumbline.operators.recommend import candidates
from plumbline.queries.tables import (
    COLUMNS,
    INTERACTIONS_SQL,
    ITEM_COLUMNS,
    KEYS,
    NEGATIVES,
    NEGATIVES_HOT_SQL,
    NEGATIVES_SQL,
    NUMBERED_SQL,
    SEED,
    USER_COLUMNS,
    hash_sql,
    interactions,
    items,
    labelled,
    numbered,
    table,
    rounded,
    users,
)
from plumbline.sources.state import cut_lineage

TEST_USERS = 100


def recency_rank(spark, d):
    ranked = ops.number_interactions(interactions(spark, d), "user_id", "ts", KEYS)
    return ranked.select("user_id", "l_orderkey", "l_linenumber", "item_id", "interaction_num")


def query_ids(spark, d):
    return numbered(spark, d).select("qid", "user_id", "item_id", "ts")


def dense_user_ids(spark, d):
    return dense_ids(interactions(spark, d), "user_id")


def encoded_ids(spark, d):
    df = interactions(spark, d).select("user_id", "item_id", "l_orderkey")
    for column in ("user_id", "item_id"):
        df = encode_ids(df, column, dense_ids(df, column))
    return df


def decoded_ids(spark, d):
    df = interactions(spark, d).select("user_id", "l_orderkey", "item_id")
    ids = dense_ids(df, "user_id")
    coded = encode_ids(df, "user_id", ids).drop("user_id_str")
    return decode_ids(coded, "user_id", ids, out="user_id_str")


def user_item_sets(spark, d):
    return ops.user_items(interactions(spark, d), "user_id", "item_id")


def unseen_items(spark, d):
    df = interactions(spark, d)
    pairs = candidates(users(spark, d), df, 10, **COLUMNS)
    return ops.drop_seen(pairs, df, **COLUMNS)


def negative_samples(spark, d):
    positives = cut_lineage(numbered(spark, d))
    return sample_negatives(positives, NEGATIVES, SEED, **COLUMNS)


def negative_samples_hot(spark, d):
    """All lines of every second item belong to one customer."""
    hot = numbered(spark, d).withColumn(
        "user_id", F.when(F.col("item_id") % 2 == 0, 1).otherwise(F.col("user_id")).cast("long")
    )
    return sample_negatives(cut_lineage(hot), NEGATIVES, SEED, **COLUMNS)


def pos_neg_union(spark, d):
    return labelled(spark, d)


def label_counts(spark, d):
    return count_labels(labelled(spark, d), "label")


def query_group_sizes(spark, d):
    return group_sizes(labelled(spark, d), "qid")


def sampled_users(spark, d):
    return ops.sample_users(interactions(spark, d), TEST_USERS, SEED)


def _split(spark, d):
    return ops.assign_split(
        labelled(spark, d), TEST_USERS, SEED, sample_from=interactions(spark, d)
    )


def split_train(spark, d):
    return ops.split_of(_split(spark, d), "train")


def split_val(spark, d):
    return ops.split_of(_split(spark, d), "val")


def split_test(spark, d):
    return ops.split_of(_split(spark, d), "test")


def split_label_counts(spark, d):
    counts = value_counts_within(_split(spark, d), "label", "split")
    return rounded(counts, "percentage")


def join_user_item_features(spark, d):
    df = numbered(spark, d)
    return join_features(
        df, users(spark, d), items(spark, d), USER_COLUMNS, ITEM_COLUMNS, **COLUMNS
    )


def scaled_numeric(spark, d):
    df = users(spark, d)
    scaled = StandardScale(["balance"]).fit(df).transform(df)
    return rounded(scaled.select("user_id", "balance"), "balance")


def frequency_encoded(spark, d):
    df = users(spark, d).select("user_id", "segment", "nation")
    return FrequencyEncode(["segment", "nation"]).fit(df).transform(df)


def frequency_encoded_many(spark, d):
    """A column with as many categories as there are orders."""
    df = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order"), F.col("o_orderkey").alias("code"), "o_orderpriority"
    )
    return FrequencyEncode(["code", "o_orderpriority"]).fit(df).transform(df)


def encoded_with_unknown(spark, d):
    """Fitted on the small parts only; brands are NULL for the largest sizes."""
    df = items(spark, d).select(
        "item_id", "size", F.when(F.col("size") <= 45, F.col("brand")).alias("brand")
    )
    model = FrequencyEncode(["brand", "size"]).fit(df.where("size <= 25 or size > 48"))
    return model.transform(df)


QUERIES = {
    f.__name__: f
    for f in (
        recency_rank,
        query_ids,
        dense_user_ids,
        encoded_ids,
        decoded_ids,
        user_item_sets,
        unseen_items,
        negative_samples,
        negative_samples_hot,
        pos_neg_union,
        label_counts,
        query_group_sizes,
        sampled_users,
        split_train,
        split_val,
        split_test,
        split_label_counts,
        join_user_item_features,
        scaled_numeric,
        frequency_encoded,
        frequency_encoded_many,
        encoded_with_unknown,
    )
}


def _ids_sql(column: str, name: str) -> str:
    return f"""{name} AS (
  SELECT text, row_number() OVER (ORDER BY text) AS id
  FROM (SELECT DISTINCT {column}::VARCHAR AS text FROM interactions))"""


_SPLIT = f"""WITH {NEGATIVES_SQL},
test_users AS (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM labelled WHERE interaction_num = 1)
  ORDER BY {hash_sql(str(SEED), "user_id")}, user_id LIMIT {TEST_USERS}),
split AS (
  SELECT *, CASE WHEN interaction_num <> 1 THEN 'train'
    WHEN user_id IN (SELECT user_id FROM test_users) THEN 'test' ELSE 'val' END AS split
  FROM labelled)"""


def _split_sql(name: str) -> str:
    return f"{_SPLIT} SELECT * EXCLUDE (split) FROM split WHERE split = '{name}'"


def _frequency_sql(source: str, column: str) -> str:
    return f"""SELECT value, row_number() OVER (
    ORDER BY count DESC, value ASC NULLS LAST) AS id
  FROM (SELECT {column}::VARCHAR AS value, count(*) AS count FROM {source} GROUP BY 1)"""


SQL = {
    "recency_rank": f"""WITH {INTERACTIONS_SQL}
SELECT user_id, l_orderkey, l_linenumber, item_id, row_number() OVER (
  PARTITION BY user_id ORDER BY ts DESC, l_orderkey, l_linenumber, item_id, l_suppkey,
  l_extendedprice, l_ship) AS interaction_num
FROM interactions""",
    "query_ids": f"WITH {NUMBERED_SQL} SELECT qid, user_id, item_id, ts FROM numbered",
    "dense_user_ids": f"WITH {INTERACTIONS_SQL}, {_ids_sql('user_id', 'ids')} SELECT * FROM ids",
    "encoded_ids": f"""WITH {INTERACTIONS_SQL}, {_ids_sql("user_id", "u")},
{_ids_sql("item_id", "i")}
SELECT u.id AS user_id, u.text AS user_id_str, i.id AS item_id, i.text AS item_id_str, l_orderkey
FROM interactions n JOIN u ON n.user_id::VARCHAR = u.text
  JOIN i ON n.item_id::VARCHAR = i.text""",
    "decoded_ids": f"""WITH {INTERACTIONS_SQL}, {_ids_sql("user_id", "u")}
SELECT u.id AS user_id, n.user_id::VARCHAR AS user_id_str, l_orderkey, item_id
FROM interactions n JOIN u ON n.user_id::VARCHAR = u.text""",
    "user_item_sets": f"""WITH {INTERACTIONS_SQL}
SELECT DISTINCT user_id, item_id FROM interactions""",
    "unseen_items": f"""WITH {INTERACTIONS_SQL},
popular AS (
  SELECT item_id FROM interactions GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 10)
SELECT c_custkey AS user_id, item_id FROM customer, popular
EXCEPT SELECT user_id, item_id FROM interactions""",
    "negative_samples": f"WITH {NEGATIVES_SQL} SELECT * FROM negatives",
    "negative_samples_hot": f"WITH {NEGATIVES_HOT_SQL} SELECT * FROM negatives",
    "pos_neg_union": f"WITH {NEGATIVES_SQL} SELECT * FROM labelled",
    "label_counts": f"""WITH {NEGATIVES_SQL}
SELECT label, count(*) AS count FROM labelled GROUP BY 1""",
    "query_group_sizes": f"""WITH {NEGATIVES_SQL}
SELECT qid, count(*) AS group_size FROM labelled GROUP BY 1""",
    "sampled_users": f"""WITH {INTERACTIONS_SQL}
SELECT user_id FROM (SELECT DISTINCT user_id FROM interactions)
ORDER BY {hash_sql(str(SEED), "user_id")}, user_id LIMIT {TEST_USERS}""",
    "split_train": _split_sql("train"),
    "split_val": _split_sql("val"),
    "split_test": _split_sql("test"),
    "split_label_counts": f"""{_SPLIT},
c AS (SELECT split, label::VARCHAR AS value, count(*) AS count FROM split GROUP BY 1, 2),
t AS (SELECT split, sum(count) AS total FROM c GROUP BY 1)
SELECT split, value, count, round(count / total, 6) AS percentage
FROM (SELECT * FROM c UNION ALL SELECT split, 'total', total FROM t) JOIN t USING (split)""",
    "join_user_item_features": f"""WITH {NUMBERED_SQL}
SELECT n.*, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance,
  p_type AS type, p_brand AS brand, p_size AS size
FROM numbered n LEFT JOIN customer ON n.user_id = c_custkey
  LEFT JOIN part ON n.item_id = p_partkey""",
    "scaled_numeric": """
SELECT c_custkey AS user_id, round((c_acctbal - m) / s, 6) AS balance
FROM customer, (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)""",
    "frequency_encoded": f"""
WITH s AS ({_frequency_sql("customer", "c_mktsegment")}),
n AS ({_frequency_sql("customer", "c_nationkey")})
SELECT c_custkey AS user_id, s.id::INT AS segment, n.id::INT AS nation
FROM customer JOIN s ON c_mktsegment = s.value JOIN n ON c_nationkey::VARCHAR = n.value""",
    "frequency_encoded_many": f"""
WITH c AS ({_frequency_sql("orders", "o_orderkey")}),
p AS ({_frequency_sql("orders", "o_orderpriority")})
SELECT o_orderkey AS "order", c.id::INT AS code, p.id::INT AS o_orderpriority
FROM orders JOIN c ON o_orderkey::VARCHAR = c.value JOIN p ON o_orderpriority = p.value""",
    "encoded_with_unknown": f"""
WITH p AS (
  SELECT p_partkey AS item_id, p_size AS size,
    CASE WHEN p_size <= 45 THEN p_brand END AS brand FROM part),
fitted AS (SELECT * FROM p WHERE size <= 25 OR size > 48),
b AS ({_frequency_sql("fitted", "brand")}),
s AS ({_frequency_sql("fitted", "size")})
SELECT item_id, coalesce(s.id, 0)::INT AS size, coalesce(b.id, 0)::INT AS brand
FROM p LEFT JOIN b ON p.brand IS NOT DISTINCT FROM b.value
  LEFT JOIN s ON p.size::VARCHAR = s.value""",
}
