"""Nearest neighbours against brute force: whole results, scores, ties and recall."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import neighbours, queries

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, v INT, k1 STRING, rank INT, unit INT"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], schema)


def brute(rows, k, step):
    """Exact result by the operator's rules; rows of (id, vector)."""
    distinct = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        distinct[i, tuple(float(np.float32(x)) for x in v)] = None
    made = {}
    for i, v in distinct:
        if i % step:
            continue
        scored = [
            (-float((np.array(v) * np.array(w)).sum()), j)
            for j, w in distinct
            if len(w) == len(v) and (j, w) != (i, v)
        ]
        made.setdefault(i, []).append([(j, -s) for s, j in sorted(scored)[:k]])
    return made


def found(df):
    made = {}
    for r in df.orderBy("query_id", "rank").collect():
        made.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return made


def test_query_recall_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, got = brute(rows, 20, 20), found(queries.QUERIES["op13_neighbours"](spark, SF_DIR))
    vectors = {i: np.array(v, float) for i, v in rows}
    assert got.keys() == expected.keys()
    met = 0
    for q, (right,) in expected.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        met += len({j for j, _ in right} & {j for _, j, _ in got[q]})
        for _, j, score in got[q]:
            assert score == pytest.approx(float(vectors[q] @ vectors[j]), abs=1e-12)
    assert met / (20 * len(expected)) >= 0.9


@pytest.mark.parametrize("small", [False, True])
def test_norms_copies_ties_and_odd_rows(spark, monkeypatch, small):
    """Copies in hundreds, norms over many orders, equal scores; blocks of any size."""
    if small:
        monkeypatch.setattr(neighbours, "BLOCK_BYTES", 600)
        monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 7)
        monkeypatch.setattr(neighbours, "BUCKET_ROWS", 4)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-3, 4, 6) * 2.0 ** rng.integers(-6, 7)).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 0.0, 2.0, 0.0, 0.0, 1.0]) for i in range(300)]
    rows += [(2000 + i, [0.0, -0.0, 1.0]) for i in range(9)] + [(2020, [0.0, 0.0, 1.0])]
    rows += [(None, [1.0] * 6), (40, None), (60, []), (80, [0.0] * 6), (100, [1.0, None] * 3)]
    rows += [(120, [float("nan")] + [1.0] * 5), (140, [float("inf")] + [1.0] * 5), (7000, [5.0, 5.0])]
    rows += [(20, [9.0, 0.0, 0.0, 0.0, 0.0, 0.0]), *rows[:50]]
    got = found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5))
    expected = brute(rows, 5, 20)
    met = total = 0
    for q, lists in expected.items():
        if not any(lists):
            assert q not in got
            continue
        assert len(got[q]) == sum(map(len, lists))
        if len(lists) == 1:
            assert [r for r, _, _ in got[q]] == list(range(1, len(lists[0]) + 1))
            met += len({j for j, _ in lists[0]} & {j for _, j, _ in got[q]})
            total += len(lists[0])
    assert met / total >= 0.95
    copy = [1.0, 0.0, 2.0, 0.0, 0.0, 1.0]
    assert any(v == copy and i % 20 == 0 for i, v in rows)


def test_empty_and_single(spark):
    nobody = neighbours.nearest(frame(spark, []), F.col("vec_id") % 20 == 0)
    assert nobody.columns == ["query_id", "rank", "vec_id", "score"] and nobody.count() == 0
    alone = neighbours.nearest(frame(spark, [(20, [1.0, 2.0])]), F.col("vec_id") % 20 == 0)
    assert alone.count() == 0
    two = neighbours.nearest(frame(spark, [(20, [1.0, 2.0]), (3, [1.0, 2.0])]), F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in two.collect()] == [(20, 1, 3, 5.0)]


def test_many_names_order_buckets_by_score():
    """The visiting order over several names is the order of the sums of their scores."""
    space = neighbours.Space(7, 0.5, 1.0, 100, 3, (8, 8, 3))
    points = np.random.default_rng(2).normal(size=(5, 7))
    codes, sums = neighbours.probed(points, space, 0, 50)
    per_name = neighbours._axis_scores(neighbours._directions(points, space), space, 0)
    for q in range(5):
        every = (per_name[0][q][:, None, None] + per_name[1][q][:, None] + per_name[2][q]).ravel()
        assert np.allclose(sums[q], np.sort(every)[::-1][:50])
        assert np.allclose(every[codes[q]], sums[q])
