"""Exact nearest rows through pivot cells: brute force, pruning, hot cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from textrail.operators import cells as C


def table(spark, x, name="vec_id", col="embedding"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{name} long, {col} array<double>")


def found(spark, x, q, **more):
    rows = C.nearest(table(spark, x), table(spark, q, "query_id", "qvec"), **more).orderBy("query_id", "rank").collect()
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out, rows


def brute(x, q, k, metric, exclude_self):
    out = {}
    for i, one in enumerate(q):
        s = C._exact(metric, np.broadcast_to(one, x.shape), x)
        s = np.where(np.isnan(s), np.inf, s)
        if exclude_self:
            s[i] = np.inf
        order = np.lexsort((np.arange(len(x)), s))[:k]
        out[i] = [int(j) for j in order if np.isfinite(s[j])]
    return out


def clustered(n, dim, centres, spread, seed=0, offset=0.0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim)) + offset


@pytest.mark.parametrize("metric", ["l2sq", "cosine"])
@pytest.mark.parametrize("x", [clustered(900, 6, 12, 0.1), clustered(700, 6, 1, 1.0), clustered(600, 3, 5, 0.01, offset=1e6),
                               np.repeat(clustered(40, 4, 4, 0.2), 20, axis=0), np.round(clustered(600, 2, 3, 0.5), 1)], ids=["clusters", "cloud", "far", "repeated", "grid"])
def test_equals_brute_force(spark, x, metric):
    got, rows = found(spark, x, x, k=4, metric=metric, exclude_self=True, block_rows=64)
    want = brute(x, x, 4, metric, True)
    score = {(r.query_id, r.vec_id): r.score for r in rows}
    for i, ids in want.items():
        # places may differ among equal scores up to rounding only
        s = C._exact(metric, np.broadcast_to(x[i], (len(ids), x.shape[1])), x[ids])
        assert np.allclose([score[i, j] for j in got.get(i, [])], s, rtol=1e-9, atol=1e-12)
    assert sum(got.get(i, []) != w for i, w in want.items()) <= (0 if metric == "l2sq" else len(x) // 10)


def test_outer_queries_and_few_rows(spark):
    x, q = clustered(500, 5, 8, 0.1), clustered(60, 5, 8, 0.1, seed=9) * 5
    assert found(spark, x, q, k=3, block_rows=50)[0] == brute(x, q, 3, "l2sq", False)
    assert found(spark, x[:2], q, k=5)[0] == brute(x[:2], q, 5, "l2sq", False)
    assert found(spark, x[:0].reshape(0, 5), q, k=5)[0] == {} == found(spark, x, x[:0], k=5)[0]


def test_a_hot_vector_is_dealt_to_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_VISITS", 100)
    x = np.concatenate([np.ones((600, 3)), clustered(300, 3, 4, 0.3)])
    cells, placed, _ = C.build_cells(C._usable(table(spark, x), "vec_id", "embedding", "l2sq"), "l2sq", 100)
    assert cells.pieces.max() > 1
    sizes = [r["count"] for r in C._in_block(placed, cells).groupBy("block").count().collect()]
    assert sum(sizes) == 900 and max(sizes) < 400
    assert found(spark, x, x, k=3, exclude_self=True, block_rows=100)[0] == brute(x, x, 3, "l2sq", True)


def test_odd_vectors_take_no_part(spark):
    rows = [(1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [1.0]), (6, [3.0, 4.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asks = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec")).where("query_id is not null")
    got = C.nearest(df.where("vec_id is not null"), asks, 5).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(a, b) for a in (1, 6) for b in (1, 6)}
    cos = C.nearest(df.where("vec_id is not null"), asks, 5, metric="cosine").collect()
    assert {(r.query_id, r.vec_id) for r in cos} == {(6, 6)}


def test_most_products_are_ruled_out(spark):
    n = 20_000
    x = clustered(n, 16, 150, 0.15, seed=4)
    df = spark.range(n).select(F.col("id").alias("vec_id")).repartition(8)
    box = x.tolist()
    pick = F.udf(lambda i: box[i], "array<double>")
    df = df.withColumn("embedding", pick("vec_id")).checkpoint()
    asks = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qvec"))
    out = C.nearest(df, asks, 5, exclude_self=True, block_rows=2000).checkpoint()
    seen = out.where("rank = 1").agg(F.avg("seen").alias("seen")).first().seen
    assert (seen + C.MAX_PIVOTS // 7) / n < 0.2
    some = np.random.default_rng(0).integers(0, n, 50).tolist()
    got = {}
    for r in out.where(F.col("query_id").isin(some)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for i in set(some):
        s = ((x - x[i]) ** 2).sum(1)
        s[i] = np.inf
        assert got[i] == np.argsort(s, kind="stable")[:5].tolist()
