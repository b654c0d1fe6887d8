"""Hard negatives against brute force, and on odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textrail.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score double"


def brute(rows, low=30, high=90, n_pos=5, n_neg=10):
    """Rows are (id, vector, label, anchor): their place tells equal ids apart."""
    use = [(k, i, [math.floor(256 * float(np.float32(x))) for x in v], lab, a) for k, (i, v, lab, a) in enumerate(rows)
           if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, i, v, lab, a in use:
        if not a:
            continue
        near = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j or 0, kk, jl) for kk, j, w, jl, _ in use if kk != k and len(w) == len(v))
        for p in [n for n in near if n[4] == lab][:n_pos]:
            hard = [n for n in near if n[4] != lab and low * -p[0] <= 100 * -n[0] <= high * -p[0]][:n_neg]
            out += [(i, None if p[1] else p[2], r + 1, None if n[1] else n[2], -p[0], -n[0]) for r, n in enumerate(hard)]
    return sorted(out, key=repr)


def mined(df, **more):
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, F.col("label"), **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 0.5) for i, v, lab, _ in rows], SCHEMA).repartition(3)


def rows_of(n, dim, seed, values):
    rnd = random.Random(seed)
    return [(i, [rnd.choice(values) for _ in range(dim)], rnd.randrange(3), i % 10 == 0) for i in range(n)]


@pytest.mark.parametrize("values", [(-0.5, -0.1, 0.1, 0.3, 0.5), (0.0, 0.25), (-1e4, 3e6, 2e6)])
def test_equals_brute_force(spark, monkeypatch, values):
    # few values: many ties, also between positives and negatives; large ones leave the doubles' exact range
    rows = rows_of(150, 4, 1, values)
    monkeypatch.setattr(negatives, "HELD", 4)
    monkeypatch.setattr(negatives, "STREAMED", 40)
    monkeypatch.setattr(negatives, "STEP", 16)
    assert mined(table(spark, rows)) == brute(rows)
    assert mined(table(spark, rows), low=0, high=100, positives=2, negatives=3) == brute(rows, 0, 100, 2, 3)


def test_a_hot_vector_and_a_hot_label(spark):
    rows = rows_of(90, 3, 2, (-0.3, 0.2, 0.6))
    rows += [(100 + i, [0.2, 0.6, 0.2], 1, (100 + i) % 10 == 0) for i in range(90)]
    assert mined(table(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = rows_of(40, 2, 3, (0.1, 0.4))
    rows += [(200, None, 1, True), (210, [0.1, None], 1, True), (220, [nan, 0.1], 1, True), (230, [0.1, -inf], 1, True), (240, [0.4, 0.4], None, True),
             (None, [0.4, 0.4], 1, False), (None, [0.4, 0.4], 2, False), (250, [0.4, 0.4, 0.4], 1, True), (251, [0.3, 0.4, 0.4], 1, False), (252, [0.2, 0.2, 0.2], 0, False),
             (260, [], 1, True), (261, [], 1, False), (262, [], 2, False), (270, [0.0, 0.0], 1, True)]
    assert mined(table(spark, rows)) == brute(rows)
    assert mined(table(spark, rows).limit(0)) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(10, [0.5, 0.5], 1, True)] * 3 + [(11, [0.3, 0.3], 2, False)] * 2
    got = mined(table(spark, rows))
    assert got == brute(rows)
    assert len(got) == 3 * 2 * 2


def test_bounds():
    for p in (0, 7, -3, 99, 100, 2 ** 61, -2 ** 61):
        least, greatest = negatives._bounds(np.array([p]), 30, 90)
        assert (int(least[0]), int(greatest[0])) == (-(-30 * p // 100), 90 * p // 100)
