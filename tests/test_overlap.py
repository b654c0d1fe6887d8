"""Scores of adjacent chunks (M1-M5, V10), of many pairs at once."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textrail.operators import features as FE
from textrail.operators import metrics as M

ODD = [("", ""), (None, "a b"), ("a", None), ("a", "a"), ("a b a b a", "b a b a b a"), ("---", "--- ---"), ("x\ny z", "x y\nz"),
       ("  a\tb ΟΔΟΣ ΟΔΟΣ.\x1c x", "a b οδος İx  ΟΔΟΣ")]


def test_batches_score_as_single_pairs_do(monkeypatch):
    rng = random.Random(1)
    kinds = ["aa", "bb", "A,b", "c-d", "Σ", "ΑΣ", "", "", "x\x85y", "p\nq"]
    pairs = ODD + [tuple(" ".join(rng.choices(kinds, k=rng.randint(0, 12))) for _ in "ab") for _ in range(300)]
    monkeypatch.setattr(M, "SLICE", 200)
    a, b = (pa.array(s) for s in zip(*pairs))
    assert M.in_slices(M.batch_scores, a, b).to_pylist() == [M.pair_scores(*p) for p in pairs]
    assert not len(M.in_slices(M.batch_scores, a[:0], b[:0]))


ROWS = [(1, 0, "ab cd ab Ef"), (1, 1, "ab, ef gh x"), (1, 2, "zz"), (2, 0, "ab zz"), (2, 0, "cd cd"), (2, 1, "zz cd"), (2, 1, "ab kk"), (2, 1, ""),
        (3, 0, "- x"), (3, 1, "ab"), (None, 0, "ab"), (None, 1, "ab"), (4, 1, "zz"), (4, 3, "zz"), *[(5, i, f"ab w{i} w{i + 1}") for i in range(150)]]


def _chunks(spark):
    return spark.createDataFrame(ROWS, "doc bigint, no bigint, text string")


def test_adjacent_pairs_are_those_of_a_join_and_texts_are_exchanged_once(spark):
    pairs = M.adjacent_pairs(_chunks(spark), "doc", "no", "text")
    want = sorted((d, n, x, y) for d, n, x in ROWS for e, m, y in ROWS if d is not None and d == e and m == n + 1)
    assert sorted(map(tuple, pairs.collect())) == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.adjacent_pairs(_chunks(spark), "doc", "no", "text")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("common", [0, 3, 1000])
def test_pair_cosine_is_the_cosine_of_the_tfidf_table(spark, common):
    chunks = _chunks(spark)
    cid = F.struct("doc", "no")
    ids = chunks.select(cid.alias("cid"), "text")
    tv = FE.tfidf(ids, "cid", "text")
    pairs = M.adjacent_pairs(chunks, "doc", "no", "text")
    keyed = pairs.select("doc", "no", cid.alias("ida"), F.struct("doc", (F.col("no") + 1).alias("no")).alias("idb"))
    cos = FE.sparse_cosine(tv.withColumnRenamed("cid", "ida"), tv.withColumnRenamed("cid", "idb"), "ida", "idb", keyed)
    want = pairs.select("doc", "no").join(keyed, ["doc", "no"]).join(cos, ["ida", "idb"]).select("doc", "no", "cosine").collect()
    got = FE.pair_cosine(pairs, ["doc", "no"], "text_a", "text_b", FE.row_idf(ids, "cid", "text"), common=common)
    assert got.columns == ["doc", "no", "cosine"]
    as_rows = lambda rows: sorted((r["doc"], r["no"], round(r["cosine"], 9)) for r in rows)
    assert as_rows(got.collect()) == as_rows(want)


def test_report_exchanges_no_row_per_chunk_and_term(spark, tmp_path, monkeypatch):
    from textrail.plans import metric_plans
    rows = [(i, " ".join(f"w{i % 3} v{j % 7}" for j in range(400))) for i in range(4)] + [(9, "short"), (10, None), (None, "a b " * 300)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(FE, "tfidf", lambda *a, **k: pytest.fail("a row per chunk and term"))
    got = metric_plans.overlap_report(spark, str(tmp_path)).first()
    assert got["n_pairs"] == 4 and 0.9 < got["avg_cosine"] <= 1.0
