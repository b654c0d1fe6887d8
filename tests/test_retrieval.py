"""Exact top-k against NumPy brute force; index CRUD; TF-IDF; snippets."""

import math

import numpy as np
from pyspark.sql import functions as F

from textrail.operators import features as FE
from textrail.operators import retrieval as R


def vec_df(spark, mat, id_name="vec_id", col="embedding"):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(mat)], f"{id_name} long, {col} array<double>")


def brute_l2(V, Q, k):
    out = {}
    for qi, q in enumerate(Q):
        d = ((V - q) ** 2).sum(1)
        order = sorted(range(len(V)), key=lambda j: (d[j], j))[:k]
        out[qi] = [(j, d[j]) for j in order]
    return out


def test_topk_l2_matches_bruteforce_with_ties(spark):
    rnd = np.random.default_rng(1)
    V = rnd.normal(size=(300, 8))
    V[10] = V[11]  # duplicate vector -> equal distances, smaller id wins
    Q = np.vstack([V[10], rnd.normal(size=(40, 8))])
    out = R.topk(vec_df(spark, V), vec_df(spark, Q, "query_id", "qvec"), k=5, block_rows=64).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["distance"]))
    exp = brute_l2(V, Q, 5)
    assert got.keys() == exp.keys()
    for q in exp:
        assert [j for j, _ in got[q]] == [j for j, _ in exp[q]]
        assert all(math.isclose(a, b, abs_tol=1e-9) for (_, a), (_, b) in zip(got[q], exp[q]))
    assert [j for j, _ in got[0][:2]] == [10, 11]


def test_topk_k_larger_than_table(spark):
    V = np.eye(3)
    out = R.topk(vec_df(spark, V), vec_df(spark, V[:1], "query_id", "qvec"), k=10).collect()
    assert sorted(r["vec_id"] for r in out) == [0, 1, 2]


def test_cosine_topk_skips_zero_vectors(spark):
    V = np.array([[0.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1.0, 1.0]])
    out = R.pairwise_topk(vec_df(spark, V), k=2).collect()
    assert all(r["vec_id"] != 0 for r in out)
    q1 = sorted([r for r in out if r["query_id"] == 1], key=lambda r: r["rank"])
    assert q1[0]["vec_id"] == 3 and math.isclose(q1[0]["similarity"], 1 / math.sqrt(2), rel_tol=1e-9)


def test_rerank_keeps_two_by_cosine(spark):
    hits = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 2, [0.0, 1.0]), (0, 3, [1.0, 1.0])],
                                 "query_id long, vec_id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.1])], "query_id long, qvec array<double>")
    out = R.rerank(hits, q, keep=2).orderBy("rerank").collect()
    assert [r["vec_id"] for r in out] == [1, 3]


def test_index_crud_scenario(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "vec_id long, text string")
    changes = spark.createDataFrame([(4, "add", "d", 1), (2, "update", "B", 2), (9, "update", "x", 3),
                                     (3, "delete", None, 4), (8, "delete", None, 5), (1, "add", "A", 6)],
                                    "vec_id long, op string, text string, seq int")
    out = {r["vec_id"]: r["text"] for r in R.index_apply(index, changes).collect()}
    assert out == {1: "A", 2: "B", 4: "d"}
    ids = spark.createDataFrame([(1,), (3,)], "vec_id long")
    got = {r["vec_id"]: r["text"] for r in R.index_get(R.index_apply(index, changes), ids).collect()}
    assert got == {1: "A", 3: "[DELETED]"}


def py_tfidf(docs):
    import re
    # the vectoriser's default token pattern
    toks = {i: re.findall(r"(?u)\b\w\w+\b", t.lower()) for i, t in docs.items()}
    n = len(docs)
    df = {}
    for ws in toks.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = {}
    for i, ws in toks.items():
        raw = {w: ws.count(w) * (math.log((1 + n) / (1 + df[w])) + 1) for w in set(ws)}
        nrm = math.sqrt(sum(v * v for v in raw.values()))
        out[i] = {w: v / nrm for w, v in raw.items()}
    return out


def test_tfidf_matches_python(spark):
    docs = {0: "The cat sat on the mat", 1: "the dog sat", 2: "a b cc dd cc", 3: "Éclair café au lait"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {}
    for r in FE.tfidf(df, "doc_id", "text").collect():
        got.setdefault(r["doc_id"], {})[r["term"]] = r["weight"]
    exp = py_tfidf(docs)
    assert got.keys() == exp.keys()
    for i in exp:
        assert got[i].keys() == exp[i].keys()
        assert all(math.isclose(got[i][w], exp[i][w], rel_tol=1e-12) for w in exp[i])


def test_sparse_topk_matches_bruteforce(spark):
    rnd = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(30)]
    docs = {i: " ".join(rnd.choice(vocab, size=12)) for i in range(60)}
    qs = {i: " ".join(rnd.choice(vocab, size=4)) for i in range(15)}
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    q = spark.createDataFrame(list(qs.items()), "query_id long, text string")
    idf = FE.idf_table(FE.term_counts(d, "doc_id", "text"), "doc_id", len(docs))
    dv, qv = FE.tfidf(d, "doc_id", "text", fit=idf), FE.tfidf(q, "query_id", "text", fit=idf)
    got = FE.topk_sparse(dv, qv, k=3, block=7).collect()
    D = {}
    for r in dv.collect():
        D.setdefault(r["doc_id"], {})[r["term"]] = r["weight"]
    Qv = {}
    for r in qv.collect():
        Qv.setdefault(r["query_id"], {})[r["term"]] = r["weight"]
    for qi, qw in Qv.items():
        scores = [(round(sum(w * D[di].get(t, 0.0) for t, w in qw.items()), 9), di) for di in D]
        scores = [s for s in scores if s[0] > 0]
        exp = [di for _, di in sorted(scores, key=lambda s: (-s[0], s[1]))[:3]]
        assert [r["doc_id"] for r in sorted([r for r in got if r["query_id"] == qi], key=lambda r: r["rank"])] == exp


def test_best_snippet_prefers_earlier_on_ties(spark):
    from textrail.operators.snippets import best_snippet
    docs = spark.createDataFrame([(1, "Red apples grow. Blue sky today. Red apples grow."), (2, "Nothing here.")],
                                 "doc_id long, text string")
    hits = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id long, doc_id long, rank long")
    qs = spark.createDataFrame([(0, "red apples")], "query_id long, text string")
    r = best_snippet(hits, docs, qs).collect()[0]
    assert r["source_doc"] == 1 and r["sent_no"] == 0 and r["snippet"] == "Red apples grow."
