"""Pruned text retrieval against brute force; term counts inside the row."""

import random
from collections import Counter, defaultdict

import pytest

from textrail.operators import features as FE
from textrail.operators import postings as P

SCHEMA = "{} long, term string, weight double"


def tables(spark, docs, queries):
    def df(rows, name):
        return spark.createDataFrame([(i, t, w) for i, ws in rows.items() for t, w in ws.items()], SCHEMA.format(name))
    return df(docs, "doc_id"), df(queries, "query_id")


def brute(docs, queries, k):
    out = {}
    for q, ws in queries.items():
        score = {d: sum(w * dw[t] for t, w in ws.items() if t in dw) for d, dw in docs.items() if any(t in dw for t in ws)}
        out[q] = sorted(score, key=lambda d: (-round(score[d], 9), d))[:k]
    return {q: ids for q, ids in out.items() if ids}


def found(hits):
    out = defaultdict(list)
    for r in hits.orderBy("query_id", "rank").collect():
        out[r.query_id].append(r.doc_id)
    return dict(out)


def corpus(n, seed, words=60, own=6):
    """Documents with a few words that all hold ("w0", "w1"), some common and some rare ones."""
    rnd = random.Random(seed)
    docs = {}
    for i in range(n):
        terms = {"w0", "w1"} | {f"w{int(words * rnd.random() ** 3)}" for _ in range(own)} | {f"r{rnd.randrange(n)}"}
        raw = {t: rnd.choice((0.1, 0.2, 0.5, 1.0)) * (0.05 if t in ("w0", "w1") else 1) for t in terms}
        norm = sum(v * v for v in raw.values()) ** 0.5
        docs[i] = {t: v / norm for t, v in raw.items()}
    return docs


@pytest.mark.parametrize("block", [4, 1024])
@pytest.mark.parametrize("k,norm", [(1, None), (5, None), (5, 1.0)])
def test_equals_brute_force(spark, monkeypatch, block, k, norm):
    monkeypatch.setattr(P, "HEAD", 3 if block == 4 else 64)
    docs, queries = corpus(400, 1), {100 + i: ws for i, ws in corpus(30, 2, own=4).items()}
    queries[200] = {"w0": 1.0}  # a word of every document
    queries[201] = {"nowhere": 1.0}
    queries[202] = {"r1": 0.5, "nowhere": 0.5}  # fewer hits than asked for
    d, q = tables(spark, docs, queries)
    assert found(P.topk_text(d, q, k=k, block=block, norm=norm)) == brute(docs, queries, k)


@pytest.mark.parametrize("in_place", [0, 10 ** 6])
def test_lists_and_scoring_in_place_agree(spark, monkeypatch, in_place):
    """Few queries are scored without lists; many by lists; both are exact."""
    monkeypatch.setattr(P, "IN_PLACE", in_place)
    monkeypatch.setattr(P, "PART", 3)
    built = []
    lists = P.impact_lists
    monkeypatch.setattr(P, "impact_lists", lambda *a: built.append(1) or lists(*a))
    docs, queries = corpus(200, 5), corpus(15, 6, own=4)
    queries[200], queries[201] = {"w0": 1.0}, {"r1": 0.5, "nowhere": 0.5}
    d, q = tables(spark, docs, queries)
    assert found(P.topk_text(d, q, k=4)) == brute(docs, queries, 4)
    assert bool(built) == (in_place == 0)


@pytest.mark.parametrize("common", [2, 100_000])
def test_rows_of_some_terms_have_the_norms_of_all(spark, monkeypatch, common):
    monkeypatch.setattr(FE, "COMMON_TERMS", common)
    texts = [(1, "aa bb bb cc"), (2, "aa cc dd dd dd"), (3, "ee ff"), (4, ""), (5, None), (None, "aa gg"), (6, "bb"), (6, "aa bb")]
    d = spark.createDataFrame(texts, "id long, text string")
    tc = FE.term_counts(d, "id", "text")
    idf = FE.idf_table(tc, "id", len(texts))
    only = spark.createDataFrame([("aa",), ("bb",), ("bb",), ("zz",)], "term string")
    want = sorted((str(r.id), r.term, round(r.weight, 12)) for r in FE.tfidf(d, "id", "text", fit=idf, counts=tc).where("term in ('aa', 'bb')").collect())
    got = FE.tfidf(d, "id", "text", fit=idf, counts=tc, only=only)
    assert sorted((str(r.id), r.term, round(r.weight, 12)) for r in got.collect()) == want
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_common_words_are_looked_up_not_joined(spark):
    docs = corpus(3000, 3)
    queries = {i: docs[i * 7] for i in range(20)}  # near one of the documents each
    d, q = tables(spark, docs, queries)
    hits, report = P.topk_text(d, q, k=3, block=64, norm=1.0, report=True)
    assert found(hits) == brute(docs, queries, 3)
    rows = report.collect()
    assert len(rows) == 20 and all(r.joined <= r.postings for r in rows)
    assert sum(r.joined for r in rows) < 0.2 * sum(r.postings for r in rows)
    assert sum(r.scored for r in rows) < 0.1 * 3000 * 20


def test_blocks_are_bounded(spark):
    docs = corpus(500, 4)
    d, _ = tables(spark, docs, {0: {"w0": 1.0}})
    lists = P.impact_lists(d.toDF("doc", "term", "w"), block=50).collect()
    assert max(len(r.entries) for r in lists) < 120
    assert sum(len(r.entries) for r in lists) == sum(map(len, docs.values()))
    assert all(r.top == r.entries[0].w == max(e.w for e in r.entries) and min(e.w for e in r.entries) > r.top / 2 ** 0.5 - 1e-12 for r in lists)


def test_empty_sides(spark):
    d, q = tables(spark, {1: {"a": 1.0}}, {2: {"a": 1.0}})
    assert P.topk_text(d.limit(0), q).count() == 0 == P.topk_text(d, q.limit(0)).count()


def test_term_counts_in_the_row(spark):
    long = " ".join(f"t{i % 700}" for i in range(50_000))
    texts = {1: "b a b  B, aa bb AA aa", 2: "", 3: None, 4: "x y z", 5: "été ÉTÉ _a1 _a1", 6: long}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    want = {(i, t): n for i, x in texts.items() for t, n in Counter(w for w in __import__("re").findall(r"\w+", (x or "").lower()) if len(w) > 1).items()}
    assert {(r.id, r.term): r.tf for r in FE.term_counts(df, "id", "text").collect()} == want
    twice = FE.term_counts(df.union(df), "id", "text", unique_ids=False)
    assert {(r.id, r.term): r.tf for r in twice.collect()} == {key: 2 * n for key, n in want.items()}
    plan = FE.term_counts(df, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
