"""Metrics, feedback analytics, pairing and selection."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from textrail.operators import feedback as FB
from textrail.operators import metrics as M
from textrail.operators import selection as SEL


def test_bleu_toy_pairs_by_hand():
    # ref 'this is a test' vs hyp 'this is test': p1=3/3, p2=1/2, p3,p4 smoothed 0.1/1, bp=exp(1-4/3)
    exp = math.exp(1 - 4 / 3) * math.exp(0.25 * (math.log(1) + math.log(0.5) + math.log(0.1) + math.log(0.1)))
    assert math.isclose(M.bleu("this is a test".split(), "this is test".split()), exp, rel_tol=1e-12)
    assert M.bleu(["a"], ["b"]) == 0.0               # no unigram match
    assert M.bleu(["a", "b"], []) == 0.0
    assert M.bleu("x y z w".split(), "x y z w".split()) == 1.0


def test_rouge_definitions():
    t, p = M.rouge_tokens("The cat, the HAT!"), M.rouge_tokens("the cat sat")
    assert t == ["the", "cat", "the", "hat"]
    # rouge1: overlap the,cat = 2; P=2/3, R=2/4
    assert math.isclose(M.rouge_n(t, p, 1), 2 * (2 / 3) * (2 / 4) / (2 / 3 + 2 / 4))
    assert math.isclose(M.rouge_l(t, p), 2 * (2 / 3) * (2 / 4) / (2 / 3 + 2 / 4))


def test_lcs_bitparallel_equals_dp():
    rnd = random.Random(5)
    for _ in range(500):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(0, 70))]
        b = [rnd.choice("abcd") for _ in range(rnd.randint(0, 70))]
        assert M.lcs_length(a, b) == M.lcs_length_dp(a, b)


def test_pair_metrics_udf(spark):
    df = spark.createDataFrame([(1, "this is a test", "this is test"), (2, "", "")], "id int, a string, b string")
    rows = {r["id"]: r for r in M.text_pair_metrics(df, "a", "b").select("id", "m.*").collect()}
    assert math.isclose(rows[1]["bleu"], M.bleu("this is a test".split(), "this is test".split()))
    assert rows[2]["bleu"] == 0.0 and rows[2]["rougeL"] == 0.0


def test_preference_pairs_are_all_pairs(spark):
    rows = [("q1", f"g{i}", 1) for i in range(5)] + [("q1", f"b{i}", 0) for i in range(2)] + \
           [("q2", "only_good", 1)] + [("q3", "g", 1), ("q3", "b1", 0), ("q3", "b2", 0), ("q3", "b3", 0), ("q3", "b3", 0)]
    df = spark.createDataFrame(rows, "query string, answer string, label int")
    pairs = [tuple(r) for r in FB.preference_pairs(df).collect()]
    assert sorted(pairs) == sorted([("q1", f"g{i}", f"b{j}") for i in range(5) for j in range(2)] + [("q3", "g", f"b{j}") for j in (1, 2, 3)])
    graded = FB.graded_pairs(df.withColumn("feedback", F.when(F.col("label") == 1, "good").otherwise("incorrect")))
    assert graded.count() == 10 + 4  # the repeated answer pairs twice


def test_topk_far_from_the_origin(spark):
    import numpy as np
    from textrail.operators.retrieval import topk
    x = 1e5 + np.random.default_rng(1).normal(scale=0.01, size=(200, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = topk(df, df.where("vec_id < 20").toDF("query_id", "qvec"), k=5).toPandas()
    for q in range(20):
        want = np.lexsort((np.arange(200), ((x - x[q]) ** 2).sum(1)))[:5]
        assert sorted(got[got.query_id == q].vec_id) == sorted(want)


def test_feedback_score_and_reports(spark):
    fb = spark.createDataFrame([("hola", "good", 1.0), ("hola", "bad", 3.0), ("¿qué es?", "Good", 2.0)],
                               "query string, feedback string, response_time double")
    qs = spark.createDataFrame([("hola",), ("nuevo",)], "query string")
    sc = {r["query"]: r["summary"] for r in FB.feedback_score(fb, qs).collect()}
    assert sc == {"hola": "Feedback: \U0001F44D 1 | \U0001F44E 1", "nuevo": "No feedback yet."}
    rep = FB.performance_report(fb).collect()[0]
    assert (rep["total"], rep["good"], rep["bad"]) == (3, 2, 1) and math.isclose(rep["avg_response_time"], 2.0)
    cats = {r["category"]: (r["good"], r["bad"]) for r in FB.category_report(fb).collect()}
    assert cats == {"conversational": (1, 1), "informational": (1, 0)}


def test_template_weights_closed_form_equals_sequential_fold(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(3), float(t), rnd.choice([-1.0, -0.5, 0.25, 1.0])) for t in range(400)]
    df = spark.createDataFrame(rows, "template int, ts double, reward double")
    got = {r["template"]: r["weight"] for r in FB.template_weights(df, 4, order="ts", partitions=5).collect()}
    w = [1.0] * 4
    for tpl, _, rw in sorted(rows, key=lambda r: r[1]):
        w[tpl] = max(0.1, w[tpl] + rw)
    assert all(math.isclose(got[i], w[i], abs_tol=1e-9) for i in range(4))


def test_degradation_needs_more_than_twenty(spark):
    def run(n_rows, bad_tail):
        rows = [("k", i, 1 if (i >= n_rows - 10 and bad_tail) else 0) for i in range(n_rows)]
        rows[0] = ("k", 0, 1)  # old ratio 0.1
        df = spark.createDataFrame(rows, "k string, i int, bad int")
        return FB.degradation(df, "k", "i", F.col("bad") == 1).collect()[0]["degraded"]
    assert run(20, True) is False
    assert run(21, True) is True
    assert run(30, False) is False


def test_best_of_n_first_wins_ties(spark):
    df = spark.createDataFrame([("q", "a", 0.5, 1), ("q", "b", 0.9, 2), ("q", "c", 0.9, 3), ("r", "x", None, 1), ("r", "y", None, 2)],
                               "query string, answer string, reward double, ord int")
    out = {r["query"]: r["answer"] for r in SEL.best_of_n(df, "query", "reward", "ord").collect()}
    assert out == {"q": "b", "r": "x"}


def test_chosen_rejected_and_fallback(spark):
    df = spark.createDataFrame([("p1", "A", 0.9, "B", 0.1), ("p2", "A", 0.2, "B", 0.2), ("p3", "S", 0.5, "S", 0.4)],
                               "prompt string, response_1 string, score_1 double, response_2 string, score_2 double")
    out = {r["prompt"]: (r["chosen"], r["rejected"]) for r in SEL.chosen_rejected(df).collect()}
    assert out == {"p1": ("A", "B"), "p2": ("A", "B")}
    fb = spark.createDataFrame([("ok answer that is long enough", None), ("", "second fine answer long enough"), ("....", None)],
                               "a string, b string")
    from textrail.functions.text import is_gibberish
    res = [(r["answer"], r["model_used"]) for r in SEL.fallback_chain(fb, ["a", "b"], gate=is_gibberish).collect()]
    assert res[0][1] == "a" and res[1][1] == "b" and res[2][1] == "fallback"


def test_softmax_and_loss(spark):
    df = spark.createDataFrame([("q", 1.0), ("q", 2.0), ("r", 5.0)], "query string, x double")
    probs = {(r["query"], r["x"]): r["prob"] for r in SEL.softmax_by(df, "query", "x").collect()}
    assert math.isclose(probs[("q", 2.0)], math.exp(1) / (1 + math.exp(1))) and probs[("r", 5.0)] == 1.0
    pairs = spark.createDataFrame([(2.0, 1.0, 1.0), (0.0, 1.0, 0.0)], "c double, r double, p double")
    hinge = FB.pairwise_loss(pairs, "c", "r", "hinge", margin=1.0).collect()[0]["loss"]
    assert math.isclose(hinge, (0.0 + 2.0) / 2)
    lg = FB.pairwise_loss(pairs, "c", "r", "logistic", preferred="p").collect()[0]["loss"]
    assert math.isclose(lg, math.log1p(math.exp(-1.0)))


def test_template_weights_many_partitions(spark):
    rnd = random.Random(9)
    rows = [(rnd.randrange(2), float(t), rnd.choice([-2.0, -0.5, 0.3, 1.0])) for t in range(0, 3000, 7)]
    df = spark.createDataFrame(rows, "template int, ts double, reward double")
    got = {r["template"]: r["weight"] for r in
           FB.template_weights(df, 2, order="ts", partitions=40).collect()}
    w = [1.0, 1.0]
    for tpl, _, rw in sorted(rows, key=lambda r: r[1]):
        w[tpl] = max(0.1, w[tpl] + rw)
    assert all(math.isclose(got[i], w[i], abs_tol=1e-9) for i in range(2))


def test_template_weights_hot_moment(spark):
    rnd = random.Random(4)
    rows = [(0, 7.0, e, rnd.choice([-2.0, -0.5, 0.3, 1.0, None])) for e in rnd.sample(range(2000), 2000)]
    df = spark.createDataFrame(rows, "template int, ts double, event_id bigint, reward double")
    got = {r["template"]: r["weight"] for r in FB.template_weights(df, 2, tie="event_id", partitions=16).collect()}
    w = 1.0
    for r in sorted(rows, key=lambda r: r[2]):
        w = max(0.1, w + (r[3] or 0.0))
    assert math.isclose(got[0], w, abs_tol=1e-9) and got[1] == 1.0


def test_pair_scores_by_numbers_equal_counted_ngrams():
    """n-grams compared as numbers give what counting tuples gives, without counting any tuple."""
    import random

    from textrail.operators import metrics as M
    rng = random.Random(5)
    texts = ["", "a", "a b", "a b c"] + [" ".join(rng.choice(["a", "B", "c-d", "é", "x1", "."]) for _ in range(rng.randrange(40))) for _ in range(60)]
    for a in texts[::3]:
        for b in texts:
            got, ta, tb = M.pair_scores(a, b), M.rouge_tokens(a), M.rouge_tokens(b)
            assert got["bleu"] == M.bleu(a.split(), b.split())
            assert (got["rouge1"], got["rouge2"]) == (M.rouge_n(ta, tb, 1), M.rouge_n(ta, tb, 2))
            for n, shared in enumerate(M.shared_ngrams(ta, tb, 4), 1):
                assert shared == sum((M._ngrams(ta, n) & M._ngrams(tb, n)).values())


def test_chunk_cosine_exchanges_each_term_of_a_chunk_once(spark):
    """The same cosines as from whole TF-IDF rows, with null, empty and repeated ids, by fewer exchanges of terms."""
    from pyspark.sql import functions as F

    from textrail.operators import chunking as C, features as FE
    rows = [(1, "a1 b2 b2 c3 ΟΔΟΣ a1 d4 ... x é9 b2"), (2, "b2 " * 7), (3, ""), (4, None), (None, "a1 b2 q7 q7"), (None, "z1"),
            (5, "- - - - - -"), (6, "c3 d4"), (6, "c3 d4"), (6, "c3 a1 a1 b2")]
    for docs in (rows, [r for r in rows if r[0] not in (None, 6)]):
        d = spark.createDataFrame(docs, "doc_id bigint, text string")
        ch = C.fixed_words(d, "doc_id", "text", 3)
        key = lambda no: F.struct("doc_id", no.cast("bigint").alias("chunk_no"))
        both = d.select(key(F.lit(-1)).alias("id"), "text").unionByName(ch.select(key(F.col("chunk_no")).alias("id"), F.col("chunk_text").alias("text")))
        tv = FE.tfidf(both, "id", "text")
        pairs = ch.select(key(F.lit(-1)).alias("ida"), key(F.col("chunk_no")).alias("idb"))
        want = FE.sparse_cosine(tv.withColumnRenamed("id", "ida"), tv.withColumnRenamed("id", "idb"), "ida", "idb", pairs)
        want = {(r["idb"]["doc_id"], r["idb"]["chunk_no"]): r["cosine"] for r in want.collect() if r["cosine"]}
        out = FE.chunk_cosine(d, "doc_id", "text", 3)
        got = {(r["doc_id"], r["chunk_no"]): r["cosine"] for r in out.collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("Exchange hashpartitioning(term" in x for x in plan.splitlines()) <= 2
