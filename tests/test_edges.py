"""Remaining FIXTURES edge cases."""

import math

from pyspark.sql import functions as F

from textrail.functions import text as T
from textrail.operators import feedback as FB
from textrail.operators import selection as SEL
from textrail.operators.snippets import best_snippet
from textrail.streaming.trigger import TriggerState


def test_null_texts_pass_through(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "id int, x string")
    out = {r["id"]: (r["a"], r["b"], r["c"]) for r in
           df.select("id", T.clean_ocr("x").alias("a"), T.word_count("x").alias("b"), T.is_blank("x").alias("c")).collect()}
    assert out[1] == (None, None, True) and out[2] == ("", 0, True)


def test_parse_choices_malformed_and_unknown(spark):
    rows = [(1, '{"TinyLLaMA": "a", "Direct": "b", "Variant": "c"}', " Direct "),
            (2, '{"TinyLLaMA": "a", "Direct": "b"', "direct"),          # malformed map
            (3, '{"TinyLLaMA": "a"}', "other"),                          # vote outside the set
            (4, '{"TinyLLaMA": "x"}', "variant")]                        # missing key -> ""
    df = spark.createDataFrame(rows, "id int, responses string, selected_best string")
    out = {r["id"]: r for r in SEL.parse_choices(df, "responses", "selected_best", keep=("id",)).collect()}
    assert set(out) == {1, 4}
    assert out[1]["label"] == "direct" and out[1]["chosen_text"] == "b"
    assert out[1]["combined_text"] == "TinyLLaMA: a\nDirect: b\nVariant: c"
    assert out[4]["combined_text"] == "TinyLLaMA: x\nDirect: \nVariant: " and out[4]["chosen_text"] is None


def test_snippet_variant_b_lengths_and_fallback(spark):
    s9, s10 = "a" * 8 + ".", "b" * 9 + "."
    s249, s250, s251 = "c" * 248 + ".", "d" * 249 + ".", "e" * 250 + "."
    docs = spark.createDataFrame([(1, " ".join([s9, s10, s249, s250, s251])), (2, "tiny. x.")], "doc_id long, text string")
    qs = spark.createDataFrame([(0, "bbbbbbbbb"), (1, "zzz")], "query_id long, text string")
    hits = spark.createDataFrame([(0, 1, 1), (1, 2, 1)], "query_id long, doc_id long, rank long")
    out = {r["query_id"]: r for r in best_snippet(hits, docs, qs, min_len=10, fallback=True).collect()}
    assert out[0]["snippet"] == s10                       # the 9-char sentence is ignored
    assert out[1]["snippet"] == "tiny. x." + "..."        # no sentence of 10+ chars: first chunk, cut, ellipsis
    a = spark.createDataFrame([(s249,), (s250,), (s251,)], "x string")
    got = [r[0] for r in a.select(T.ellipsize("x", 250, "A")).collect()]
    assert got == [s249, s250, s251[:250] + "..."]


def test_degradation_with_old_ratio_zero():
    st = TriggerState()
    fired = None
    for i in range(21):
        fired = st.step(float(i), i == 20)   # 20 good, then one bad: recent 0.1 > 0 * 1.5
    assert fired == ("degradation", 1)


def test_feedback_cases_and_duplicates(spark):
    fb = spark.createDataFrame([("q1", "a", "good"), ("q1", "a", "good"), ("q2", "b", "bad"), ("q3", "c", "GOOD")],
                               "query string, answer string, feedback string")
    qs = spark.createDataFrame([("q1",), ("q2",), ("q3",), ("q4",)], "query string")
    out = {r["query"]: (r["good"], r["bad"]) for r in FB.feedback_score(fb, qs).collect()}
    # exact label match, as in the reference's counters; other letter case counts as neither
    assert out == {"q1": (2, 0), "q2": (0, 1), "q3": (0, 0), "q4": (None, None)}
    rep = FB.performance_report(fb).collect()[0]
    assert (rep["good"], rep["bad"]) == (3, 1)          # the report lower-cases labels
    labelled = fb.select("query", "answer", T.map_label(F.lower("feedback"), "good_bad").alias("label"))
    assert FB.preference_pairs(labelled).count() == 0    # no query has both labels


def test_answer_flow_prefers_summary_answers(spark):
    from textrail.operators.answers import answer_queries
    docs = spark.createDataFrame([(1, "Plain first sentence. More text here."), (2, "A summary of things. Tail.")],
                                 "doc_id long, text string")
    qs = spark.createDataFrame([(0, "things summary")], "query_id long, text string")
    hits = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "query_id long, doc_id long, rank long")
    r = answer_queries(hits, docs, qs).collect()[0]
    assert r["answer"] == "A summary of things. Tail." and math.isclose(r["reward"], 1.5) and r["source"] == "2.txt"


def test_punct_tokenizer_and_shuffle(spark):
    import re
    from textrail.operators.chunking import token_window
    texts = ["Hello, world! It's 3.5 euros.", "Ça va? — oui…", "", "a_b c-d"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = [list(r[0]) for r in df.orderBy("i").select(T.punct_tokens("t")).collect()]
    assert got == [re.findall(r"\w+|[^\w\s]", t) for t in texts]
    ch = token_window(df, "i", "t", size=3, overlap=1, global_ids=False, tokenizer="punct").where(F.col("i") == 0)
    assert [r["chunk_text"] for r in ch.orderBy("chunk_no").collect()] == ["Hello , world", "world ! It", "It ' s", "s 3 .", ". 5 euros", "euros ."]
    rows = spark.range(50).withColumnRenamed("id", "k")
    a = [r["k"] for r in FB.hash_shuffle(rows, "k", seed=1).collect()]
    b = [r["k"] for r in FB.hash_shuffle(rows, "k", seed=1).collect()]
    assert a == b and sorted(a) == list(range(50)) and a != list(range(50))


def test_adjacency_variants_and_context_replace(spark):
    from textrail.operators.metrics import adjacent_pairs
    from textrail.operators.retrieval import add_context
    ch = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (2, 1, "d"), (3, 0, "e")],
                               "doc long, n long, t string")
    per_doc = sorted((r["text_a"], r["text_b"]) for r in adjacent_pairs(ch, "doc", "n", "t").collect())
    whole = sorted((r["text_a"], r["text_b"]) for r in adjacent_pairs(ch, "doc", "n", "t", by_document=False).collect())
    assert per_doc == [("a", "b"), ("c", "d")]
    assert whole == [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e")]
    hits = spark.createDataFrame([(0, "h1", 1), (0, "h2", 2)], "query_id long, chunk_id string, rank long")
    extra = spark.createDataFrame([(0, "ocr_chunk")], "query_id long, chunk_id string")
    assert [(r["chunk_id"], r["rank"]) for r in add_context(hits, extra, replace=True).collect()] == [("ocr_chunk", 1)]
    appended = sorted((r["rank"], r["chunk_id"]) for r in add_context(hits, extra).collect())
    assert appended == [(1, "h1"), (2, "h2"), (3, "ocr_chunk")]
