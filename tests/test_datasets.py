"""Prompt, question and training-set builders on literal rows."""

from pyspark.sql import functions as F

from textrail.operators import datasets as D


def test_build_prompt_with_history(spark):
    hits = spark.createDataFrame([(1, 2, "second chunk"), (1, 1, "first chunk")], "query_id long, rank long, chunk_text string")
    qs = spark.createDataFrame([(1, "What?")], "query_id long, question string")
    hist = spark.createDataFrame([(1, 0, "q0", "a0"), (1, 2, "q2", "a2"), (1, 4, "q4", "a4")],
                                 "query_id long, turn long, question string, answer string")
    p = D.build_prompt(hits, qs, "history", history=hist).collect()[0]["prompt"]
    assert p == ("You are a helpful assistant. Use the context below to answer.\n\n"
                 "Q1: q2\nA1: a2\nQ2: q4\nA2: a4\n\n### Context ###\nfirst chunk\nsecond chunk\n\n"
                 "### Question ###\nWhat?\n\n### Answer ###\n")
    short = D.build_prompt(hits, qs, "short_fallback").collect()[0]["prompt"]
    assert short == "Use the following context to answer the question briefly.\n\nContext: first chunk\n\nQuestion: What?\n\nAnswer:"


def test_map_reduce_and_variants(spark):
    hits = spark.createDataFrame([(1, 1, "c1"), (1, 2, "c2")], "query_id long, rank long, chunk_text string")
    qs = spark.createDataFrame([(1, "Q")], "query_id long, question string")
    mp = D.mapped_prompt(hits, qs).collect()[0]["prompt"]
    assert mp == D.MAP_PROMPT_HEADER + "c1\n\nQuestion: Q" + "\n\n---\n\n" + "c2\n\nQuestion: Q"
    ans = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "query_id long, rank long, answer string")
    assert D.reduce_prompts(ans).collect()[0]["reduce_prompt"] == D.REDUCE_HEADER + "a\nb"
    v = D.prompt_variants(spark.createDataFrame([(1, "P")], "id long, prompt string")).orderBy("variant").collect()
    assert [r["variant_prompt"] for r in v] == [t + "\n\nP" for t in D.VARIANT_TEMPLATES]


def test_template_questions(spark):
    rows = ["Paris is the capital of France and a large city.",
            "Alan Turing was a mathematician who studied computing machines.",
            "Short text.",
            "The long subject of many words here is something quite interesting indeed.",
            "Numbers 1 2 3 4 5 6 7 8 9 10 11 are too many digits for a question here."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    out = {r["i"]: (r["v1"], r["v3"]) for r in df.select("i", D.template_question("t", 1).alias("v1"),
                                                             D.template_question("t", 3).alias("v3")).collect()}
    assert out[0] == ("What is Paris?", "What is Paris?")
    assert out[1] == ("Who was Alan Turing?", "Who was Alan Turing?")
    assert out[2] == (None, None)
    assert out[3] == ("What is The long subject of many words here?", "What is The long subject of many?")
    assert out[4] == (None, None)


def test_encode_and_pack(spark):
    df = spark.createDataFrame([(1, "b a c"), (2, "a a"), (3, "")], "id long, text string")
    vocab = {r["token"]: r["token_id"] for r in D.build_vocab(df, "text").collect()}
    assert vocab == {"a": 2, "b": 3, "c": 4}
    enc = {r["id"]: r for r in D.encode(df, "id", "text", D.build_vocab(df, "text"), max_len=4).collect()}
    assert enc[1]["input_ids"] == [3, 2, 4, 0] and enc[1]["attention_mask"] == [1, 1, 1, 0]
    assert enc[3]["input_ids"] == [0, 0, 0, 0] and enc[2]["labels"] == enc[2]["input_ids"]
    toks = spark.createDataFrame([(1, ["t1", "t2", "t3"]), (2, ["t4"]), (3, ["t5", "t6", "t7"])], "id long, toks array<string>")
    blocks = sorted((r["block_no"], r["tokens"]) for r in D.pack(toks, "id", "toks", 2).collect())
    assert blocks == [(0, ["t1", "t2"]), (1, ["t3", "t4"]), (2, ["t5", "t6"])]   # t7 (partial block) dropped


def test_synthetic_data(spark):
    docs = spark.createDataFrame([(i, " ".join(f"word{j}" for j in range(12 + i))) for i in range(20)] + [(99, "too short")],
                                 "doc_id long, text string")
    fb = D.synthetic_feedback(docs, "doc_id", "text", n=300, seed=7).collect()
    grades = {r["feedback"] for r in fb}
    assert grades <= {"good", "partially correct", "incorrect", "hallucinated"} and len(grades) == 4
    assert all(r["query"].startswith("What ") and r["query"].endswith(" do?") for r in fb)
    assert all(r["source"] != "99" for r in fb)
    again = D.synthetic_feedback(docs, "doc_id", "text", n=300, seed=7).collect()
    assert sorted(map(tuple, fb)) == sorted(map(tuple, again))     # reproducible
    cats = spark.createDataFrame([("technical",), ("creative",)], "category string")
    st = D.synthetic_templates(cats).collect()
    assert len(st) == 3 * 4 + 3 * 3 and all("{" not in r["query"] for r in st)
    assert {r["category"] for r in st} == {"synthetic_technical", "synthetic_creative"}
