"""Sentence boundaries by corpus statistics, and rule word tokens."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from textrail.operators import boundaries as B

TEXTS = [(i, f"The firm of Mills & Co. sold {i} mills. It paid Dr. Brown well! Did it (as J. Smith wrote.) last?  On the 3. day it did.") for i in range(60)]
# the words that end those sentences stand without a stop elsewhere
TEXTS += [(i, "All mills that he wrote of did well last year and they did so every day") for i in range(60, 80)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([*TEXTS, (100, None), (101, ""), (102, "  \n "), (103, "no end")], "doc_id bigint, text string")


def test_abbreviations_are_short_words_that_rarely_stand_without_a_stop(corpus):
    short = {r.type for r in B.abbreviations(corpus, "text").collect()}
    assert {"co", "dr"} <= short and not short & {"mills", "firm", "brown", "wrote", "did"}


def test_sentences(corpus):
    got = B.split_sentences(corpus, "doc_id", "text").where("doc_id in (7, 100, 101, 102, 103)").orderBy("doc_id", "sent_no").collect()
    assert [(r.doc_id, r.sent_no, r.sentence) for r in got] == [
        (7, 0, "The firm of Mills & Co. sold 7 mills."), (7, 1, "It paid Dr. Brown well!"),
        (7, 2, "Did it (as J. Smith wrote.)"), (7, 3, "last?"), (7, 4, "On the 3. day it did."), (103, 0, "no end")]


def test_own_abbreviations_and_empty_tables(spark, corpus):
    none = spark.createDataFrame([], "type string")
    got = B.split_sentences(corpus.where("doc_id = 7"), "doc_id", "text", none).orderBy("sent_no").collect()
    assert got[0].sentence == "The firm of Mills & Co." and len(got) == 7
    empty = corpus.where("false")
    assert B.abbreviations(empty, "text").count() == 0 and B.split_sentences(empty, "doc_id", "text").count() == 0
    assert B.sentence_token_windows(empty, "doc_id", "text").count() == 0


def test_word_tokens(spark):
    cases = {
        "Hello, world.": ["Hello", ",", "world", "."],
        "It's 3,000 -- he said \"no\"!": ["It", "'s", "3,000", "--", "he", "said", "``", "no", "''", "!"],
        "We don't (yet) pay 5% to A&B...": ["We", "do", "n't", "(", "yet", ")", "pay", "5", "%", "to", "A", "&", "B", "..."],
        "e.g. this; at 10:30": ["e.g.", "this", ";", "at", "10:30"],
        "": [],
    }
    rows = spark.createDataFrame([(k,) for k in cases], "s string").select("s", B.word_tokens(F.col("s")).alias("t")).collect()
    assert {r.s: r.t for r in rows} == cases


def test_windows_cover_a_long_text(spark):
    text = " ".join(f"word{i}." if i % 9 == 8 else f"word{i}" for i in range(2000))
    got = B.sentence_token_windows(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), "doc_id", "text", 500, 50).orderBy("chunk_no").collect()
    tokens = []
    for r in got:
        part = r.chunk_text.split(" ")
        assert len(part) == r.n_tokens <= 500 and (not tokens or part[:50] == tokens[r.chunk_no * 450:r.chunk_no * 450 + 50][:len(part)])
        tokens = tokens[:r.chunk_no * 450] + part
    assert "".join(tokens) == text.replace(" ", "")


def test_places_do_not_carry_their_text(spark):
    """A word that can end a sentence is shuffled without the text it stands in."""
    df = spark.createDataFrame([(1, "One two. Three four! Five"), (2, None), (3, "no end")], "id long, x string")
    out = B.split_sentences(df, "id", "x")
    assert sorted(map(tuple, out.collect())) == [(1, 0, "One two."), (1, 1, "Three four!"), (1, 2, "Five"), (3, 0, "no end")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    spread_words = [line for line in plan.splitlines() if "Generate " in line and "explode(_words" in line]
    assert not spread_words, spread_words
